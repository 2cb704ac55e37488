"""Folder searches, numbered lines, and runs that are killed and go on, on real files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from loomspark.plans.pipeline import Pipeline
from loomspark.sources import folders, lines
from loomspark.streaming import reward_log


def put(path, text, at=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    if at is not None:
        os.utime(path, (at, at))


def names(df):
    return sorted(r.name for r in df.collect())


def test_mapping_folders(spark, tmp_path):
    put(tmp_path / "one" / "sql_generation" / "a.json", "[{}]")
    put(tmp_path / "one" / "b.json", "[{}]")
    put(tmp_path / "one" / "sql_generation" / "deep" / "c.json", "[{}]")
    put(tmp_path / "two" / "d.json", "{}")
    put(tmp_path / "two" / "other" / "e.json", "{}")
    put(tmp_path / "two" / "f.txt", "")
    put(tmp_path / "three" / "sql_generation" / "g.txt", "")  # the sub-folder is there, without JSON
    put(tmp_path / "three" / "h.json", "[]")
    found = folders.mapping_files(folders.listing(spark, str(tmp_path)), str(tmp_path))
    assert sorted((r.mapping, r.name) for r in found.collect()) == [("one", "a.json"), ("two", "d.json")]
    assert folders.read(spark, found).count() == 2
    assert folders.listing(spark, str(tmp_path / "nowhere")).collect() == []
    assert folders.read(spark, folders.listing(spark, str(tmp_path / "nowhere"))).collect() == []


def test_reports_newest_first(spark, tmp_path):
    put(tmp_path / "old" / "statistics_summary.json", "{}", 1000)
    put(tmp_path / "new" / "evaluation_summary.json", "{}", 3000)
    put(tmp_path / "both" / "evaluation_summary.json", "{}", 2000)
    put(tmp_path / "both" / "statistics_summary.json", "{}", 1500)
    put(tmp_path / "none" / "x.json", "{}", 9000)
    put(tmp_path / "nested" / "in" / "statistics_summary.json", "{}", 9000)
    for name, at in (("old", 1000), ("new", 3000), ("both", 2000), ("none", 9000), ("nested", 9000)):
        os.utime(tmp_path / name, (at, at))  # a run is as new as its folder
    found = folders.reports(folders.listing(spark, str(tmp_path)), str(tmp_path)).orderBy("place").collect()
    assert [(r.place, r.run, r.path.rsplit("/", 1)[-1]) for r in found] == [(1, "new", "evaluation_summary.json"), (2, "both", "statistics_summary.json"), (3, "old", "statistics_summary.json")]
    put(tmp_path / "logs" / "l1.jsonl", "", 1)
    put(tmp_path / "logs" / "l2.jsonl", "", 2)
    assert [r.run for r in folders.logs(folders.listing(spark, str(tmp_path / "logs"))).orderBy("place").collect()] == ["l2", "l1"]
    assert folders.first_named(folders.listing(spark, str(tmp_path / "both")), ["a.json", "evaluation_summary.json", "statistics_summary.json"]).endswith("evaluation_summary.json")
    assert folders.first_named(folders.listing(spark, str(tmp_path / "both")), ["a.json"]) is None


def test_records_in_file_order(spark, tmp_path):
    for k, rows in enumerate(([1, 2, 3], [4], [], [5, 6])):
        put(tmp_path / f"f{k}.json", json.dumps([{"a": a} for a in rows]))
    put(tmp_path / "f1x.json", '{"a": 99}')
    put(tmp_path / "f2x.json", "broken")
    put(tmp_path / "in" / "f0.json", '[{"a": 98}]')
    get = lambda n: [r.a for r in folders.load(spark, str(tmp_path), n).orderBy("number").selectExpr("variant_get(row, '$.a', 'int') AS a", "number").collect()]
    assert get(None) == [1, 2, 3, 4, 5, 6] and get(4) == [1, 2, 3, 4] and get(0) == [] and get(99) == get(None)


@pytest.mark.parametrize("split", [64, 1 << 27])
def test_line_numbers_dont_depend_on_splits(spark, tmp_path, split):
    body = [f"line {i} " + "x" * (i % 37) if i % 11 else "" for i in range(1, 400)]
    put(tmp_path / "a.txt", "\n".join(body) + "\n")
    put(tmp_path / "b.txt", "\n".join(body[:50]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = lines.read(spark, str(tmp_path)).collect()
        first = lines.head(lines.read(spark, str(tmp_path)), 420).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    want = {("a.txt", i, t) for i, t in enumerate(body, 1)} | {("b.txt", i, t) for i, t in enumerate(body[:50], 1)}
    assert {(r.source.rsplit("/", 1)[-1], r.line_number, r.value) for r in got} == want and len(got) == len(want)
    assert sorted((r.source[-5:], r.line_number) for r in first) == [("a.txt", i) for i in range(1, 400)] + [("b.txt", i) for i in range(1, 22)]


def test_reward_log_lines(spark, tmp_path):
    put(tmp_path / "in" / "r.jsonl", '{"score": 0.9}\n\nbroken\n{"score": 0.1, "function_name": "f"}\n{"other": 1}\n')
    assert sorted((r.line_number, r.band) for r in reward_log.read(spark, str(tmp_path / "in"), False, True).collect()) == [(1, "0.8-1.0"), (4, "0.0-0.4")]
    assert sorted(r.line_number for r in lines.json_lines(spark, str(tmp_path / "in")).collect()) == [1, 4, 5]
    reward_log.append_numbered(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    put(tmp_path / "in" / "s.jsonl", 'x\n{"score": 0.5}\n')
    reward_log.append_numbered(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.source[-7:], r.line_number) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("r.jsonl", 1), ("r.jsonl", 4), ("s.jsonl", 2)]


def test_killed_run_goes_on(spark, tmp_path):
    calls, fail = [], [True]

    def step(name, broken=False):
        def run(df):
            calls.append(name)
            if broken and fail[0]:
                return df.select(F.raise_error(F.lit("killed")).alias("id"))
            return df.withColumn(name, F.lit(1))
        return run

    steps = [("one", step("one")), ("two", step("two")), ("three", step("three", True)), ("four", step("four"))]
    folder = str(tmp_path / "run")
    with pytest.raises(Exception, match="killed"):
        Pipeline(steps, folder).run(spark, spark.range(5))
    assert calls == ["one", "two", "three"] and list(Pipeline(steps, folder).state(spark)) == ["one", "two"]
    with pytest.raises(ValueError, match="not finished"):
        Pipeline(steps, folder).finish(spark)
    fail[0] = False
    later = Pipeline(steps, folder)
    assert later.run(spark, resume=True).columns == ["id", "one", "two", "three", "four"]
    assert calls == ["one", "two", "three", "three", "four"]
    assert [r.step for r in later.step_metrics(spark).collect()] == ["three", "four"]
    assert {(r.step, r.value) for r in later.all_metrics(spark).where("metric = 'columns'").collect()} == {("one", 2.0), ("two", 3.0), ("three", 4.0), ("four", 5.0)}
    # a named step runs again, and those after it
    Pipeline(steps, folder).run(spark, resume="two")
    assert calls[-3:] == ["two", "three", "four"]
    last = Pipeline(steps, folder).finish(spark)
    assert os.listdir(folder) == [last.rsplit("/", 1)[-1]] and spark.read.parquet(last).count() == 5
    assert list(Pipeline(steps, folder).state(spark)) == []
    with pytest.raises(ValueError, match="needs its input"):
        Pipeline(steps, folder).run(spark, resume=True)

"""Further inputs: audit exports, JSON by suffix, generation inputs, and the table of runs that stands for searching folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lines, records


def read_audit(spark: SparkSession, path, column: str = "Sql") -> DataFrame:
    """(sql_text) of a CSV export with a header; other columns aren't read."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).select(F.col(column).alias("sql_text"))


def read_by_suffix(spark: SparkSession, path: str) -> DataFrame:
    """(source, pos, row variant) of a JSON file or folder, or of JSON lines, of which malformed ones are skipped."""
    if path.endswith(".jsonl"):
        return lines.json_lines(spark, path).select("source", (F.col("line_number") - 1).alias("pos"), "row")
    return records.rows_of(records.read_files(spark, path))


def merged(parts: dict[str, DataFrame]) -> DataFrame:
    """(origin, source, pos, row): record files of several origins, lists extended, lone objects as one record."""
    out = None
    for origin, files in parts.items():
        rows = records.rows_of(files).select(F.lit(origin).alias("origin"), "source", "pos", "row")
        out = rows if out is None else out.unionByName(rows)
    return out


def is_generation_file(path: Column) -> Column:
    """A JSON file in the ``sql_generation`` folder of a run, but not of a folder named workflow_ and a year."""
    return path.rlike(r"/sql_generation/[^/]+\.json$") & ~path.rlike(r"(^|/)workflow_\d{4}[^/]*/sql_generation/")


def is_privileged(path: Column, folder: str) -> Column:
    """Does the file lie anywhere below the privileged folder?"""
    return path.contains(f"/{folder}/")


def is_data_file(path: Column) -> Column:
    """Not one of the files that runs leave besides their data."""
    return path.rlike(r"(?i)\.json$") & ~F.regexp_extract(path, r"([^/]*)$", 1).rlike("(?i)statistics|log|summary|unmatched")


def latest_run(runs: DataFrame, kind: str | None = None) -> DataFrame:
    """The run (run, kind, finished, path, bytes) that finished last, of equal ones the last by name."""
    own = runs if kind is None else runs.where(F.col("kind") == kind)
    return own.agg(F.max_by("run", F.struct("finished", "run")).alias("run"), F.max("finished").alias("finished"))


def latest_data(runs: DataFrame, patterns: list[str]) -> DataFrame:
    """(run, path): each run's data file: of the first pattern that any of its files fits the newest, else the largest."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    rank = F.coalesce(*[F.when(name.rlike(p), i) for i, p in enumerate(patterns)], F.lit(len(patterns)))
    files = runs.where(is_data_file(F.col("path"))).withColumn("rank", rank)
    # the least rank wins; inside a pattern the newest, among the others the largest
    weight = F.when(F.col("rank") < len(patterns), F.unix_micros(F.col("finished").cast("timestamp"))).otherwise(F.col("bytes"))
    return files.groupBy("run").agg(F.max_by("path", F.struct(-F.col("rank"), weight, "path")).alias("path"))


def generation_inputs(files: DataFrame) -> DataFrame:
    """(name, scenario, code_value, n_callers) of generation inputs in three shapes: scenario packs, a map of names to facts, a list of facts with names."""
    root = F.try_parse_json("content")
    shape = F.regexp_extract(F.schema_of_variant(root), r"^(\w+)", 1)
    entries = F.map_entries(F.try_variant_get(root, "$", "map<string,variant>"))
    listed = F.transform(F.try_variant_get(root, "$", "array<variant>"), lambda v: F.struct(F.try_variant_get(v, "$.function_name", "string").alias("key"), v.alias("value")))
    rows = files.select(F.explode(F.when(shape == "ARRAY", listed).otherwise(entries)).alias("e")).select("e.key", "e.value")
    get = lambda path, kind="string": F.try_variant_get("value", path, kind)
    return rows.select(
        F.coalesce(get("$.code_key"), F.col("key")).alias("name"), F.coalesce(get("$.scenario"), F.lit("")).alias("scenario"),
        F.coalesce(get("$.code_value"), get("$.orm_code"), F.lit("")).alias("code_value"), F.coalesce(F.size(get("$.callers", "array<variant>")), F.lit(0)).alias("n_callers"),
    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """(fp, sql_text, extra): a catalog table in any of its layouts: fingerprints alone, with statements, or with statement lists and a mark of added ones."""
    df = spark.read.parquet(path)
    sql = F.col("sql_text") if "sql_text" in df.columns else F.explode_outer("sql_examples").alias("sql_text") if "sql_examples" in df.columns else F.lit(None).cast("string").alias("sql_text")
    extra = F.coalesce("extra_add", F.lit(False)) if "extra_add" in df.columns else F.lit(False)
    return df.select("fp", extra.alias("extra"), sql).select("fp", "sql_text", "extra")

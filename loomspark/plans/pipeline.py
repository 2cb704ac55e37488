"""A pipeline of named steps, DataFrame to DataFrame, with staged tables, a manifest, and metrics.

Each attempt at a step writes a table of its own in the run's folder. Only when
it is whole does a row of the manifest, appended last, name it: a run that
was killed leaves a table that nobody refers to, and goes on after the last step of
the manifest. Metrics are part of the manifest, so a later session has them.
``finish`` removes all tables but the last one.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import clean, diff
from ..sources.folders import listing

Step = Callable[[DataFrame], DataFrame]
MANIFEST = "run string, seq int, step string, path string, rows long, columns int, seconds double"


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a file or folder in any store that Spark reaches; tells whether it was there."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@dataclass
class Pipeline:
    steps: list[tuple[str, Step]]
    folder: str
    #: What this object ran.
    metrics: list[tuple[int, str, str, float]] = field(default_factory=list)

    def names(self) -> list[str]:
        return [n for n, _ in self.steps]

    def manifest(self, spark: SparkSession) -> DataFrame:
        """(run, seq, step, path, rows, columns, seconds): the finished steps; a step that ran again has its last row only."""
        try:
            found = spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest")
        except AnalysisException:
            return spark.createDataFrame([], MANIFEST)
        last = found.groupBy("step").agg(F.max_by(F.struct(*found.columns), F.struct("seq", "run")).alias("r"))
        return last.select("r.*")

    def state(self, spark: SparkSession) -> dict[str, str]:
        """The tables of the finished steps, in the order of the steps, as far as no step is missing."""
        found = {r.step: r.path for r in self.manifest(spark).collect()}  # a row a step
        out = {}
        for name in self.names():
            if name not in found:
                break
            out[name] = found[name]
        return out

    def run(self, spark: SparkSession, start: DataFrame | None = None, resume: str | bool | None = None) -> DataFrame:
        """From ``start``; or after the last finished step (``resume=True``); or from the step that ``resume`` names, with the table before it.

        Steps after the one that runs again run again as well.
        """
        names, done = self.names(), {} if resume is None else self.state(spark)
        first = 0 if resume is None else len(done) if resume is True else names.index(resume)
        if first > len(done) or first == 0 and start is None:
            raise ValueError("a run from the first step needs its input, and one from a later step the tables before it")
        df = spark.read.parquet(done[names[first - 1]]) if first else start
        if first == 0:
            remove(spark, f"{self.folder}/manifest")
        run = uuid.uuid4().hex
        base = self._last_seq(spark)
        for k, (name, step) in enumerate(self.steps[first:]):
            path, began = f"{self.folder}/{name}-{uuid.uuid4().hex}", time.time()
            step(df).write.parquet(path)
            df = spark.read.parquet(path)
            row = (run, base + k + 1, name, path, df.count(), len(df.columns), round(time.time() - began, 3))
            spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")
            self.metrics.append((first + k, name, "rows", float(row[4])))
        return df

    def _last_seq(self, spark: SparkSession) -> int:
        return self.manifest(spark).agg(F.coalesce(F.max("seq"), F.lit(0)).alias("m")).first().m

    def step_metrics(self, spark: SparkSession) -> DataFrame:
        """(seq, step, metric, value) of the steps that this object ran."""
        return spark.createDataFrame(self.metrics, "seq int, step string, metric string, value double")

    def all_metrics(self, spark: SparkSession) -> DataFrame:
        """(seq, step, metric, value) of all finished steps, whoever ran them."""
        values = F.map_from_arrays(F.array(F.lit("rows"), F.lit("columns"), F.lit("seconds")), F.array(F.col("rows").cast("double"), F.col("columns").cast("double"), "seconds"))
        return self.manifest(spark).select("seq", "step", F.explode(values).alias("metric", "value"))

    def finish(self, spark: SparkSession, keep_manifest: bool = False) -> str:
        """After success: removes the tables of all steps but the last, abandoned attempts too, and gives the last one's path."""
        done = self.state(spark)
        if len(done) < len(self.steps):
            raise ValueError(f"not finished: {self.names()[len(done)]}")
        last = done[self.names()[-1]]
        attempt = re.compile(rf"(?:{'|'.join(map(re.escape, self.names()))})-[0-9a-f]{{32}}")
        for r in listing(spark, self.folder, deep=False).collect():  # a row an attempt
            if attempt.fullmatch(r.name) and not last.endswith(f"/{r.name}"):
                remove(spark, f"{self.folder}/{r.name}")
        if not keep_manifest:
            remove(spark, f"{self.folder}/manifest")
        return last


def curation(items: DataFrame, replies: DataFrame, folder: str) -> Pipeline:
    """Records (record_id, orm_code, caller, code_value, list_state, ...) tagged, cleaned and judged."""

    def tag(records: DataFrame) -> DataFrame:
        return records.withColumn("matched_keywords", text.matched_keywords(F.col("code_value"), F.col("orm_code")))

    def cleaned(records: DataFrame) -> DataFrame:
        return records.drop("list_state").join(clean.clean_records(records, items), "record_id")

    def complete(records: DataFrame) -> DataFrame:
        judged = clean.tag_completeness(records, replies).select("record_id", "is_complete", F.col("reason").alias("incomplete_reason"), "list_state")
        return records.drop("list_state").join(judged, "record_id")

    def correct(records: DataFrame) -> DataFrame:
        return records.join(clean.tag_correctness(records, replies).select("record_id", "is_correct"), "record_id")

    return Pipeline([("keyword_tagging", tag), ("sql_cleaning", cleaned), ("completeness", complete), ("correctness", correct)], folder)


def fixes(records: DataFrame, items: DataFrame, decisions: DataFrame) -> DataFrame:
    """Records after review: removals and additions applied."""
    return diff.apply_fixes(records, items, *diff.fix_maps(decisions), text.REDUNDANT)

"""The reward log as a file stream: JSON lines, malformed ones skipped, appended once per batch.

A file arrives whole in one batch, so a batch can number its lines by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scoring import band
from ..sources import lines

FIELDS = {"timestamp": "long", "function_name": "string", "score": "double"}


def scored(raw: DataFrame) -> DataFrame:
    """Rows (value, ...) -> (timestamp, function_name, score, band, ...) of those that are JSON with a score."""
    v = F.try_parse_json("value")
    others = [c for c in raw.columns if c != "value"]
    rows = raw.select(*[F.try_variant_get(v, f"$.{n}", t).alias(n) for n, t in FIELDS.items()], *others)
    return rows.where("score is not null").withColumn("band", band(F.col("score")))


def read(spark: SparkSession, path: str, streaming: bool = True, numbered: bool = False) -> DataFrame:
    """(timestamp, function_name, score, band) of the lines that can be read; with ``numbered`` of a batch read also source and line_number."""
    if not streaming:
        return scored(lines.read(spark, path) if numbered else spark.read.text(path))
    return scored(spark.readStream.schema("value string").text(path))


def append(stream: DataFrame, table_path: str, checkpoint: str):
    """Starts the append of each batch to a Parquet table; available data, then stop."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", table_path).trigger(availableNow=True).start()


def append_numbered(spark: SparkSession, path: str, table_path: str, checkpoint: str):
    """As ``append``, with source and line_number; a batch that is repeated after a failure replaces what it wrote."""
    raw = lines.split_of(spark.readStream.schema("value string").text(path))

    def write(batch: DataFrame, number: int) -> None:
        scored(lines.numbered(lines.placed(batch))).write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    return raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()

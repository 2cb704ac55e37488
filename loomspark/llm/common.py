"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of an Arrow batch of rows that may each hold a whole text. Spark's own limit is in rows alone, so that executors
#: fill and send tens of MB a task at a time, and Python workers make objects of as much.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH = 4 << 20
#: Column names that the operators add start with this, so that extra input
#: columns never clash with them.
OWN = "__lm_"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the cluster's ``spark.checkpoint.dir``; only in a local session, as
    in tests, where that is unset, a temporary folder is chosen and set. The
    tables in it serve lazy results, so whoever sets the folder clears it.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="loomspark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage at a table that outlives any executor and lets later
    readers prune columns.
    """
    path = f"{shared_dir(df.sparkSession)}/loomspark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_kinds(df: DataFrame, name: str) -> DataFrame:
    """``stage`` for rows of several kinds: a folder for each value of ``kind``, of which a reader opens only its own."""
    path = f"{shared_dir(df.sparkSession)}/loomspark/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy("kind").parquet(path)
    others = [f for f in df.schema.fields if f.name != "kind"]
    return df.sparkSession.read.schema(StructType([*others, df.schema["kind"]])).parquet(path)


def bucketed(df: DataFrame, by: str, n: int, name: str, dealt: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder in ``n`` buckets sorted by a column, and read it back.

    Later groupings by and joins on the column find their rows in place.
    ``dealt``: the rows already lie in ``n`` partitions by that column.
    """
    spark, ident = df.sparkSession, f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    rows = df if dealt else df.repartition(n, by)
    rows.write.option("path", f"{shared_dir(spark)}/loomspark/{ident}").bucketBy(n, by).sortBy(by).saveAsTable(ident)
    found = spark.table(ident)
    found.schema  # resolves the files; the name isn't needed any more, dropping it leaves them
    spark.sql(f"DROP TABLE {ident}")
    return found


@lru_cache(4)
def compressor(level: int):
    """This worker's compressor; making one costs more than most bodies."""
    import zstandard

    return zstandard.ZstdCompressor(level=level)


@lru_cache(1)
def decompressor():
    import zstandard

    return zstandard.ZstdDecompressor()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of ``BATCH`` bytes for the queries that run meanwhile."""
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, str(BATCH))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_BYTES) if before is None else spark.conf.set(BATCH_BYTES, before)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of the driver, a row at least, as Arrow columns: lists of rows would take another pair of Python workers in each executor."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = StructType.fromDDL(schema)
    arrow = to_arrow_schema(wanted)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow), wanted)


def slots(spark: SparkSession) -> int:
    """How many ways rows are dealt: what the session shuffles into."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_of(column: str = "text"):
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def spread_lookup(members: DataFrame, found: DataFrame, key: str, ident: str, n: int) -> DataFrame:
    """Inner-join ``members`` to ``found`` (one row a key) when a key may hold a third of all members.

    Members are dealt into ``n`` slots by ``ident``. Only the distinct (slot,
    key) pairs, at most ``n`` for any key, meet ``found``; the answers go back
    by (slot, key), of which a hot key has ``n``.
    """
    slot = OWN + "slot"
    dealt = members.withColumn(slot, F.pmod(F.xxhash64(F.col(ident), F.lit(17)), F.lit(n)).cast("int"))
    asked = dealt.groupBy(slot, key).agg(F.lit(1).alias(OWN + "one")).drop(OWN + "one")
    return dealt.join(asked.join(found, key), [slot, key]).drop(slot)

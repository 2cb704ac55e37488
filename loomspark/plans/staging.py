"""Tables that a query uses more than once are written to the shared folder, so that they are worked out once."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="loomspark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder; the table outlives any executor."""
    path = f"{shared_folder(df.sparkSession)}/loomspark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Functions for SQL users: ``register(spark)`` makes the parsers callable from ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import code, fingerprint

FUNCTIONS = {"clean_code": code.cleaned, "balanced_json": code.balanced, "statements_in": code.extracted, "sql_features": fingerprint.parsed}


def register(spark: SparkSession) -> list[str]:
    """Registers them for the session and gives their names."""
    for name, function in FUNCTIONS.items():
        spark.udf.register(name, function)
    return sorted(FUNCTIONS)

"""Samples and splits by hash order, so that reruns agree.

A hash threshold finds the global cut: rows are ranked only inside the one
bucket of the hash that the cut falls into, never all in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def lowest(df: DataFrame, n: int, order: str, *tie: str) -> DataFrame:
    """The ``n`` rows of the smallest (order, tie); ``order`` is a bigint spread evenly over its range."""
    bucket = F.shiftright(F.col(order), 54) + (BUCKETS // 2)
    counted = df.groupBy(bucket.alias("__b")).count()
    upto = F.coalesce(F.sum("count").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # BUCKETS rows at most
    cut = counted.withColumn("__before", upto).select("__b", "__before", "count")
    met = df.withColumn("__b", bucket).join(F.broadcast(cut), "__b").where(F.col("__before") < n)
    rank = F.row_number().over(Window.partitionBy("__b").orderBy(order, *tie))
    whole = met.where(F.col("__before") + F.col("count") <= n)
    part = met.where(F.col("__before") + F.col("count") > n).withColumn("__rank", rank).where(F.col("__before") + F.col("__rank") <= n).drop("__rank")
    return whole.unionByName(part).drop("__b", "__before", "count")


def sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows without replacement, all if there are fewer."""
    return lowest(df.withColumn("__h", F.xxhash64(F.col(key), F.lit(seed))), n, "__h", key).drop("__h")


def quotas(df: DataFrame, stratum: str, n: int) -> DataFrame:
    """(stratum, size, quota): max(1, n * share)."""
    sizes = df.groupBy(stratum).agg(F.count("*").alias("size"))
    total = sizes.agg(F.sum("size").alias("total"))
    return sizes.crossJoin(F.broadcast(total)).select(stratum, "size", F.greatest(F.lit(1), F.floor(F.col("size") * n / F.col("total"))).cast("long").alias("quota"))


def within_quota(df: DataFrame, stratum: str, quota: DataFrame, order: str, *tie: str) -> DataFrame:
    """Adds ``__in``: is the row among its stratum's ``quota`` smallest of (order, tie)? Only one bucket of a stratum is ranked."""
    bucket = F.shiftright(F.col(order), 54) + (BUCKETS // 2)
    marked = df.withColumn("__b", bucket)
    counted = marked.groupBy(F.col(stratum).alias("__s"), "__b").agg(F.count("*").alias("__n"))
    upto = F.coalesce(F.sum("__n").over(Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # BUCKETS rows a stratum at most
    cut = counted.withColumn("__before", upto).alias("c").join(quota.select(F.col(stratum).alias("__q"), "quota"), F.col("__s").eqNullSafe(F.col("__q"))).select("__s", F.col("__b").alias("__c"), "__before", "__n", "quota")
    met = marked.join(cut, F.col(stratum).eqNullSafe(F.col("__s")) & (F.col("__b") == F.col("__c"))).drop("__s", "__c")
    split = (F.col("__before") < F.col("quota")) & (F.col("__before") + F.col("__n") > F.col("quota"))
    whole = met.where(~split).withColumn("__in", F.col("__before") < F.col("quota"))
    rank = F.row_number().over(Window.partitionBy(stratum, "__b").orderBy(order, *tie))
    part = met.where(split).withColumn("__in", F.col("__before") + rank <= F.col("quota"))
    return whole.unionByName(part).drop("__b", "__before", "__n", "quota")


def stratified(df: DataFrame, stratum: str, n: int, key: str, seed: int = 42) -> DataFrame:
    """Each stratum's quota in hash order, then rows in hash order up to n in all."""
    hashed = df.withColumn("__h", F.xxhash64(F.col(key), F.lit(seed)))
    met = within_quota(hashed, stratum, quotas(df, stratum, n), "__h", key)
    # rows within quota come first: half of the hash range each
    order = F.shiftright("__h", 1) + F.when(F.col("__in"), F.lit(-(1 << 62))).otherwise(F.lit(1 << 62))
    return lowest(met.withColumn("__o", order), n, "__o", key).drop("__o", "__h", "__in")


def guaranteed(df: DataFrame, privileged: str, n: int, key: str, seed: int = 42) -> DataFrame:
    """All privileged rows (up to n), filled to n with others in hash order."""
    order = F.shiftright(F.xxhash64(F.col(key), F.lit(seed)), 1) + F.when(F.col(privileged), F.lit(-(1 << 62))).otherwise(F.lit(1 << 62))
    return lowest(df.withColumn("__o", order), n, "__o", key).drop("__o")


def train_val(df: DataFrame, ratio: float, key: str, seed: int = 42) -> DataFrame:
    """Adds split: int(n * ratio) rows in hash order are val."""
    n = int(df.count() * ratio)
    val = sample(df.select(key), n, key, seed).withColumn("__val", F.lit(True))
    return df.join(val, key, "left").withColumn("split", F.when(F.col("__val"), "val").otherwise("train")).drop("__val")

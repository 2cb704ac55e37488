"""Text files as numbered lines, whatever the number of splits a file is read in.

Spark reads a file in splits and lines within a split in order. Each split's
lines are counted, the counts of a file added up in the order of its splits, and
a line's number is its place in its split plus the lines before. Two passes
over the text, no sort; the second table has a row a split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def split_of(lines: DataFrame) -> DataFrame:
    """Adds source and split to rows (value) of a text source, a stream too."""
    return lines.select("*", F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("split"))


def placed(lines: DataFrame) -> DataFrame:
    """Adds a running number to ``split_of`` rows of a batch; it rises within a split."""
    return lines.withColumn("i", F.monotonically_increasing_id())


def numbered(rows: DataFrame) -> DataFrame:
    """``placed`` rows with ``line_number``, from 1, in place of split and running number."""
    splits = rows.groupBy("source", "split").agg(F.min("i").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = splits.select("source", "split", (before - F.col("first") + 1).alias("shift"))
    return rows.join(starts, ["source", "split"]).withColumn("line_number", F.col("i") + F.col("shift")).drop("split", "i", "shift")


def read(spark: SparkSession, path) -> DataFrame:
    """(value, source, line_number) of text files."""
    return numbered(placed(split_of(spark.read.text(path))))


def json_lines(spark: SparkSession, path) -> DataFrame:
    """(source, line_number, row variant): blank and malformed lines are left out, but count."""
    found = read(spark, path).withColumn("row", F.try_parse_json("value"))
    return found.where("row is not null").select("source", "line_number", "row")


def head(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` lines over all files in the order of their paths."""
    counts = rows.groupBy("source").agg(F.max("line_number").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a file
    starts = counts.withColumn("__before", before).where(F.col("__before") < n).drop("__n")
    return rows.join(starts, "source").where(F.col("__before") + F.col("line_number") <= n).drop("__before")

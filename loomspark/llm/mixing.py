"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sizes are summed by source, and weights are turned into word targets by water
filling: a source takes its share until it reaches ``max_epochs`` times its
size; what is left over is shared again by weight. A target of e complete
epochs and a fraction takes every document e times, then documents in the
order of their exponential keys ``-ln(u) / quality`` until the rest is filled.

A source may hold a third of all rows, so no window runs over a source.
Documents are put in buckets of the key's rank-preserving transform
``1 - exp(-key)``; the buckets of a source are prefix-summed (their number is
fixed by the row count over ``BUCKET_ROWS``), and only the one bucket that a
budget cuts is sorted and prefix-summed document by document.

Defined results: a null text has no words; documents without words and
sources without words take 0; a null or non-positive quality counts as 1; a
null source is a source of its own, the last one; rows that repeat an
identifier are separate documents that share a key and follow one another in
any order; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, stage, text_of

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKET_ROWS = 2000


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def unit_key(ident: str, seed: int) -> Column:
    """A number in (0, 1) from 52 bits of an MD5, so that reruns and other engines agree."""
    cut = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(ident).cast("string"), F.lit("null")), F.lit(f":{seed}"))), 1, 13), 16, 10)
    return (cut.cast("double") + 0.5) / F.lit(float(2**52))


def water_fill(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> (source, source_size, target). One row a source, so the windows are small.

    Sources ordered by size over weight reach their cap in that order. Cap the
    first k of them; the others share the rest by weight. The smallest k for
    which the next source stays under its cap gives the targets.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weighed = sources.withColumn("rank", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int")).cast("double")
    )
    ratio = F.col("source_size") / F.col("weight")
    before = Window.orderBy(ratio, "rank").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - max_epochs * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    leveled = weighed.withColumn("level", level).withColumn("k", F.row_number().over(Window.orderBy(ratio, "rank")))
    # the water level is that of the first source in order whose cap is not passed
    fits = max_epochs * F.col("source_size") >= F.col("weight") * F.col("level")
    at = F.min(F.when(fits, F.struct("k", "level"))).over(every)["level"]
    return leveled.withColumn("water", at).select("source", "source_size", F.round(F.least(F.lit(1.0) * max_epochs * F.col("source_size"), F.col("weight") * F.col("water")), 6).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", quality: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 11) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source.

    ``quality``: (doc_id, quality), the weight of a document's key; of several
    the largest counts. Documents of higher quality are taken sooner; others
    than those listed have quality 1.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(text_col).alias("size"))
    if quality is None:
        narrow = narrow.withColumn("quality", F.lit(1.0))
    else:
        q = F.col("quality").cast("double")
        best = quality.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.when(q > 0, q)).alias("quality"))
        narrow = narrow.join(best, "doc_id", "left").withColumn("quality", F.coalesce("quality", F.lit(1.0)))
    key = -F.log(unit_key("doc_id", seed)) / F.col("quality")
    rows = stage(narrow.withColumn("key", key), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    plan = water_fill(sources.select("source", "source_size")).withColumnRenamed("source", OWN + "s")
    plan = sources.select("source", "n").join(plan, F.col("source").eqNullSafe(F.col(OWN + "s"))).drop(OWN + "s")
    plan = (
        plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))).otherwise(0).cast("long"))
        .withColumn("rest", F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0)))
        .withColumn("n_buckets", F.greatest(F.ceil(F.col("n") / F.lit(BUCKET_ROWS)), F.lit(1)).cast("long"))
        .drop("n")
    )
    plan = stage(plan, "targets")
    small = plan.withColumnRenamed("source", OWN + "s")
    # every source is one row of plan: the join is on a short table, which Spark broadcasts when it is small and else splits
    met = rows.join(small, F.col("source").eqNullSafe(F.col(OWN + "s"))).drop(OWN + "s")
    buckets = F.least(F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * F.col("n_buckets")), F.col("n_buckets") - 1).cast("long")
    met = met.withColumn("bucket", buckets)
    held = met.groupBy("source", "bucket").agg(F.sum("size").alias("held"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("held").over(upto), F.lit(0))).withColumnsRenamed({"source": OWN + "s", "bucket": OWN + "b"})
    met = met.join(held, F.col("source").eqNullSafe(F.col(OWN + "s")) & (F.col("bucket") == F.col(OWN + "b"))).drop(OWN + "s", OWN + "b")
    whole = F.col("before") + F.col("held") <= F.col("rest")
    none = F.col("before") >= F.col("rest")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    cut = met.where(~whole & ~none).withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # the document that the budget falls into is taken if most of it is within
    cut = cut.withColumn("more", (F.col("before") + F.col("size") / 2 <= F.col("rest")).cast("long"))
    rest = met.where(whole | none).withColumn("more", whole.cast("long"))
    return rest.unionByName(cut).select("doc_id", "size", "source_size", "target", ((F.col("epochs") + F.col("more")) * F.col("size")).alias("taken"), "source", (F.col("epochs") + F.col("more")).alias("copies"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken."""
    ident, text = options.get("id_col", "doc_id"), options.get("text_col", "text")
    took = mix(docs, **options).where("copies > 0")
    times = took.groupBy("doc_id", "size").agg(F.max("copies").alias(OWN + "copies")).withColumnsRenamed({"doc_id": OWN + "id", "size": OWN + "size"})
    met = docs.withColumn(OWN + "n", n_words(text)).join(times, F.col(ident).eqNullSafe(F.col(OWN + "id")) & (F.col(OWN + "n") == F.col(OWN + "size")))
    return met.withColumn(OWN + "copy", F.explode(F.sequence(F.lit(1), F.col(OWN + "copies").cast("int")))).select(*docs.columns)

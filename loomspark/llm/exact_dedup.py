"""Exact deduplication: a tree merge of sorted digest runs.

Every row becomes a (SHA-256, identifier) pair. The rows are dealt into 4^r
leaves, each of which sorts its pairs by digest and collapses them into one run
with a row per digest. In r rounds, each of which does two binomial ones at
once, groups of four partitions exchange their runs: in round i a partition's
i-th base-4 digit becomes the digest's i-th digit, and each partition brings
the four sorted runs that it gets into one order and merges equal neighbours,
keeping the retained identifier of a digest and its count. After r rounds a
partition owns one range of digests. A digest that a third of all rows share is
one row in any run, so no level has a hot partition. Only 60-byte rows move;
texts are read once.

Every level verifies its merge: rows of one digest must agree in byte length
and in an independent 64-bit hash, otherwise the query fails. The aggregates
are over structs, which Spark computes by going through sorted rows, so a merge
holds one digest at a time.

Defined results: a null text counts as empty; a null identifier never wins
against a number; rows that repeat an identifier and a text are members like
any others and share its flags; an empty table gives an empty result; columns
other than the identifier and the text are ignored by ``exact_classes`` and
kept by ``exact_dedup``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import OWN, slots, spread_lookup, stage, text_of

FAN_IN = 4


def _merge(runs: DataFrame, keep: str) -> DataFrame:
    """Sorted runs of each place -> one sorted run with a row per digest, retaining one identifier and verifying the digest's rows."""
    best, proof = (F.max if keep == "max" else F.min), F.struct("n_bytes", "proof")
    # a null identifier never wins: with the greatest kept it is the least of all, with the least one it comes last
    ident = F.struct(F.col("keep_id").isNotNull() if keep == "max" else F.col("keep_id").isNull(), "keep_id")
    merged = runs.sortWithinPartitions("at", "digest").groupBy("at", "digest").agg(best(ident).alias("best"), F.sum("group_size").alias("group_size"), F.min(proof).alias("one"), F.max(proof).alias("other"))
    sound = F.when(F.col("one") == F.col("other"), F.col("group_size")).otherwise(F.raise_error(F.lit("different texts share a digest")).cast("long"))
    return merged.select("at", "digest", F.col("best.keep_id").alias("keep_id"), sound.alias("group_size"), "one.n_bytes", "one.proof")


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    spark = docs.sparkSession
    text = text_of(text_col)
    members = stage(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
            F.octet_length(text).cast("long").alias("n_bytes"),
            F.xxhash64(text).alias("proof"),
        ),
        "digests",
    )
    rounds = 1
    while FAN_IN**rounds < slots(spark):
        rounds += 1
    n = FAN_IN**rounds
    place = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(n)).cast("int")
    pairs = members.select(place.alias("at"), "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "n_bytes", "proof")
    runs = _merge(pairs.repartitionById(n, F.col("at")), keep)
    prefix = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    for i in range(rounds):
        unit = FAN_IN**i
        digit = F.pmod(F.floor(prefix / F.lit(unit)), F.lit(FAN_IN)).cast("int")
        own = F.pmod(F.floor(F.col("at") / F.lit(unit)), F.lit(FAN_IN)).cast("int")
        runs = _merge(runs.withColumn("at", F.col("at") + (digit - own) * unit).repartitionById(n, F.col("at")), keep)
    found = runs.select("digest", "keep_id", "group_size")
    return spread_lookup(members.select("doc_id", "digest"), found, "digest", "doc_id", n).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, each identifier once.

    Rows that share identifier and text stay as one row. Rows that share only
    the identifier are different documents and are judged by their texts.
    """
    own = [OWN + "keep", OWN + "sha"]
    kept = exact_classes(docs, id_col, text_col, keep).where("kept").select(F.col("doc_id").alias(own[0]), F.col("text_sha256").alias(own[1])).distinct()
    # the digest is part of the key: an identifier may come with several texts
    marked = docs.withColumn(own[1], F.sha2(text_of(text_col).cast("binary"), 256))
    met = marked.join(kept.withColumnRenamed(own[1], OWN + "want"), F.col(id_col).cast("long").eqNullSafe(F.col(own[0])) & (F.col(own[1]) == F.col(OWN + "want")))
    return met.dropDuplicates([own[0], own[1]]).select(*docs.columns)

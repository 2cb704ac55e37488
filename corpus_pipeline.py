"""The corpus pipeline: five stages of the training-data operators, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's result to
the shared folder and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspark.llm import exact_dedup, language_id, mixing, near_copies, piece_lattice
from loomspark.llm.common import BATCH, BATCH_BYTES, stage, table
from loomspark.llm.queries import label_quality, vocabulary

#: A document goes if its language is recognised with less than this probability.
LEAST_SCORE = 0.5
#: Characters of text whose units a worker numbers at a time; the workers of earlier stages still hold memory.
BLOCK_CHARS = 12 << 20


def bounded(spark: SparkSession) -> None:
    """Rows of whole texts go to Python workers in batches of ``BATCH`` bytes; results are lazy, so the session keeps the setting."""
    spark.conf.set(BATCH_BYTES, str(BATCH))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those of which no language is likely, go."""
    bounded(spark)
    return language_id.select_known(docs, language_id.train(docs), LEAST_SCORE)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest identifier stays."""
    return exact_dedup.exact_dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 5-word shingles of similarity 0.8 or more, the row with the smallest identifier stays.

    op10's fingerprints, pigeonring chains and contraction come first, with more bits; then what they can't reach.
    """
    bounded(spark)
    return near_copies.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is repeated as often as the mix takes it, and goes if it isn't taken."""
    return mixing.mixture(docs, quality=label_quality(table(spark, sf_dir, "labels")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as SentencePiece ids: doc_id, n_pieces, ids, round_trip."""
    bounded(spark)
    return piece_lattice.encode(docs, vocabulary("piece_bpe_32k.model"), from_files=True, block_chars=BLOCK_CHARS)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mix_sources", mixed),
    ("sentencepiece", encoded),
]

#: Neither the classifier nor the fingerprints nor the pieces can be expressed in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs

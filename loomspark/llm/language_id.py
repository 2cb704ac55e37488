"""Language identification by sparse multinomial logistic regression.

Texts are lower-cased, runs of anything but letters become one space, and
character n-grams of 1 to 3 are hashed into ``DIMS`` features, weighted by
(1 + log tf) * idf and scaled to length 1. A softmax over the languages is
trained with the follow-the-regularised-leader rule and elastic-net penalties,
which leaves most weights at exactly zero; a temperature fitted on a part of
the sample that the training did not see calibrates the probabilities.

The classifier, with its idf, is fitted on a bounded sample of labelled rows:
about ``sample`` rows in all, the same number for each language, chosen by a
hash of the identifier. Their features (at most DIMS a row) come to the driver.
Predictions read every text whole.

Defined results: a null text, and one without a letter, is ``und`` with score
0; so is every text if no row is labelled. Rows with a null identifier are
never trained on and count as not held out. Repeated rows are predicted one by
one; an empty table gives an empty result; other columns are ignored by
``predict`` and kept by ``select_known``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import OWN

DIMS = 1 << 16
SAMPLE = 6000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
UNKNOWN = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")


def grams(text: str) -> np.ndarray | None:
    """Hashed n-grams of a text with repeats, or None if it has no letter."""
    plain = NOT_LETTERS.sub(" ", text.lower())
    if not any(map(str.isalpha, plain)):
        return None
    a = np.frombuffer(f" {plain.strip()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    one = a * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + one[2:]
    every = np.concatenate((one, two, three))
    return (every ^ (every >> np.uint32(16))) & np.uint32(DIMS - 1)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(feature numbers, 1 + log tf)."""
    g = grams(text) if text else None
    if g is None:
        return None
    counts = np.bincount(g, minlength=DIMS)
    at = np.flatnonzero(counts)
    return at, 1.0 + np.log(counts[at])


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIMS x languages
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, at: np.ndarray, tf: np.ndarray) -> np.ndarray:
        x = tf * self.idf[at]
        return (x / (np.sqrt(x @ x) or 1.0)) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text)
        if found is None or not self.languages:
            return UNKNOWN, 0.0
        z = self.logits(*found) / self.temperature
        p = np.exp(z - z.max())
        return self.languages[int(p.argmax())], float(p.max() / p.sum())


def held_out(ident: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(ident).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sample_features(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list:
    """[(order, language, features)] of the bounded sample, in a fixed order."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out("id"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row a language
    if not counts:
        return []
    each = max(20, sample // len(counts))
    order = F.xxhash64(F.col("id"), F.lit(8))
    shares = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, int(min(1.0, each / n) * (2**62)))])
    chosen = rows.withColumn("order", order).where(F.shiftrightunsigned("order", 2) < shares[F.col("lang")])

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            out = [(o, lang, f[0], f[1]) for o, lang, t in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True) if (f := features(t))]
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.list_(pa.int32())), pa.array(cols[3], pa.list_(pa.float32()))], names=["order", "lang", "at", "tf"])

    got = chosen.select("order", "lang", "text").mapInArrow(scan, "order long, lang string, at array<int>, tf array<float>").toArrow()
    # views of the table's own memory: thousands of small copies would stay in the driver's heap
    rows = zip(got["order"].to_pylist(), got["lang"].to_pylist(), (np.asarray(x.values) for x in got["at"]), (np.asarray(x.values) for x in got["tf"]), strict=True)
    return sorted(((o, lang, at, tf) for o, lang, at, tf in rows), key=lambda r: (r[0], r[1]))


def fit(rows: list, epochs: int = EPOCHS) -> Model:
    """Train on four fifths of the rows, calibrate on the rest."""
    languages = sorted({r[1] for r in rows})
    model = Model(languages, np.ones(DIMS), np.zeros((DIMS, len(languages))), np.zeros(len(languages)))
    train, calibrate = [r for i, r in enumerate(rows) if i % 5], [r for i, r in enumerate(rows) if not i % 5]
    train = train or rows
    if len(languages) < 2:
        return model
    df = np.zeros(DIMS)
    for _, _, at, _ in train:
        df[at] += 1
    model.idf = np.log((1 + len(train)) / (1 + df)) + 1.0
    # follow-the-regularised-leader; the last row is the bias
    z, n = np.zeros((DIMS + 1, len(languages))), np.zeros((DIMS + 1, len(languages)))

    def leader(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for _, lang, at, tf in train:
            x = tf * model.idf[at]
            x = np.append(x / np.sqrt(x @ x), 1.0)
            every = np.append(at, DIMS)
            w = leader(every)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[languages.index(lang)] -= 1.0
            g = np.outer(x, p)
            grown = n[every] + g * g
            z[every] += g - (np.sqrt(grown) - np.sqrt(n[every])) / ALPHA * w
            n[every] = grown
    final = leader(np.arange(DIMS + 1))
    model.weights, model.bias = final[:-1], final[-1]
    if calibrate:
        scores = np.array([model.logits(at, tf) for _, _, at, tf in calibrate])
        right = np.array([languages.index(r[1]) for r in calibrate])

        def loss(t: float) -> float:
            s = scores / t
            top = s.max(axis=1, keepdims=True)
            return float(np.mean(np.log(np.exp(s - top).sum(axis=1)) + top[:, 0] - s[np.arange(len(s)), right]))

        model.temperature = min(np.geomspace(0.05, 20, 121).tolist(), key=loss)
    return model


def train(docs: DataFrame, sample: int = SAMPLE, **columns) -> Model:
    import pyarrow as pa

    model = fit(sample_features(docs, sample, **columns))
    pa.default_memory_pool().release_unused()  # of the features, which the driver needs no more
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # DIMS numbers a language

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = sent.value
        for b in batches:
            found = [own.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out(id_col).alias("held_out"))
    return rows.mapInArrow(scan, "doc_id long, held_out boolean, lang_pred string, score double")


def select_known(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is recognised with probability ``least`` or more."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(texts):
        return texts.map(lambda t: (f := sent.value.predict(t))[0] != UNKNOWN and f[1] >= least).astype(bool)

    return docs.withColumn(OWN + "known", known(F.col(text_col).cast("string"))).where(OWN + "known").drop(OWN + "known")

import itertools
import os
import zlib
from collections import Counter

import pytest
import sentencepiece
import public_tokenizers

import corpus_pipeline
from loomspark.llm import language_id, piece_lattice
from loomspark.llm.common import BATCH_BYTES, stage
from loomspark.llm.near_copies import shingles, similarity

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain_kept(rows):
    """Identifiers that stay: the smallest of each group of texts linked by 5-word shingles of similarity 0.8 or more."""
    own = [(d, shingles(t)) for d, t in rows]
    root = {d: d for d, _ in own}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for (d, a), (e, b) in itertools.combinations(own, 2):
        if similarity(a, b) >= 0.8:
            low, high = sorted((find(d), find(e)))
            root[high] = low
    return sorted(d for d in root if find(d) == d)


def test_stages(spark):
    """Each stage against a plain version on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), name)
        kept.append(docs.collect())
    known, exact, near, mixed, encoded = kept
    assert all(r.text and any(map(str.isalpha, r.text)) for r in known)
    best = {}
    for r in known:
        best[r.text] = max(best.get(r.text, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(best.values())
    least = plain_kept([(r.doc_id, r.text) for r in exact])
    assert sorted(r.doc_id for r in near) == least
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3 and {r.doc_id for r in mixed} <= set(least)
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((r.doc_id, zlib.crc32(str(sp.encode(r.text)).encode())) for r in mixed)
    assert Counter((r.doc_id, zlib.crc32(str(list(r.ids)).encode())) for r in encoded) == want
    assert all(r.round_trip for r in encoded)


ODD = "doc_id long, text string, lang string, source string, n_chars long, block long, unit string, keep_id long, digest string, mark int, fp long"


def tables(spark, tmp_path, rows):
    spark.createDataFrame(rows, ODD).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_run_on_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, [])).collect() == []


def test_run_on_nulls_ties_and_clashing_columns(spark, tmp_path):
    """Null and word-less texts go; of equal and near texts one row stays; columns of other operators' names do no harm."""
    words = [f"word{i}" for i in range(60)]
    rows = [(i, " ".join(words[i % 7 :]) + f" tail{i}", "en", None if i % 3 else "s", 1, 1, "u", 2, "d", 3, 4) for i in range(12)]
    rows += [(100, None, "en", "s", None, None, None, None, None, None, None), (101, " ", None, None, *[None] * 7), (102, rows[0][1], "en", "s", *[None] * 7), (None, "no number but words", "en", "s", *[None] * 7)]
    sf = tables(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, sf)
        assert out.columns == docs.columns, name
        docs = stage(out, name)
    got = corpus_pipeline.run(spark, sf).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {(r[0], r[1]) for r in rows}
    assert got and all(r.doc_id not in (100, 101) for r in got)
    assert all(any(d == r.doc_id and sp.encode(t or "") == list(r.ids) for d, t in texts) for r in got)


def test_memory_of_driver_and_workers(spark):
    """The driver keeps views of the sample's table instead of thousands of arrays; the vocabulary takes no Python workers; batches are bounded."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language_id.sample_features(docs)
    assert rows and not any(x.flags.owndata for r in rows for x in r[2:])
    path = public_tokenizers.path("piece_bpe_32k.model")
    for df in (piece_lattice.piece_table(spark, path), piece_lattice.reach_table(spark, path)):
        assert "ExistingRDD" not in df._jdf.queryExecution().toString()
    spark.conf.unset(BATCH_BYTES)
    dict(corpus_pipeline.STAGES)["sentencepiece"](spark, docs.limit(1), SF)
    assert int(spark.conf.get(BATCH_BYTES)) <= 4 << 20

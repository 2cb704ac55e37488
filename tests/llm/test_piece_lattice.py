"""Units of any length go through the lattice, and blocks end anywhere."""

import random

import public_tokenizers
import pytest

from loomspark.llm import blocks, piece_lattice

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def same_as_library(spark, texts):
    sp = piece_lattice.model(PIECES)
    got = piece_lattice.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PIECES).collect()
    assert {r.doc_id: list(r.ids) for r in got} == {i: sp.encode(t) for i, t in enumerate(texts)}
    return {r.doc_id: r.round_trip for r in got}


def test_texts_without_spaces(spark):
    rng = random.Random(1)
    chinese = "".join(chr(rng.choice(range(0x4E00, 0x5200))) for _ in range(5000))
    url = "https://example.org/" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(280))
    longest = "".join(rng.choice(("th", "ing", "er", "on", "a")) for _ in range(700))
    assert set(same_as_library(spark, [chinese, url, longest, "a" * 3000, "่ก" * 500]).values()) == {True}


def test_words_about_the_bounds_of_a_long(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("thingeroa") for _ in range(k)) for k in [*range(28, 36), *range(58, 68), *range(92, 100)] for _ in range(3)]
    same_as_library(spark, [" ".join(words), *words])


def test_space_marks_and_odd_texts(spark):
    got = same_as_library(spark, [" a  b", "▁", "a▁b ▁", "\n\n x\n", "tab\tend ", "😀 é\u0301 \u0000 �"])
    assert got == {0: True, 1: False, 2: False, 3: True, 4: True, 5: True}


def test_block_boundaries(spark, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(("thing", "other", "onedly,", "x")) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    # what workers run is sent from here, so a small block is set by the class's own size
    monkeypatch.setattr(blocks, "BLOCK_CHARS", 200)
    same_as_library(spark, texts)


def test_differing_scans_are_noticed(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    sp = piece_lattice.split_units
    try:
        piece_lattice.split_units = lambda t: sp(t)[::-1]
        with pytest.raises(Exception, match="scans differ"):
            piece_lattice.encode(df, PIECES).collect()
    finally:
        piece_lattice.split_units = sp

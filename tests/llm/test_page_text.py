"""Pages find their neighbours whatever the ranges."""

from collections import Counter

import pytest

from loomspark.llm import page_text

SHELL = "<html><body><div>Site {0} menu</div><div><p>Story {0} {1} one</p><p>Story {0} {1} two</p></div><p>Imprint {0}</p></body></html>"


@pytest.mark.parametrize("n", ["1", "4", "200"])
def test_texts_do_not_depend_on_ranges(spark, n):
    rows = [(h * 100 + i, f"http://h{h}.org/p/{i}", SHELL.format(h, i)) for h, size in enumerate((1, 2, 3, 17, 1, 30)) for i in range(size)]
    want = Counter()
    for ident, url, page in rows:
        story = [f"Story {ident // 100} {ident % 100} {k}" for k in ("one", "two")]
        alone = ident // 100 in (0, 4)
        want[ident, url, "\n".join([f"Site {ident // 100} menu", *story, f"Imprint {ident // 100}"] if alone else story)] += 1
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        got = page_text.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert Counter((r.page_id, r.url, r.text) for r in got) == want and all(r.n_chars == len(r.text) for r in got)


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in page_text.page_texts(df).collect()}


def test_differencing_decides(spark):
    """The same pages without neighbours keep the site's lines, inside an article too."""
    page = "<div>Menu</div><article><h1>Head {0}</h1><p>Join our list</p><p>Text {0} a</p><p>Text {0} b</p></article>"
    rows = [(i, f"http://a.org/{i}", page.format(i)) for i in range(5)]
    got, alone = texts(spark, rows), texts(spark, rows[:1])
    assert alone[0] == "Head 0\nJoin our list\nText 0 a\nText 0 b"
    # at the ends of a host there is one neighbour, which isn't enough inside an article
    assert got[0] == alone[0] and [got[i] for i in (1, 2, 3)] == [f"Head {i}\nText {i} a\nText {i} b" for i in (1, 2, 3)]


def test_short_article_in_a_large_template(spark):
    template = "".join(f"<p>Site line {k}</p>" for k in range(12))
    rows = [(i, f"http://a.org/{i}", template + f"<p>Own {i} a</p><p>Own {i} b</p><p>Own {i} c</p>") for i in range(4)]
    assert set(texts(spark, rows).values()) == {f"Own {i} a\nOwn {i} b\nOwn {i} c" for i in range(4)}


def test_copies_are_no_neighbours(spark):
    shell = "<p>Menu</p>{}<p>Imprint</p>"
    rows = [(i, f"http://a.org/{i}", shell.format("<p>Same story</p><p>and more</p>")) for i in range(2)]
    rows += [(i, f"http://a.org/{i}", shell.format(f"<p>Story {i}</p>")) for i in (2, 3)]
    got = texts(spark, rows)
    assert got[0] == got[1] == "Same story\nand more" and got[2] == "Story 2" and got[3] == "Story 3"
    # nothing but copies around: markup alone judges
    assert set(texts(spark, [(i, f"http://a.org/{i}", "<p>x</p><p>y</p>") for i in range(6)]).values()) == {"x\ny"}


def test_near_copies_keep_their_text(spark):
    story = [f"Paragraph {k}" for k in range(9)]
    page = lambda lines: "<p>Menu</p>" + "".join(f"<p>{x}</p>" for x in lines) + "<p>Imprint</p>"
    rows = [(0, "http://a.org/0", page([f"Other {k}" for k in range(9)])), (1, "http://a.org/1", page(story)), (2, "http://a.org/2", page([*story[:8], "edited"])), (3, "http://a.org/3", page([f"Third {k}" for k in range(9)]))]
    got = texts(spark, rows)
    assert got[1] == "\n".join(story) and got[2] == "\n".join([*story[:8], "edited"])


def test_class_words_inside_an_article():
    page = '<article><div class="entry-header"><h1>My Title</h1></div><p class="notice-board">text</p><p>x<math>y</math></p><section id="related-work">z</section><div class="comments">c</div></article><div class="site-header">h</div>'
    assert [t for t, _ in page_text.blocks(page)] == ["My Title", "text", "xy", "z"]


def test_very_long_page(spark):
    page = "<p>Menu</p>" + "".join(f"<p>{{0}} line {k}</p>" for k in range(20000))
    rows = [(i, f"http://a.org/{i}", page.format(i)) for i in range(3)]
    got = texts(spark, rows)
    assert all(got[i].count("\n") == 19999 and got[i].startswith(f"{i} line 0\n") for i in range(3))


def plain_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@pytest.mark.parametrize("pairs", [0, 1 << 20])
def test_alignments_are_longest(pairs, monkeypatch):
    import random

    monkeypatch.setattr(page_text, "PAIRS", pairs)
    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh"[: rng.randint(1, 8)]) for _ in range(rng.randint(0, 25))] for _ in range(2))
        x, y = page_text.shared(a, b)
        assert len(x) == len(y) == plain_length(a, b)
        assert [a[i] for i in sorted(x)] == [b[j] for j in sorted(y)]


def test_alignment_of_long_pages_in_another_order():
    import time

    lines = [f"line {k}" for k in range(20000)]
    began = time.time()
    assert len(page_text.shared(lines, lines[::-1])[0]) == 1
    again = [f"line {k % 40}" for k in range(20000)]
    x, y = page_text.shared(["first", *again], [*again[7:], "last", *again[:7]])
    assert len(x) == len(y) >= 19993
    assert time.time() - began < 30


def test_articles_keep_lines_that_some_neighbours_repeat(spark):
    """Only what all pages in reach share goes, and no heading."""
    page = "<article><h1>Same head</h1><p>{0}</p><p>Site notice</p><p>Text {1} a</p><p>Text {1} b</p></article>"
    said = ["Often said", "Often said", "Often said", "Other", "Often said", "Often said"]
    got = texts(spark, [(i, f"http://a.org/{i}", page.format(s, i)) for i, s in enumerate(said)])
    assert got[2] == "Same head\nOften said\nText 2 a\nText 2 b"
    assert got[0] == "Same head\nOften said\nSite notice\nText 0 a\nText 0 b"
    # two others aren't enough
    few = texts(spark, [(i, f"http://b.org/{i}", page.format("x", i)) for i in range(3)])
    assert few[1] == "Same head\nx\nSite notice\nText 1 a\nText 1 b"


def test_containers_inside_an_article():
    page = "<main><div class='post-content header'>a</div><div class='comments-section'>b</div><ul id='user-comments'><li>c</ul><div class='share-buttons'>d</div><section class='advertisement-slot'>e</section><p class='ad-free'>f</p><div class='sidebar-note'>g</div><div class='sidebar'>h</div></main>"
    assert [t for t, _ in page_text.blocks(page)] == ["a", "f", "g"]


def test_no_page_of_the_table_loses_its_heading(spark):
    import os
    import re

    at = "/root/testdata/sf0.01/pages.parquet"
    if not os.path.exists(at):
        pytest.skip("no test tables")
    pages = spark.read.parquet(at)
    heads = {r.page_id: re.sub(r"\s+", " ", m[1]).strip() for r in pages.collect() if (m := re.search(r"<h1[^>]*>([^<&]*)</h1>", r.html or ""))}
    got = {r.page_id: r.text for r in page_text.page_texts(pages).collect()}
    assert heads and all(h in got[i].split("\n") for i, h in heads.items() if h)

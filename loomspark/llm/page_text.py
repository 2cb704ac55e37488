"""Main text of web pages: markup rules and nearest-URL page differencing.

A page becomes blocks: the text between the boundaries of block elements,
with character references decoded and white space collapsed. Elements that
are never the article by their name, role or class (menus, headers outside
the article, footers, sidebars, notices, adverts, forms, scripts, styles,
comments) take no part. A class or identifier counts by its hyphenated parts
outside the article. On containers inside it, words of comments, sharing and adverts
still count by their parts, other words only as a whole, and words of layout, such as header,
not at all. A page with an ``article`` or ``main`` element consists of what stands inside.

What markup doesn't tell, the neighbours do: pages are sorted by URL path
within each host, and each is paired with the nearest pages before and
after it. Lines are aligned by longest common subsequence, and shared lines are
deleted as the site's own. Outside an article element those go that are shared with the
nearest page of either side that isn't the same page over again. A neighbour
that shares more than half of what the other one leaves is a near copy, which
tells nothing about the site, and doesn't count. Inside an article element, whose lines the
markup vouches for, a line goes only if every page in reach shares it, ``AGREED`` at
least and some on both sides; articles that repeat each other's lines here and there
keep them. Headings stay, and nothing goes if it were more than half of an article, as then the pages are versions of one.

A host may hold a third of all pages: pages are dealt by ranges of (host,
path, ...), which cut a large host into several tasks. The ranges' bounds are
drawn from a sample of ``DRAWN`` keys a range; a first scan of the URLs finds
the ``REACH`` first and last keys of each range, and the pages of these keys go
to the neighbouring ranges as well. So a page's neighbours, and its text, don't
depend on the ranges. A task holds ``2 * REACH + 1`` pages at a time.

Defined results: a null or empty page has an empty text; a null or odd URL
belongs to a host of its own kind, paired like any other; a page without a
neighbour, or with copies alone around it, is judged by its markup; pages that
repeat an identifier are rows of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter, deque
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slots

#: Pages looked at on either side for one that isn't a copy.
REACH = 2
#: Pages that must share a line inside an article before it counts as the site's.
AGREED = 3
#: Keys drawn a range to find the bounds.
DRAWN = 100
#: HTML elements by their part in a page.
DROPPED = frozenset("script style noscript template iframe object embed svg canvas head nav footer aside form button select option textarea input dialog menu audio video".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
ARTICLE = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of a class or identifier that mark what isn't the article: of comments, sharing and adverts; of other parts; of layout.
SAID = r"ad|ads|advert|adverts|advertisement|advertising|adsense|sponsor|sponsored|share|sharing|social|comment|comments|disqus|reply|replies|respond"
OTHERS = (
    r"promo|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|footer|sidebar|side-bar|widget|cookie|cookies|consent|gdpr|notice|notification|popup|modal|overlay|newsletter|subscribe|signup|login|"
    r"related|recommended|pagination|pager|toolbar|skip-link"
)
LAYOUT = r"banner|header|masthead"
MARKED = re.compile(rf"(?:^|[\s_-])(?:{SAID}|{OTHERS}|{LAYOUT})(?:$|[\s_-])", re.I)
MARKED_INSIDE = re.compile(rf"(?:^|[\s_-])(?:{SAID})(?:$|[\s_-])|(?:^|\s)(?:{OTHERS})(?:$|\s)", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Inside the article, only these are judged by their class.
CONTAINERS = frozenset("div section aside ul ol dl table details".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
SPACES = re.compile(r"\s+")
#: An opening tag of these ends an open paragraph; the last two lists end an open element of their own kind.
ENDS_P = BLOCK - {"body", "html", "head", "title", "td", "th", "tr", "tbody", "thead", "tfoot"}
SELF_ENDING = frozenset("li dd dt p option tr td th".split())


def _apart(name: str, attributes: str, in_article: bool) -> bool:
    """Does the element stand apart from the article?"""
    if name in DROPPED or name == "header" and not in_article:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id") and (name in CONTAINERS and MARKED_INSIDE.search(value) if in_article else MARKED.search(value)):
            return True
    return bool(re.search(r"(?:^|\s)hidden(?:$|[\s=/])", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)))


def blocks(page: str | None) -> list[tuple[str, int]]:
    """(text, place) of each block, in page order; place: 0 outside an article element, 1 inside one, 2 a heading inside one."""
    out: list[tuple[str, int]] = []
    text: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # name, stands apart, is an article
    apart = articles = headings = 0
    at, page = 0, page or ""

    def flush() -> None:
        if text:
            whole = SPACES.sub(" ", html.unescape("".join(text))).strip()
            if whole:
                out.append((whole, (articles > 0) * (1 + (headings > 0))))
            text.clear()

    def close(k: int) -> None:
        """Close the open elements from the k-th."""
        nonlocal apart, articles, headings
        if any(name in BLOCK for name, *_ in open_[k:]):
            flush()
        for tag, a, b in open_[k:]:
            apart, articles, headings = apart - a, articles - b, headings - (tag in HEADINGS)
        del open_[k:]

    while m := TOKEN.search(page, at):
        if m.start() > at and not apart:
            text.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, ending = m[2].lower(), bool(m[1])
        if ending:
            k = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name), None)
            if k is not None and (name in BLOCK or not any(n in BLOCK for n, *_ in open_[k + 1 :])):
                close(k)
            elif k is not None:  # an inline element over block bounds ends without them
                _, a, b = open_.pop(k)
                apart, articles = apart - a, articles - b
            continue
        if name in VOID:
            if not apart:
                flush() if name == "hr" else text.append(" ") if name == "br" else None
            continue
        if name in ENDS_P:
            k = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] in BLOCK), None)
            if k is not None and (open_[k][0] == "p" or open_[k][0] == name and name in SELF_ENDING):
                close(k)
        elif name in SELF_ENDING and open_ and open_[-1][0] == name:
            close(len(open_) - 1)
        if name in BLOCK:
            flush()
        is_article = name in ARTICLE or 'role="main"' in m[3] or 'role="article"' in m[3]
        is_apart = _apart(name, m[3], articles > 0)
        if name in RAW or name == "title":
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if m[3].rstrip().endswith("/") and name in ("svg", "math"):
            continue
        open_.append((name, is_apart, is_article))
        apart, articles, headings = apart + is_apart, articles + is_article, headings + (name in HEADINGS)
    if at < len(page) and not apart:
        text.append(page[at:])
    flush()
    return out


#: Pairs of equal lines up to which an alignment goes through them one by one.
PAIRS = 1 << 20


def by_pairs(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence through the pairs of equal lines: each lengthens the shortest-ending run that it can."""
    at: dict[str, list[int]] = {}
    for j in range(len(y) - 1, -1, -1):
        at.setdefault(y[j], []).append(j)
    ends: list[int] = []
    runs: list[tuple] = []
    for i, line in enumerate(x):
        for j in at.get(line, ()):
            k = bisect_left(ends, j)
            run = (i, j, runs[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                runs.append(run)
            else:
                ends[k], runs[k] = j, run
    out, run = [], runs[-1] if runs else None
    while run:
        out.append(run[:2])
        run = run[2]
    return out[::-1]


def lengths(x: list[str], y: list[str]) -> list[int]:
    """Of each beginning of ``y``, how long its longest common subsequence with ``x`` is: a bit a line of ``y``, all at once."""
    masks: dict[str, int] = {}
    for j, line in enumerate(y):
        masks[line] = masks.get(line, 0) | 1 << j
    every = (1 << len(y)) - 1
    v = every
    for line in x:
        u = v & masks.get(line, 0)
        v = ((v + u) | (v - u)) & every
    out, n = [0], 0
    for bit in reversed(f"{v:0{len(y)}b}" if y else ""):
        n += bit == "0"
        out.append(n)
    return out


def by_halves(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence in little memory: where ``y`` is best cut for the halves of ``x``, and then both parts."""
    out, todo = [], [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if b - a == 1:
            j = next((j for j in range(c, d) if y[j] == x[a]), None)
            if j is not None:
                out.append((a, j))
            continue
        mid = (a + b) // 2
        front, back = lengths(x[a:mid], y[c:d]), lengths(x[mid:b][::-1], y[c:d][::-1])
        cut = max(range(d - c + 1), key=lambda k: front[k] + back[d - c - k])
        todo += [(a, mid, c, c + cut), (mid, b, c + cut, d)]
    return sorted(out)


def shared(a: list[str], b: list[str]) -> tuple[set[int], set[int]]:
    """Places in ``a`` and in ``b`` of a longest common subsequence of two lists of lines.

    Common ends are taken off, and lines that only one page has. The rest goes through its
    pairs of equal lines, which are few unless lines repeat; where they are many, by halves.
    """
    lo, hi = 0, 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    found, other = set(range(lo)) | set(range(len(a) - hi, len(a))), set(range(lo)) | set(range(len(b) - hi, len(b)))
    inner = set(a[lo : len(a) - hi]) & set(b[lo : len(b) - hi])
    x = [i for i in range(lo, len(a) - hi) if a[i] in inner]
    y = [j for j in range(lo, len(b) - hi) if b[j] in inner]
    times = Counter(b[j] for j in y)
    align = by_pairs if sum(times[a[i]] for i in x) <= PAIRS else by_halves
    for i, j in align([a[i] for i in x], [b[j] for j in y]):
        found.add(x[i])
        other.add(y[j])
    return found, other


def main_text(own: list[tuple[str, int]], before: set[int] | None, after: set[int] | None, agreed: set[int]) -> str:
    """The blocks of a page without those that are the site's; ``before``, ``after``: places that a neighbour shares; ``agreed``: those that all pages in reach share."""
    kept = {i for i, x in enumerate(own) if x[1]}
    if kept:
        gone = {i for i in agreed & kept if own[i][1] == 1}
        gone = set() if 2 * len(gone) > len(kept) else gone
    else:
        kept = set(range(len(own)))
        gone = before or after or set()
        if before is not None and after is not None:
            near = 2 * len((kept & before) - after) > len(kept - after), 2 * len((kept & after) - before) > len(kept - before)
            gone = (set() if near[0] else before) | (set() if near[1] else after)
    return "\n".join(own[i][0] for i in sorted(kept - gone))


HOST = re.compile(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)")
PATH = re.compile(r"(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)")


def sort_key(page_id: int | None, url: str | None) -> tuple:
    """(host, path with its numbers blanked, length, path, URL, identifier): numbers in a path sort as numbers, so that neighbours are near."""
    host, path = HOST.match(url or ""), PATH.match(url or "")
    path = path[1] if path else ""
    return host[1].lower() if host else "", re.sub(r"\d+", "0", path), len(path), path, url or "", page_id is not None, page_id or 0


class Page:
    """A page of the window: its blocks, and what it shares with others of the window."""

    def __init__(self, row: tuple):
        self.page_id, self.url, self.host, lines, inside, self.own = row
        self.blocks = list(zip(lines, inside, strict=True))
        self.lines, self.places = lines, {}

    def shares(self, other: Page) -> set[int]:
        if id(other) not in self.places:
            self.places[id(other)], other.places[id(self)] = shared(self.lines, other.lines)
        return self.places[id(other)]

    def nearest(self, others: list[Page]) -> set[int] | None:
        """Places shared with the first of the host's pages that lacks some of this one's text."""
        text = {i for i, x in enumerate(self.blocks) if x[1]} or set(range(len(self.blocks)))
        for other in others:
            if other.host == self.host and not text <= (same := self.shares(other)):
                return same
        return None

    def agreed(self, before: list[Page], after: list[Page]) -> set[int]:
        """Places that all of the host's pages in reach share, if these are enough and on both sides."""
        around = [[p for p in side if p.host == self.host] for side in (before, after)]
        if not all(around) or len(around[0] + around[1]) < AGREED:
            return set()
        return set.intersection(*(self.shares(p) for p in around[0] + around[1]))

    def text(self, before: list[Page], after: list[Page]) -> str:
        if any(place for _, place in self.blocks):
            return main_text(self.blocks, None, None, self.agreed(before, after))
        return main_text(self.blocks, self.nearest(before), self.nearest(after), set())


def differenced(batches: Iterator) -> Iterator:
    """Pages of one range in order, with those of its neighbours around them -> rows of the range's own."""
    import pyarrow as pa

    window: deque[Page | None] = deque([None] * (2 * REACH + 1), 2 * REACH + 1)
    rows: list[tuple] = []

    def turn(page: Page | None) -> None:
        window.append(page)
        at = window[REACH]
        if at and at.own:
            around = list(window)
            text = at.text([p for p in reversed(around[:REACH]) if p], [p for p in around[REACH + 1 :] if p])
            rows.append((at.page_id, at.url, text, len(text)))

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["page_id", "url", "text", "n_chars"])
        rows.clear()
        return batch

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            turn(Page(row))
        if rows:
            yield out()
    for _ in range(REACH):
        turn(None)
    if rows:
        yield out()


def extremes(keyed: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, tuple]]:
    """Of (range, key), the ``REACH`` least and greatest distinct keys of each range."""
    least: dict[int, list] = {}
    most: dict[int, list] = {}
    for part, key in keyed:
        low, high = least.setdefault(part, []), most.setdefault(part, [])
        if (len(low) < REACH or key < low[-1]) and key not in low:
            low[:] = heapq.nsmallest(REACH, [*low, key])
        if (len(high) < REACH or key > high[-1]) and key not in high:
            high[:] = heapq.nlargest(REACH, [*high, key])
    for part in least:
        for key in {*least[part], *most[part]}:
            yield part, key


def ranges(pages: DataFrame, n: int) -> tuple[list[tuple], dict[tuple, list[int]]]:
    """(the bounds of ``n`` ranges at most, the ranges besides its own that a page at a range's edge goes to). ``pages``: (page_id, url)."""
    total = pages.count()
    drawn = pages.sample(min(1.0, DRAWN * n / max(total, 1)), 7) if total > DRAWN * n else pages
    keys = sorted({sort_key(*r) for r in drawn.collect()})  # about DRAWN keys a range
    bounds = sorted({keys[i * len(keys) // n] for i in range(1, n)}) if keys else []

    def of_pages(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def keyed() -> Iterator:
            for b in batches:
                for page_id, url in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    key = sort_key(page_id, url)
                    yield bisect_right(bounds, key), key

        found = [(part, key[4] if key[4] else None, key[6] if key[5] else None) for part, key in extremes(keyed())]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64()))], names=["part", "url", "page_id"])

    def of_edges(batches: Iterator) -> Iterator:
        import pyarrow as pa

        keyed = ((part, sort_key(page_id, url)) for b in batches for part, url, page_id in zip(*(c.to_pylist() for c in b.columns), strict=True))
        found = [(part, key[4] if key[4] else None, key[6] if key[5] else None) for part, key in extremes(keyed)]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64()))], names=["part", "url", "page_id"])

    schema = "part int, url string, page_id long"
    edges = pages.mapInArrow(of_pages, schema).repartition(n, "part").mapInArrow(of_edges, schema).collect()  # 2 * REACH rows a range
    by_part: dict[int, list] = {}
    for r in edges:
        by_part.setdefault(r["part"], []).append(sort_key(r["page_id"], r["url"]))
    full, more = sorted(by_part), {}
    for i, part in enumerate(full):
        # ranges may hold fewer pages than REACH, so the nearest ones may lie further off
        before = sorted({k for p in full[max(0, i - REACH) : i] for k in by_part[p]})[-REACH:]
        after = sorted({k for p in full[i + 1 : i + 1 + REACH] for k in by_part[p]})[:REACH]
        for key in before + after:
            more.setdefault(key, []).append(part)
    return bounds, more


def page_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars."""
    n = slots(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    bounds, more = ranges(rows.select("page_id", "url"), n)

    def dealt(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            out = []
            for page_id, url, page in zip(*(c.to_pylist() for c in b.columns), strict=True):
                key, found = sort_key(page_id, url), blocks(page)
                row = (page_id, url, key[0], key[1], key[2], key[3], [t for t, _ in found], [i for _, i in found])
                part = bisect_right(bounds, key)
                out.append((part, True, *row))
                out += [(other, False, *row) for other in more.get(key, ())]
            types = (pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int8()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [()] * len(types), types, strict=True)], names=["part", "own", "page_id", "url", "host", "pattern", "size", "path", "lines", "inside"])

    found = rows.mapInArrow(dealt, "part int, own boolean, page_id long, url string, host string, pattern string, size int, path string, lines array<string>, inside array<tinyint>")
    ordered = found.repartitionById(n, F.col("part")).sortWithinPartitions("part", "host", "pattern", "size", "path", F.coalesce("url", F.lit("")), "page_id", F.xxhash64("lines"), "own")
    return ordered.select("page_id", "url", "host", "lines", "inside", "own").mapInArrow(differenced, "page_id long, url string, text string, n_chars long")

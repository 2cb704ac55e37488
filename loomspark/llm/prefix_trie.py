"""The prefix trie of all conversations, merged family first.

A family is the conversations c of one base id, c - c % 20. Own turns and the
base's first turns meet by family, the family's conversations are rebuilt and
numbered with the keys of their prefixes, and equal prefixes within the family
become one row: the family's small trie. Only these combined rows are shuffled
for the global merge, so a first turn that everybody shares is one row a family.

Keys. A prefix is known by its depth and two 64-bit words, the XOR over its
turns of two hashes of (place, role and text). XOR needs no order, so keys are
running aggregates that can begin anywhere. All rows of a key must agree in their last
turn and their parent, otherwise the query fails.

Subtree sums need no walk over the trie. A node belongs to its smallest member;
in each conversation a running sum from the end adds up the nodes it owns from
a depth on, and a node's subtree is the sum of that over its members: each
node below it belongs to exactly one of them.

Hot keys. A conversation with a third of all rows is cut into segments of
``SEGMENT`` turns, and families into as many; keys and sums carry over from
segment to segment, of which a conversation has few. Places in a conversation
come from one sort of all rows by ranges, within which rows are numbered; a row a
(range, conversation) gives the offsets. Members of one node are combined within
families and partial aggregates; the identifiers hashed for a node travel as
strings of bounded ranges of identifiers and stream through one digest.

Defined results: rows without conversation id belong to no conversation and are
left out; null roles and texts are empty; null turns come first; rows of equal
turn are in the order of role, then text, so repeated rows are turns of their
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, bucketed, slots, spread_lookup, stage

#: Conversations of a family, turns at most taken over from the base, turns of a segment.
FAMILY, HEADS, SEGMENT = 20, 3, 4096
#: Identifiers are put together by ranges of 2^RANGE_BITS.
RANGE_BITS = 16
WORD = r"[^\x20\x09-\x0D]+"
KEY = ("depth", "s1", "s2")


def base_of(conv: str = "conv_id") -> Column:
    return F.col(conv) - F.col(conv) % FAMILY


def taken_over(conv: str = "conv_id") -> Column:
    """How many turns of its base a conversation begins with."""
    return (F.crc32(F.col(conv).cast("string")) % (HEADS + 1)).cast("int")


def family_of(base: Column, seg: Column) -> Column:
    return F.concat_ws(":", base, seg)


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, n_own, a, b, words): every turn's place in its conversation, from 1, and two hashes of role and text."""
    n = slots(turns.sparkSession)
    empty = F.lit("")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text")
    ).where(F.col("conv_id").isNotNull())
    # the last key lets equal rows fall into several ranges
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    ranged = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = stage(
        ranged.select(
            F.spark_partition_id().alias("at"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("i"),
            "conv_id",
            F.xxhash64(F.lit(1), "role", "text").alias("a"),
            F.xxhash64(F.lit(2), "role", "text").alias("b"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        ),
        "placed-turns",
    )
    runs = placed.groupBy("at", "conv_id").agg(F.min("i").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("conv_id")
    runs = runs.withColumn("before", F.sum("n").over(own.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).withColumn("n_own", F.sum("n").over(own))
    return placed.join(runs, ["at", "conv_id"]).select("conv_id", (F.col("i") - F.col("first") + F.col("before") + 1).alias("pos"), "n_own", "a", "b", "words")


def rebuilt(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(base, seg, family, conv_id, depth, a, b, words, ends): the rebuilt turns, and a row of depth 0 for each conversation.

    ``ends``: the conversation has no further turn. ``family`` names (base, seg).
    """
    own = stage(numbered(turns), "numbered-turns")
    convs = own.where("pos = 1").select("conv_id", base_of().alias("base"), taken_over().alias("h"), "n_own")
    heads = own.where((F.col("pos") <= HEADS) & (base_of() == F.col("conv_id"))).groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "words"))).alias("heads"))
    families = convs.groupBy("base").agg(F.max("n_own").alias("most")).join(heads, "base", "left")
    segments = F.sequence(F.lit(0).cast("long"), F.floor((F.col("most") - 1) / segment))
    met = families.select("base", F.coalesce(F.size("heads"), F.lit(0)).alias("n_base"), "heads", F.explode(segments).alias("seg"))
    context = met.select(family_of(F.col("base"), F.col("seg")).alias("family"), "n_base", F.when(F.col("seg") == 0, F.col("heads")).alias("heads"))

    from_base = F.least(F.col("h"), F.greatest(F.col("n_base"), F.lit(0)))
    first = (
        convs.withColumn("seg", F.lit(0).cast("long"))
        .withColumn("family", family_of(F.col("base"), F.col("seg")))
        .join(context, "family")
        .withColumn("length", from_base + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
        .withColumn("turn", F.explode(F.concat(F.array(F.struct(F.lit(0).cast("long").alias("pos"), *(F.lit(0).cast("long").alias(c) for c in ("a", "b", "words")))), F.coalesce(F.slice("heads", 1, from_base), F.array()))))
        .select("base", "seg", "family", "conv_id", F.col("turn.pos").alias("depth"), "turn.a", "turn.b", "turn.words", (F.col("turn.pos") == F.col("length")).alias("ends"))
    )
    later = (
        own.withColumns({"base": base_of(), "h": taken_over(), "seg": F.floor((F.col("pos") - 1) / segment)})
        .where("pos > h")
        .withColumn("family", family_of(F.col("base"), F.col("seg")))
        .join(context.drop("heads"), "family")
        .select("base", "seg", "family", "conv_id", (F.col("pos") - F.col("h") + from_base).alias("depth"), "a", "b", "words", (F.col("pos") == F.col("n_own")).alias("ends"))
    )
    return first.unionByName(later)


def keyed(rows: DataFrame) -> DataFrame:
    """``rebuilt`` rows with the key of their prefix (depth, s1, s2) and of its parent (p1, p2), in the shared folder by family."""
    spark = rows.sparkSession
    n = slots(spark)
    root = F.col("depth") == 0
    turns = rows.withColumns({f"x{k}": F.when(root, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(k), "depth", "a", "b")) for k in (1, 2)})
    turns = bucketed(turns, "family", n, "rebuilt-turns")
    # what earlier segments bring; only conversations of several segments have rows here
    long = turns.where("seg > 0").select("conv_id").distinct()
    totals = turns.join(long, "conv_id", "left_semi").groupBy("conv_id", "family", "seg").agg(F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2"))
    earlier = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("conv_id", "family", "seg", F.bit_xor("t1").over(earlier).alias("b1"), F.bit_xor("t2").over(earlier).alias("b2")).where("seg > 0")
    starts = starts.groupBy("family").agg(F.collect_list(F.struct("conv_id", "b1", "b2")).alias("starts"))  # as many as a family has conversations
    within = Window.partitionBy("family", "conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    mine = F.filter("starts", lambda s: s["conv_id"] == F.col("conv_id"))[0]
    met = turns.join(starts, "family", "left").withColumn("start", F.when(F.size("starts") > 0, mine))
    begun = [F.coalesce(F.col(f"start.b{k}"), F.lit(0).cast("long")) for k in (1, 2)]
    found = met.withColumns({f"s{k}": F.bit_xor(f"x{k}").over(within).bitwiseXOR(begun[k - 1]) for k in (1, 2)})
    found = found.withColumns({f"p{k}": F.col(f"s{k}").bitwiseXOR(F.col(f"x{k}")) for k in (1, 2)})
    return bucketed(found.select("base", "seg", "family", "conv_id", *KEY, "p1", "p2", "a", "b", "words", "ends"), "family", n, "keyed-turns", dealt=True)


def family_nodes(turns: DataFrame) -> DataFrame:
    """The families' own tries: one row a (family, prefix)."""
    owner = F.struct("conv_id", "family", "seg")
    proof = F.struct("a", "b", "p1", "p2", "words")
    return turns.groupBy("family", *KEY).agg(
        F.min(owner).alias("owner"), F.count("*").alias("n_convs"), F.max(~F.col("ends")).alias("goes_on"), F.min(proof).alias("one"), F.max(proof).alias("other"),
        F.sort_array(F.collect_list(F.when(F.col("ends"), F.col("conv_id")))).alias("enders"), F.min("base").alias("base"),
    )


def _digests(batches: Iterator) -> Iterator:
    """Rows (depth, s1, s2, range, ids) in order -> (depth, s1, s2, sha). Only one digest is open at a time."""
    import hashlib

    import pyarrow as pa

    names = [*KEY, "ends_sha256"]
    key, digest = None, None
    for b in batches:
        out: list[tuple] = []
        for *own, _, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if own != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = own, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=pa.schema([*((k, pa.int64()) for k in KEY), ("ends_sha256", pa.string())]))
    if key is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, digest.hexdigest()), strict=True))])


def ends_digests(families: DataFrame) -> DataFrame:
    """(depth, s1, s2, ends_sha256) of the nodes at which conversations end."""
    ranges = families.where(F.size("enders") > 0).groupBy(*KEY, F.shiftright("base", RANGE_BITS).alias("range")).agg(F.array_join(F.sort_array(F.flatten(F.collect_list("enders"))), ",").alias("ids"))
    dealt = ranges.repartition(slots(families.sparkSession), *KEY).sortWithinPartitions(*KEY, "range")
    return dealt.select(*KEY, "range", "ids").mapInArrow(_digests, "depth long, s1 long, s2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, turn, role and text.
    """
    spark = turns.sparkSession
    n = slots(spark)
    own = keyed(rebuilt(turns, segment))
    families = stage(family_nodes(own), "family-nodes")
    merged = families.groupBy(*KEY).agg(F.min("owner").alias("owner"), F.sum("n_convs").alias("n_convs"), F.max("goes_on").alias("goes_on"), F.min("one").alias("one"), F.max("other").alias("other"))
    sound = F.when(F.col("one") == F.col("other"), F.col("n_convs")).otherwise(F.raise_error(F.lit("different prefixes share a key")).cast("long"))
    nodes = stage(
        merged.select(*KEY, "owner.conv_id", "owner.family", "owner.seg", sound.alias("n_convs"), "one.p1", "one.p2", (~F.col("goes_on")).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("one.words")).alias("saved")),
        "nodes",
    )

    # what each conversation owns, from the end of its segment up; later segments come in as one row below all others
    zero = F.lit(0).cast("long")
    owned = nodes.select("family", "conv_id", "depth", *(F.lit(None).cast("long").alias(c) for c in ("s1", "s2")), "leaf", "saved")
    several = own.where("seg > 0").select("conv_id").distinct()
    places = own.join(several, "conv_id", "left_semi").select("conv_id", "family", "seg", zero.alias("leaf"), zero.alias("saved")).distinct()
    totals = places.unionByName(nodes.join(several, "conv_id", "left_semi").select("conv_id", "family", "seg", "leaf", "saved")).groupBy("conv_id", "family", "seg").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("family", "conv_id", F.lit((1 << 63) - 1).alias("depth"), *(F.lit(None).cast("long").alias(c) for c in ("s1", "s2")), *(F.coalesce(F.sum(c).over(after), zero).alias(c) for c in ("leaf", "saved")))
    members = own.select("family", "conv_id", *KEY, zero.alias("leaf"), zero.alias("saved"))
    below = Window.partitionBy("family", "conv_id").orderBy(F.desc("depth")).rangeBetween(Window.unboundedPreceding, 0)
    summed = members.unionByName(owned).unionByName(carried).withColumns({c: F.sum(c).over(below) for c in ("leaf", "saved")}).where(F.col("s1").isNotNull())

    # the parent's smallest member; a parent may have a third of all nodes as children
    parent = OWN + "parent"
    asking = nodes.where("depth > 0").select(*KEY, F.struct((F.col("depth") - 1).alias("depth"), F.col("p1").alias("s1"), F.col("p2").alias("s2")).alias(parent))
    found = nodes.select(F.struct(*KEY).alias(parent), F.col("conv_id").alias("parent_conv_id"))
    parents = spread_lookup(asking, found, parent, "s1", n).select(*KEY, "parent_conv_id")

    parts = [
        nodes.select(*KEY, "conv_id", "n_convs"),
        parents,
        nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("s1"), F.col("p2").alias("s2"), F.lit(1).cast("long").alias("n_children")),
        summed.select(*KEY, F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens")),
        ends_digests(families),
    ]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    nobody = F.sha2(F.lit(b""), 256)
    return union.groupBy(*KEY).agg(
        F.max("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"), F.coalesce(F.sum("n_children"), zero).alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.coalesce(F.max("ends_sha256"), nobody).alias("ends_sha256"),
    ).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

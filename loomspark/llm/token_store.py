"""Token ids in a content-addressed store on files.

Layout of a store folder:

* ``objects/kind=chunk``: (key, n, width, body), a unique chunk of an id
  stream stored once. ``key`` is the 16-byte BLAKE2b of the ids as
  little-endian uint32; ``body`` holds them in ``width`` bytes each. The files
  are ``layout`` buckets by key, so that readers find chunks in place.
* ``objects/kind=recipe``: what the writer's tasks know of each document.
* ``recipes``: (doc_id, start, n_tokens, chunks, root, part) in ascending
  doc_id order over files and inside them. ``chunks`` joins the keys of the
  document's chunks; ``root`` is the Merkle root over them.
* ``manifest``: (part, n_docs, n_tokens, root) of each recipe file, where
  ``root`` is the SHA-256 over the roots below it, and a row with part -1,
  whose root is over those of the parts. Below a part lie spans of 2^24 token
  positions, below these spans of 2^16, below these the documents, so that no
  step holds more roots than a span has.

Chunks are cut where a rolling hash of the last ``WINDOW`` ids has
``MASK_BITS`` zero bits, at least ``MIN_IDS`` and at most ``MAX_IDS`` apart, so
equal passages of different documents become equal chunks. A task gives out a
chunk once, then chunks are dealt by key and repeats dropped, so a passage in
a third of all documents moves once per task. Reading sends each chunk once to
each ``SPAN`` of token positions in which a document names it, puts the
documents' id streams together there, and checks each chunk's key, each
document's Merkle root and length, and each part's root.

Defined results: a null text counts as empty and has the end id alone; rows
that repeat an identifier are separate documents in the order of their roots;
null identifiers come first; an empty table gives an empty store; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir, slots, small_batches, text_of
from .units import ByteUnits, encoder

WINDOW = 16
MASK_BITS = 8
MIN_IDS = 64
MAX_IDS = 2048
#: Documents that begin in the same 2^SPAN_BITS token positions are put together at once.
SPAN_BITS = 21
KEY_BYTES = 16
#: Texts of a batch whose ids and chunks are Python objects at a time.
ROWS = 256
#: Chunks that a task remembers as given out.
REMEMBER = 1 << 20
OBJECT = "kind string, key binary, doc_id long, n long, width int, body binary, root binary"
RECIPE = "doc_id long, n long, body binary, root binary"


def cut_points(ids) -> list[int]:
    """Ends of the chunks of a uint32 array."""
    import numpy as np

    n = len(ids)
    if n <= MIN_IDS:
        return [n] if n else []
    # gear hash: each id's 64-bit number, shifted by its age, summed over the window by doubling
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    span = 1
    while span < WINDOW:
        older = np.zeros_like(h)
        older[span:] = h[:-span]
        h = h + (older << np.uint64(span))
        span *= 2
    found = np.flatnonzero((h >> np.uint64(64 - MASK_BITS)) == 0) + 1
    ends, last = [], 0
    for p in found.tolist():
        if p - last < MIN_IDS:
            continue
        while p - last > MAX_IDS:
            last += MAX_IDS
            ends.append(last)
        if p - last >= MIN_IDS:
            ends.append(p)
            last = p
    while n - last > MAX_IDS:
        last += MAX_IDS
        ends.append(last)
    return ends + [n] if n > last else ends


def merkle(leaves: list[bytes]) -> bytes:
    """Root of a binary tree over the leaves; an odd one moves up as it is."""
    level = leaves or [b""]
    while len(level) > 1:
        level = [hashlib.sha256(b"".join(level[i : i + 2])).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def chunk_key(body: bytes) -> bytes:
    return hashlib.blake2b(body, digest_size=KEY_BYTES).digest()


def narrowed(ids) -> tuple[int, bytes]:
    """(width, body): the least of 1, 2 or 4 bytes an id that holds them all, and the ids in those."""
    top = int(ids.max(initial=0))
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return width, ids.astype(f"<u{width}").tobytes()


def widened(width: int, body: bytes):
    import numpy as np

    return np.frombuffer(body, f"<u{width}").astype("<u4")


def stored(batches: Iterator, vocabulary: str, end_id: int) -> Iterator:
    """Batches of (doc_id, text) -> batches of ``OBJECT``: the chunks that this task meets for the first time, and the recipes."""
    import numpy as np
    import pyarrow as pa

    pa.default_memory_pool().release_unused()  # of the worker's earlier tasks
    enc, given, end = encoder(ByteUnits, vocabulary), set(), np.array([end_id], "<u4").tobytes()
    for b in (batch.slice(i, ROWS) for batch in batches for i in range(0, batch.num_rows, ROWS)):
        out: list[tuple] = []
        texts = b.column(1).to_pylist()
        for i, (doc, stream) in enumerate(zip(b.column(0).to_pylist(), enc.encode(texts), strict=True)):
            ids = np.frombuffer(stream + end, "<u4")
            keys, last = [], 0
            for cut in cut_points(ids):
                part = ids[last:cut]
                keys.append(key := chunk_key(part.tobytes()))
                if key not in given:
                    if len(given) >= REMEMBER:
                        given.clear()
                    given.add(key)
                    width, body = narrowed(part)
                    out.append(("chunk", key, None, cut - last, width, body, None))
                last = cut
            # the own key deals recipes out evenly and keeps repeated rows apart
            out.append(("recipe", uuid.uuid5(uuid.NAMESPACE_OID, f"{doc} {i}").bytes, doc, len(ids), None, b"".join(keys), merkle(keys)))
        cols = list(zip(*out, strict=True))
        types = [pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["kind", "key", "doc_id", "n", "width", "body", "root"])


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, and write the store."""
    spark, n = docs.sparkSession, slots(docs.sparkSession)

    def once(batches: Iterator) -> Iterator:
        """Of rows sorted by (kind, key), one a chunk."""
        import pyarrow as pa

        last = None
        for b in batches:
            keys = [k if kind == "chunk" else None for kind, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            new = [k is None or k != p for k, p in zip(keys, [last, *keys], strict=False)]
            last = keys[-1] if keys else last
            yield b.filter(pa.array(new, pa.bool_()))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    objects = rows.mapInArrow(lambda batches: stored(batches, vocabulary, end_id), OBJECT).repartition(n, "key").sortWithinPartitions("kind", "key").mapInArrow(once, OBJECT)
    ident = f"objects_{uuid.uuid4().hex}"
    with small_batches(spark):
        objects.write.option("path", f"{path}/objects").partitionBy("kind").bucketBy(n, "key").sortBy("key").saveAsTable(ident)
    spark.sql(f"DROP TABLE {ident}")  # the files stay
    spark.range(1).select(F.lit(n).alias("buckets")).write.parquet(f"{path}/layout")

    found = spark.read.schema(OBJECT.replace("kind string, ", "") + ", kind string").parquet(f"{path}/objects").where("kind = 'recipe'")
    ranged = found.select("doc_id", F.col("n").alias("n_tokens"), F.col("body").alias("chunks"), "root").repartitionByRange(n, "doc_id", "root").sortWithinPartitions("doc_id", "root")
    ranged.withColumn("part", F.spark_partition_id()).write.parquet(f"{path}/ranged")
    ranged = spark.read.schema("doc_id long, n_tokens long, chunks binary, root binary, part int").parquet(f"{path}/ranged")
    order = Window.partitionBy("part").orderBy("doc_id", "root", "chunks")
    parts = ranged.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    parts = parts.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    upto = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    recipes = ranged.withColumn("upto", upto).join(parts, "part").select("doc_id", (F.col("offset") + F.col("upto")).alias("start"), "n_tokens", "chunks", "root", "part")
    recipes.repartitionByRange(n, "part", "start").sortWithinPartitions("part", "start").write.parquet(f"{path}/recipes")
    manifest(recipes_of(spark, path)).write.parquet(f"{path}/manifest")


def recipes_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, start long, n_tokens long, chunks binary, root binary, part int").parquet(f"{path}/recipes")


def chunks_of(spark: SparkSession, path: str) -> DataFrame:
    """(key, n, width, body), dealt by key as the files are."""
    buckets = spark.read.schema("buckets int").parquet(f"{path}/layout").first()[0]
    ident = f"chunks_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {ident} (key binary, n long, width int, body binary) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{path}/objects/kind=chunk'")
    found = spark.table(ident)
    found.schema  # resolves the files; the name isn't needed any more
    spark.sql(f"DROP TABLE {ident}")
    return found


def manifest(recipes: DataFrame) -> DataFrame:
    """(part, n_docs, n_tokens, root): the documents' roots are hashed in order by span, spans by wider span, these by part, parts as a whole."""

    def rooted(rows: DataFrame, *by: str) -> DataFrame:
        in_order = F.array_sort(F.collect_list(F.struct("start", F.hex("root").alias("r"))))
        root = F.unhex(F.sha2(F.array_join(in_order["r"], "").cast("binary"), 256)).alias("root")
        return rows.groupBy(*by).agg(F.min("start").alias("start"), F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), root)

    rows = recipes.select("part", "start", F.lit(1).cast("long").alias("n_docs"), "n_tokens", "root")
    for bits in (16, 24):
        rows = rooted(rows.withColumn("span", F.shiftright("start", bits)), "part", "span")
    parts = rooted(rows, "part")
    whole = rooted(parts.withColumn("part", F.lit(-1)), "part")
    # an empty store has a whole of no parts
    none = parts.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("n_docs"), F.lit(0).cast("long").alias("n_tokens"), F.unhex(F.sha2(F.lit("").cast("binary"), 256)).alias("root"))
    return parts.drop("start").unionByName(whole.drop("start")).unionByName(none)


STREAM = "doc_id long, start long, n_tokens long, stream binary"


def streams(spark: SparkSession, path: str, to_rows=None, schema: str = STREAM) -> DataFrame:
    """(doc_id, start, n_tokens, stream): each document's ids as little-endian uint32, put together from the files and verified.

    ``to_rows``, if given, turns the Arrow table of some documents' streams into rows of ``schema``.
    """
    check = manifest(recipes_of(spark, path)).exceptAll(spark.read.schema("part int, n_docs long, n_tokens long, root binary").parquet(f"{path}/manifest"))
    if not check.isEmpty():
        raise ValueError("the manifest doesn't match the recipes")
    recipes = recipes_of(spark, path).select("doc_id", "start", "n_tokens", "chunks", "root", F.shiftright("start", SPAN_BITS).alias("span"))
    keys = F.expr(f"transform(sequence(0, cast(octet_length(chunks) div {KEY_BYTES} as int) - 1), i -> substring(chunks, i * {KEY_BYTES} + 1, {KEY_BYTES}))")
    # a passage of a third of all documents is one row a span
    asked = recipes.select("span", F.explode(keys).alias("key")).distinct()
    sent = asked.join(chunks_of(spark, path), "key").select(F.col("span").alias("to_span"), "key", "n", "width", "body")

    def assemble(left, right):
        import pyarrow as pa

        known = {}
        for key, n, width, body in zip(*(right[c].to_pylist() for c in ("key", "n", "width", "body")), strict=True):
            try:
                known[key] = widened(width, body).tobytes()
            except Exception as e:  # of the decompressor's own kind
                raise ValueError(f"chunk {key.hex()} is damaged") from e
            if chunk_key(known[key]) != key or len(known[key]) != 4 * n:
                raise ValueError(f"chunk {key.hex()} is damaged")
        found = []
        for doc, n_tokens, chunks, root in zip(*(left[c].to_pylist() for c in ("doc_id", "n_tokens", "chunks", "root")), strict=True):
            own = [chunks[i : i + KEY_BYTES] for i in range(0, len(chunks), KEY_BYTES)]
            whole = b"".join(map(known.__getitem__, own))
            if len(whole) != 4 * n_tokens or merkle(own) != root:
                raise ValueError(f"document {doc} is damaged")
            found.append(whole)
        table = pa.table({"doc_id": left["doc_id"], "start": left["start"], "n_tokens": left["n_tokens"], "stream": pa.array(found, pa.binary())})
        return to_rows(table) if to_rows else table

    return recipes.groupBy("span").cogroup(sent.groupBy("to_span")).applyInArrow(assemble, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its id stream."""

    def summed(table):
        import pyarrow as pa

        return table.drop_columns("stream").append_column("ids_crc32", pa.array([zlib.crc32(s) for s in table["stream"].to_pylist()], pa.int64()))

    return streams(spark, path, summed, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids array<long>): the id streams as arrays."""

    def listed(table):
        import numpy as np
        import pyarrow as pa

        ids = pa.array([np.frombuffer(s, "<u4").astype(np.int64) for s in table["stream"].to_pylist()], pa.list_(pa.int64()))
        return table.select(["doc_id", "start"]).append_column("ids", ids)

    return streams(spark, path, listed, "doc_id long, start long, ids array<long>")


def round_trip(docs: DataFrame, vocabulary: str, path: str | None = None, **columns) -> DataFrame:
    """Write ``docs`` to a store, in the shared folder unless ``path`` is given, and read it back."""
    path = path or f"{shared_dir(docs.sparkSession)}/loomspark/token-store-{uuid.uuid4().hex}"
    write(docs, path, vocabulary, **columns)
    return read(docs.sparkSession, path)

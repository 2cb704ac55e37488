"""The queries of this subpackage and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_verify, exact_dedup, language_id, mixing, order_minhash, page_text, piece_lattice, prefix_trie, simhash, spelling, subword_lm, token_counts, token_store
from .common import table


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.encode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), from_files=True)


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents"))


def op5_subword_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_lm.scores(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.page_texts(table(spark, sf_dir, "pages"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def label_quality(labels: DataFrame) -> DataFrame:
    """(doc_id, quality): weight 2 for documents labelled good, 0.5 for those labelled bad."""
    return labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("quality"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), quality=label_quality(table(spark, sf_dir, "labels"))).drop("copies")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    both = bpe_verify.decode(bpe_verify.encode(table(spark, sf_dir, "documents"), path), path)
    return both.select("doc_id", "n_tokens", F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


SQL = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        WINDOW same AS (PARTITION BY t)""",
    "op9_mix_sources": """
        WITH q AS (SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END) AS quality
                   FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                     -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':11'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
                       / coalesce(quality, 1.0)::DOUBLE AS key
              FROM documents LEFT JOIN q USING (doc_id)),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS weight FROM s),
        r AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k FROM w),
        v AS (SELECT *, (sum(source_size) OVER () - 3 * (sum(source_size) OVER upto - source_size))::DOUBLE
                          / (sum(weight) OVER () - (sum(weight) OVER upto - weight)) AS level
              FROM r WINDOW upto AS (ORDER BY k)),
        t AS (SELECT source, source_size,
                     round(least(3.0 * source_size,
                       weight * (SELECT arg_min(level, k) FROM v WHERE 3 * source_size >= weight * level)), 6)::DOUBLE AS target FROM v),
        e AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS epochs FROM t),
        p AS (SELECT doc_id, size, d.source, source_size, target, epochs, target - epochs * source_size AS rest,
                     sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
              FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
        SELECT doc_id, size, source_size, target,
               ((epochs + CASE WHEN rest > before AND before + size / 2.0 <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken, source
        FROM p""",
    "op11_spelling": r"""
        WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab),
        r AS (SELECT doc_id, run, count(*) AS k
              FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
              GROUP BY ALL),
        b AS (SELECT *, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
                                               lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)) AS bytes FROM r),
        h AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM b, tab),
        w AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(k)::BIGINT AS n
              FROM h GROUP BY word HAVING length(word) >= 5 AND sum(k) >= 3),
        d AS (SELECT word, i, left(word, i) AS front, substr(word, i + 2) AS back FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
        p AS (SELECT a.word, b.word AS near FROM d a JOIN d b ON a.i = b.i AND a.front = b.front AND a.back = b.back AND a.word <> b.word
              UNION SELECT d.word, w.word FROM d JOIN w ON w.word = front || back
              UNION SELECT w.word, d.word FROM d JOIN w ON w.word = front || back),
        g AS (SELECT p.word, count(*) AS n_near, max(o.n) AS top, min_by(p.near, (-o.n, p.near)) AS best FROM p JOIN w o ON o.word = p.near GROUP BY p.word),
        f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * w.n THEN best END AS form, CASE WHEN top >= 2 * w.n THEN top END AS form_n FROM w LEFT JOIN g USING (word)),
        c AS (SELECT word, form AS root FROM f WHERE form IS NOT NULL
              UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL),
        e AS (SELECT c.word, c.root FROM c JOIN f ON f.word = c.root WHERE f.form IS NULL)
        SELECT f.word, form, coalesce(e.root, f.word) AS root, n, n_near::BIGINT AS n_near, form_n FROM f LEFT JOIN e ON e.word = f.word""",
    "op13_prefix_trie": r"""
        WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab),
        r AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                     row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
              FROM conversations WHERE conv_id IS NOT NULL),
        h AS (SELECT conv_id, conv_id - conv_id % 20 AS base, n_own,
                     xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                                     lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h
              FROM (SELECT conv_id, max(pos) AS n_own FROM r GROUP BY conv_id), tab),
        t AS (SELECT h.conv_id, pos AS depth, role, text FROM h JOIN r ON r.conv_id = base WHERE pos <= h
              UNION ALL
              SELECT h.conv_id, pos - h + least(h, coalesce(b.n_own, 0)), role, text
              FROM h JOIN r USING (conv_id) LEFT JOIN (SELECT conv_id AS id, n_own FROM h) b ON b.id = base WHERE pos > h),
        p AS (SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
                     string_agg(sha256(len(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM t
              UNION ALL SELECT conv_id, 0, 0, '' FROM h),
        e AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p),
        n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved, bool_and(ends) AS leaf,
                     coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS enders
              FROM e GROUP BY path, depth),
        s AS (SELECT left(path, 64 * k) AS path, sum(leaf::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (depth = k + 1) AS n_children
              FROM (SELECT *, unnest(range(depth + 1)) AS k FROM n) GROUP BY ALL)
        SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, sha256(n.enders) AS ends_sha256
        FROM n JOIN s USING (path) LEFT JOIN n u ON n.depth > 0 AND u.path = left(n.path, 64 * (n.depth - 1))""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_token_store": op2_token_store,
    "op3_token_counts": op3_token_counts,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_subword_lm": op5_subword_lm,
    "op6_page_text": op6_page_text,
    "op7_order_minhash": op7_order_minhash,
    "op8_language_id": op8_language_id,
    "op9_mix_sources": op9_mix_sources,
    "op10_simhash": op10_simhash,
    "op11_spelling": op11_spelling,
    "op12_bpe": op12_bpe,
    "op13_prefix_trie": op13_prefix_trie,
}

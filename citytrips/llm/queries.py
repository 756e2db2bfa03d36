"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrips.llm import (
    bpe, embeddings, fingerprints, language_id, minhash, packing, prefix_trie, quality, suffix_dedup, token_ids, toxicity, warc, zone_maps)
from citytrips.llm.common import remainder, table

TOXIC = 0.7
GOOD = 0.5
#: Bytes of a passage of a little over 50 words, in languages whose words and spaces have six bytes on average.
PASSAGE = 300


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by mixture inference."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.fit(docs))
    return found.withColumn("held_out", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))).select(
        "doc_id", "held_out", "lang_pred", "score", "n_languages")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by maximum-scoring segments."""
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"), "n_passages", "best_start", "best_end")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document among near copies, by DartMinHash and exact verification."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 400 bytes or more that occur again, removed from every document; shorter ones are counted."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), passage=PASSAGE).drop("kept")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens by lexical retrieval."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, by prefix polynomial hashes."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document, and back."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by supervised subword embeddings."""
    docs = table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of near-duplicate embeddings by a random-projection forest."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through seekable WARC bundles."""
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations, by blocks of turns."""
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroid clusters of all embeddings, by zone maps over a Hilbert curve."""
    return zone_maps.cluster(table(spark, sf_dir, "embeddings"))


def op13_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document through shards and their perfect hash index."""
    ids = token_ids.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return token_ids.round_trip(table(spark, sf_dir, "documents"), ids).select("doc_id", "start", "n_tokens", "ids_crc32")


def _clusters_sql(rounds: int = zone_maps.ROUNDS) -> str:
    """Lloyd's rounds one after the other, on one row for each component."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
        a{k} AS (SELECT vec_id, (best % 1000)::INT AS k, best // 1000 AS distance FROM (
                   SELECT vec_id, min(d * 1000 + k) AS best FROM (
                     SELECT v.vec_id, c.k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM comps v JOIN c{k} c USING (i) GROUP BY ALL) GROUP BY vec_id))""")
        if k < rounds:
            steps.append(f"""
        s{k} AS (SELECT k, i, sum(x) AS s, count(*) AS n FROM comps JOIN a{k} USING (vec_id) GROUP BY ALL),
        c{k + 1} AS (SELECT c.k, c.i, coalesce((s - ((s % n) + n) % n) // n, c.x) AS x FROM c{k} c LEFT JOIN s{k} USING (k, i))""")
    return f"""
        WITH kept AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS v FROM embeddings
                      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
        comps AS (SELECT vec_id, unnest(v) AS x, unnest(range(64)) AS i FROM kept),
        firsts AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k FROM kept QUALIFY k < 40),
        c0 AS (SELECT k, i, x FROM comps JOIN firsts USING (vec_id)),{",".join(steps)},
        digests AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k)
        SELECT vec_id, k AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
               (sum(distance) OVER ())::BIGINT AS inertia, h AS centroid_sha256
        FROM a{rounds} JOIN digests USING (k)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op3_minhash": op3_minhash,
    "op2_fingerprints": op2_fingerprints,
    "op4_embeddings": op4_embeddings,
    "op5_warc": op5_warc,
    "op6_packing": op6_packing,
    "op7_bpe": op7_bpe,
    "op8_quality": op8_quality,
    "op9_language_id": op9_language_id,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_conversations": op11_conversations,
    "op12_clusters": op12_clusters,
    "op13_token_ids": op13_token_ids,
}

ORACLE: dict[str, str] = {
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             r AS (SELECT page_id, strlen(html) AS n, sha1(html) AS d FROM p),
             m AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS target FROM r)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> target THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> target THEN target END AS refers_to
        FROM m""",
    "op11_conversations": r"""
        WITH bits AS (SELECT list(list_reduce([n] || [0, 0, 0, 0, 0, 0, 0, 0], lambda a, k: xor(a >> 1, 3988292384 * (a & 1))) ORDER BY n) AS tab
                      FROM (SELECT unnest(range(256)) AS n)),
        orig AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
                        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
                        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
                 FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT c, xor(list_reduce([4294967295] || list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
                                lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h
                  FROM (SELECT DISTINCT c FROM orig), bits),
        stem AS (SELECT v.c, o.k, o.t, o.x FROM convs v JOIN orig o ON o.c = v.c - v.c % 20 AND o.k <= v.h),
        stems AS (SELECT c, count(*) AS m FROM stem GROUP BY c),
        turns AS (SELECT c, k AS d, t, x FROM stem UNION ALL
                  SELECT o.c, coalesce(m, 0) + o.k - h, o.t, o.x FROM orig o JOIN convs v USING (c) LEFT JOIN stems USING (c) WHERE o.k > h),
        paths AS (SELECT c, d, md5(string_agg(t, '') OVER (PARTITION BY c ORDER BY d)) AS node, len(regexp_extract_all(x, '[^ 	-
]+')) AS words FROM turns
                  UNION ALL SELECT c, 0, '', 0 FROM convs),
        nodes AS (SELECT d, node, min(c) AS c, count(*) AS n, any_value(words) AS words FROM paths GROUP BY ALL),
        ups AS (SELECT w.d, w.node, w.c, w.n, w.words, p.node AS up FROM nodes w LEFT JOIN paths p ON p.c = w.c AND p.d = w.d - 1),
        kids AS (SELECT d - 1 AS d, up AS node, count(*) AS n_children FROM ups WHERE d > 0 GROUP BY ALL),
        full_nodes AS (SELECT u.*, coalesce(n_children, 0) AS n_children FROM ups u LEFT JOIN kids USING (d, node)),
        sums AS (SELECT p.d, p.node, sum((w.n - 1) * w.words) AS saved, sum((w.n_children = 0)::INT) AS leaves
                 FROM full_nodes w JOIN paths p ON p.c = w.c AND p.d <= w.d GROUP BY ALL),
        lasts AS (SELECT c, max(d) AS d FROM paths GROUP BY c),
        ends AS (SELECT d, node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS e FROM paths JOIN lasts USING (c, d) GROUP BY ALL)
        SELECT f.c AS conv_id, f.d AS depth, p.c AS parent_conv_id, f.n AS n_convs, f.n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
               coalesce(e, sha256('')) AS ends_sha256
        FROM full_nodes f JOIN sums s USING (d, node) LEFT JOIN nodes p ON p.d = f.d - 1 AND p.node = f.up LEFT JOIN ends USING (d, node)""",
    "op12_clusters": _clusters_sql(),
}

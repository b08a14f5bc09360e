"""The queries of this subpackage, one an operator: thin wrappers that apply
the operator with its production parameters to a whole table and derive the
columns to compare."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from threadscope.catalog import query
from threadscope.llm import (
    centroids,
    fingerprint,
    hard_negatives,
    mixing,
    near_dedup,
    packing,
    piece_codec,
    sharding,
    substring,
    toxicity,
    url_filter,
    vector_topk,
    warc,
)
from threadscope.llm.common import scratch, table


@query("op10_sharding")
def op10_sharding(spark, sf):
    docs = table(spark, sf, "documents")
    text = F.coalesce("text", F.lit(""))
    return sharding.shuffle_shards(docs).select(
        "doc_id", sharding.row_bytes("text").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024.0::DOUBLE * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op1_vector_topk", sql=_OP1_SQL)
def op1_vector_topk(spark, sf):
    return vector_topk.top_k(table(spark, sf, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 100 == 0)


_OP2_SQL = """
WITH h AS (
  SELECT page_id, coalesce(html, '') AS html, '0' || sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, strlen(html) AS payload_bytes, hex,
         list_transform(string_split(substr(hex, 2), ''), lambda c: strpos('0123456789abcdef', c) - 1) AS x
  FROM h
), b AS (
  SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32),
           lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
             ((x[CAST(i * 5 // 4 + 1 AS INT)] * 16 + coalesce(x[CAST(i * 5 // 4 + 2 AS INT)], 0))
              // (1 << CAST(3 - (i * 5) % 4 AS INT))) % 32 + 1 AS INT), 1)), 'string_agg', '') AS payload_digest
  FROM d
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM b
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""


@query("op2_warc", sql=_OP2_SQL)
def op2_warc(spark, sf):
    manifest = warc.write_archives(table(spark, sf, "pages"), scratch(spark, "warc"))
    records = warc.read_archives(manifest, with_payload=False)
    return warc.resolve_revisits(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


URL_RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block",
             "com/fr/": "allow", "com/de/": "block"}


@query("op8_url_filter")
def op8_url_filter(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, "url", URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "blocked_score")


@query("op6_sentencepiece")
def op6_sentencepiece(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return piece_codec.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


_OP7_SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), v AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)
), m AS (
  SELECT s, min(doc_id) AS first FROM v GROUP BY s
), g AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM v JOIN m USING (s) WHERE m.first < v.doc_id
), x AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w
), k AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM x ANTI JOIN g USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""


@query("op7_substring_dedup", sql=_OP7_SQL)
def op7_substring_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs, joined=True).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op9_toxicity")
def op9_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"), train=~toxicity.held_out(F.col("id")))
    return (toxicity.score(docs, model).withColumn("held_out", toxicity.held_out(F.col("doc_id")))
            .select("doc_id", "held_out", "score", "predicted", "evidence", "evidence_cosine"))


@query("op3_mixing")
def op3_mixing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op5_fingerprints")
def op5_fingerprints(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return fingerprint.compare_with_edits(docs)


@query("op4_near_dedup")
def op4_near_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs).select("doc_id", "class_id", "class_size", "keep")


_OP11_ROUND = """, a{i} AS MATERIALIZED (
  SELECT rid, c, d FROM (
    SELECT v.rid, k.c, list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - k.v[i]) * (v.v[i] - k.v[i]))) AS d,
           row_number() OVER (PARTITION BY v.rid ORDER BY d, k.c) AS r
    FROM v JOIN c{i} k ON true)
  WHERE r = 1
)"""
_OP11_MOVE = """, m{i} AS (
  SELECT c, p, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM (SELECT a.c, unnest(v.v) AS x, unnest(range(1, 65)) AS p FROM a{i} a JOIN v USING (rid)) GROUP BY c, p
), c{j} AS MATERIALIZED (
  SELECT k.c, coalesce(n.v, k.v) AS v FROM c{i} k LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY p) AS v FROM m{i} GROUP BY c) n USING (c)
)"""
_OP11_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024.0::DOUBLE * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v
  FROM (SELECT v, sha256('3:' || vec_id) AS h FROM v ORDER BY h NULLS LAST, v LIMIT 8)
)""" + "".join(_OP11_ROUND.format(i=i) + _OP11_MOVE.format(i=i, j=i + 1) for i in range(10)) + _OP11_ROUND.format(i=10) + """
SELECT v.vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(k.v, ',')) AS centroid_sha256
FROM a10 JOIN v USING (rid) JOIN c10 k USING (c)
"""


@query("op11_centroids", sql=_OP11_SQL)
def op11_centroids(spark, sf):
    return centroids.cluster_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding").drop("compared")


@query("op12_packing")
def op12_packing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False,
                                  extra=[("ids_crc32", F.crc32("ids"))])


_OP13_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(c.v) = len(a.v)
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same)
  WHERE r <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query("op13_hard_negatives", sql=_OP13_SQL)
def op13_hard_negatives(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf, "embeddings"), "vec_id", "embedding", label, F.col("vec_id") % 100 == 0)

"""The operators of this folder as queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkbrook.llm import bpe, cotrain, html, langid, neardup, packing, rules, sharding, vectors, warc
from sparkbrook.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from two views that teach each other."""
    return cotrain.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op3_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"))


def op4_hyperdimensional_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    profile = langid.Profile()
    names, prototypes = langid.train_prototypes(docs.filter(~langid.held_out()).select("doc_id", "text", "lang"), profile)
    found = langid.identify(docs.select("doc_id", "text"), names, prototypes, profile)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op5_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_and_index(_table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp", "position")


def op6_byte_prefix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_likelihood_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").filter("quality = 1")
    judged = rules.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"), trusted, rules.PAIRS)
    return judged.drop("text")


def op8_spherical_kmeans_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op9_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(_table(spark, sf_dir, "pages"))


def op10_hyperminhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), neardup.Similarity(words=2))


_SQL = {
    "op5_warc_index_merge": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, regexp_extract(lower(trim(url)), '^[a-z]+://(?:www\\.)?([^/?#]*)([^?#]*)(\\?[^#]+)?', ['host', 'path', 'query']) AS u FROM pages),
 d AS (SELECT page_id, octet_length(encode(h)) AS n, sha256(h) AS digest,
  array_to_string(list_reverse(string_split(u.host, '.')), ',') || ')' || CASE WHEN u.path = '' THEN '/' ELSE u.path END || u.query AS url_key,
  strftime(make_timestamp(page_id * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS timestamp FROM p),
 f AS (SELECT digest, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
 CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN first_id <> page_id THEN first_id END AS refers_to, url_key, timestamp,
 row_number() OVER (ORDER BY url_key, timestamp, page_id) - 1 AS position
FROM d LEFT JOIN f ON d.digest = f.digest
""",
    "op6_byte_prefix_shards": """
WITH k AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
 h AS (SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS pairs FROM documents),
 b AS (SELECT doc_id, CAST(len(pairs) + 16 AS BIGINT) AS size, list_prepend(4294967295, list_transform(pairs, lambda x: CAST('0x' || x AS BIGINT))) AS bytes FROM h),
 d AS (SELECT doc_id, size, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM b, k),
 s AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) - size AS start, sum(size) OVER () AS total FROM d),
 p AS (SELECT *, CAST(least(39, (2 * start + size) * 40 // (2 * total)) AS INTEGER) AS shard FROM s)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
 row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p
""",
    "op8_spherical_kmeans_neardup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
 usable AS (SELECT vec_id, x FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
 links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95),
 reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
 least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
 n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least ON least.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
""",
    "op10_hyperminhash_neardup": """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') AS words FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(words) < 2 THEN words ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS shingles FROM w),
 e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
 common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 links AS (SELECT a, b FROM common JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 80 * (len(x.shingles) + len(y.shingles) - n)),
 reach(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
 least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN least ON a = doc_id
""",
}


def queries() -> dict[str, Query]:
    found = (
        op1_cotraining,
        op2_vector_best_fit,
        op3_tree_bpe,
        op4_hyperdimensional_langid,
        op5_warc_index_merge,
        op6_byte_prefix_shards,
        op7_likelihood_ratio_rules,
        op8_spherical_kmeans_neardup,
        op9_tag_path_ratios,
        op10_hyperminhash_neardup,
    )
    return {q.__name__: q for q in found}


def oracles() -> dict[str, str]:
    return dict(_SQL)

"""The registered queries of these operators, with production parameters over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, fingerprints, language_id, near_dup, packing, sharding, token_counts, topk_search, toxicity, url_filter
from .shared import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_of")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), window=4096, end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(table(spark, sf_dir, "documents"), shards=24)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    return rows.select("doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    both = bpe_codec.encode(table(spark, sf_dir, "documents"), path, decoded=True)
    return both.select("doc_id", F.expr("bigint(octet_length(ids) div 4)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk_search.quantised(F.col("embedding")).alias("vector"))
    return topk_search.top_k(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), budgets=(1024,))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), F.col("fits_chars")[0].alias("fits_chars"))


def id_class(n: int) -> Column:
    """The remainder that tells training rows from held-out ones."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, id_class(4) != 2)
    return language_id.identify(docs, model).select("doc_id", (id_class(4) == 2).alias("held_out"), "lang_pred", "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), id_class(5) != 0)
    return toxicity.score_documents(docs, model).select("doc_id", (id_class(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.compare_edits(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_string(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.as_string(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


#: The rules of the registered query.
URL_RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dup": op1_near_dup,
    "op2_packing": op2_packing,
    "op3_sharding": op3_sharding,
    "op4_bpe": op4_bpe,
    "op5_topk": op5_topk,
    "op6_token_counts": op6_token_counts,
    "op7_language_id": op7_language_id,
    "op8_fingerprints": op8_fingerprints,
    "op9_toxicity": op9_toxicity,
    "op10_url_filter": op10_url_filter,
}

ORACLE_SQL: dict[str, str] = {
    "op5_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op10_url_filter": """
        WITH rules(host, path, verdict) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
        p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
        f AS (SELECT p.page_id, max(struct_pack(n := length(r.host) + length(r.path), rule := r.host || r.path, verdict := r.verdict)) AS best
              FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY p.page_id)
        SELECT p.page_id, p.host, p.path, f.best.rule AS rule, coalesce(f.best.verdict, 'allow') AS verdict FROM p LEFT JOIN f USING (page_id)""",
}

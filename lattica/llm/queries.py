"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm import decontam, htmltext, jaccard, licenses, media, mixing, sharding, substrings, toxicity, warc
from lattica.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


def op2_media_sniffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_texts(documents(spark, sf_dir), with_media=False).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media_type")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.classify(docs.select("doc_id", "text"), model).select("doc_id", (~toxicity.in_training(F.col("doc_id"))).alias("held_out"), "score", "predicted")


def op4_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' records against a replica in which about one record in 200 has a changed last character."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    hit = F.conv(F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 4), 16, 10).cast("int") % 200 == 0
    replica = pages.withColumn("html", F.when(hit, F.concat(F.expr("substring(html, 1, length(html) - 1)"), F.lit("?"))).otherwise(F.col("html")))
    return warc.audit(pages, replica)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = sharding.reshard_plan(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir), with_kept=False).drop("kept")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.benchmark_hits(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontam.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP10_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), cut AS (
  SELECT *, length(bin(size)) * 8 + (size >> greatest(length(bin(size)) - 3, 0)) AS class,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % 16 AS salt
  FROM rows
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, salt, size, doc_id NULLS FIRST) AS nth FROM cut
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source
), weighed AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
    [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
    (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget
  FROM sizes
), levels AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target,
    ('0x' || substr(md5(concat_ws(chr(1), '7', coalesce(source, ''), CASE WHEN source IS NULL THEN 'true' ELSE 'false' END)), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM levels
), rated AS (
  SELECT p.doc_id, p.size, t.source_size, t.target, p.nth, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  ((floor(nth * rate + u) - floor((nth - 1) * rate + u)) * size)::BIGINT AS taken
FROM rated
"""


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_media_sniffing": op2_media_sniffing,
        "op3_toxicity": op3_toxicity,
        "op4_warc_fixity": op4_warc_fixity,
        "op5_sharding": op5_sharding,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_html_text": op7_html_text,
        "op8_decontamination": op8_decontamination,
        "op9_license_scan": op9_license_scan,
        "op10_mixing": op10_mixing,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_mixing": OP10_SQL}

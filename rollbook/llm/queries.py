"""The registered queries: each operator with production parameters on its whole table, and SQL where it can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import decontaminate, fingerprints, jaccard, licenses, packing, pii, quality, search, sharding, simhash, toxicity, urls, whitening
from rollbook.llm.common import table
from rollbook.llm.oracles import ORACLES  # noqa: F401


def _remainder(id: str, n: int):
    return F.crc32(F.col(id).cast("string").cast("binary")) % n


def op1_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.sharded(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), _remainder("id", 4) != 2, "toxic")
    found = toxicity.scored(docs, model)
    return found.select(
        "doc_id", (_remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op4_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", packing.token_count(F.col("text")).alias("tokens"))
    return packing.packed(docs, F.col("tokens")).drop("tokens")


def op5_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), _remainder("id", 5) != 0, "quality")
    found = quality.scored(docs, model)
    return found.select(
        "doc_id", (_remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


def op7_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"), out="found")
    base = F.filter("found", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in pii.BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans")
    )


def op9_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op10_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.hexed("sketch").alias("fingerprint"),
        fingerprints.hexed("edited_sketch").alias("edited_fingerprint"),
        fingerprints.resemblance("sketch", "edited_sketch").alias("near_edited"),
        fingerprints.resemblance("sketch", "next_sketch").alias("near_next"),
    )


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(table(spark, sf_dir, "documents"))


def op12_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_label_propagation,
        op2_toxicity,
        op3_winnowing,
        op4_length_buckets,
        op5_gray_index,
        op6_neighbour_votes,
        op7_license_join,
        op8_weak_supervision,
        op9_bloom_cascade,
        op10_bottom_k,
        op11_jaccard_join,
        op12_reversed_search,
        op13_chebyshev_whitening,
    )
}

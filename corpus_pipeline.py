"""A corpus pipeline of five operators; each stage is written as Parquet and read again as the next one's documents.

Null ids and repeated rows are kept as rows of their own by every stage but the near-duplicate one, which keeps one row
of each group. Every stage works on all that its predecessor kept, whole texts included. Documents may have columns of
any name beside their own: a stage carries the whole row along as one struct and gives it back unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import decontaminate, packing, pii, quality, simhash
from rollbook.llm.common import discard, staged, table


def _carried(docs: DataFrame) -> DataFrame:
    """Id and text, and the whole row beside them."""
    return docs.select("doc_id", "text", F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It learns from all labelled documents within its bound."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), F.lit(True), "quality")
    return quality.scored(_carried(docs), model).where(F.col("score") >= quality.THRESHOLD).select("doc.*")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of smallest id stays (one row of it, if that id is repeated).

    Texts are near duplicates if chains of SimHash fingerprints of 3-word shingles, 2 bits apart at most, connect them.
    """
    return simhash.one_of_each(_carried(docs)).select("doc.*")


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a passage with the benchmark go."""
    items = table(spark, sf_dir, "benchmark")
    # A text alone decides, so its digest tells rows whose ids are null or repeated apart.
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    texts = docs.select(digest.alias("digest"), "text")
    found = decontaminate.contamination(texts, items, doc_id="digest").where(F.col("n_hit") > 0).select(F.col("digest").alias("hit")).distinct()
    # Written out, its size is known: texts are shuffled only if very many documents go.
    found = staged(found, "contaminated")
    return _carried(docs).join(found, digest == F.col("hit"), "left_anti").select("doc.*")


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become their kind in angle brackets; ``n_chars`` follows."""
    found = pii.detect(_carried(docs)).withColumn("text", pii.masked(F.col("text"), F.col("spans")))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return found.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their length bucket, batch and row in the batch: what a trainer reads, texts included."""
    placed = packing.packed(_carried(docs).drop("doc_id"))
    own = [c for c in placed.columns if c not in ("text", "doc")]
    taken = {c.lower() for c in own}
    kept = [F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() not in taken]
    return placed.select(*kept, *own)


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one),
    ("benchmark decontamination", keep_clean),
    ("PII", mask_personal),
    ("packing", pack),
]

# No SQL: the classifier is trained, and components and boundaries come from iterations. See tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed, masked texts with their placements. Each stage's table goes once the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(before)
    return docs

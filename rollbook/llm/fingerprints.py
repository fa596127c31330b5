"""Native document fingerprints: bottom-k sketches of shingle hashes.

A text's shingles are its runs of ``SHINGLE`` words (A-Z lowered, split at white space; a text of fewer words, but not none,
is one shingle). Its sketch is the ``K`` smallest different hashes, in order. Sketches of parts merge into the sketch of the
whole: the ``K`` smallest of all. From two sketches follow the resemblance of two texts (the share of hashes in both
among the ``K`` smallest of their union) and the containment of one in the other; from one the number of different
shingles, exact up to ``K``.

Defined cases: null and empty texts have an empty sketch; two empty sketches have resemblance 1, an empty one and
another 0. Equal texts have equal sketches. Empty tables give empty results. Rows of one id follow one another in the
order of a hash of their texts. Null ids come first. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import constant_array, lower_az, small_table

SHINGLE = 5
K = 64
_ARRAY = "array<bigint>"


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def words(text: Column) -> Column:
    lowered = lower_az(F.coalesce(text, F.lit("")))
    return F.filter(F.split(lowered, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def sketch_of_words(words: str, shingle: int = SHINGLE, k: int = K) -> Column:
    """The sketch of an array column of words."""
    n = F.size(words)
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(n - shingle + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, F.lit(shingle)))
    )
    return F.when(n > 0, smallest(runs, k)).otherwise(F.array().cast(_ARRAY))


def with_sketch(df: DataFrame, text: str, out: str, shingle: int = SHINGLE, k: int = K) -> DataFrame:
    held = f"__words_{out}"
    return df.withColumn(held, words(F.col(text))).withColumn(out, sketch_of_words(held, shingle, k)).drop(held)


def merged(a: Column | str, b: Column | str, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: str, b: str, k: int = K) -> Column:
    both = merged(a, b, k)
    return F.when(F.size(both) == 0, 1.0).otherwise(F.size(F.array_intersect(both, F.array_intersect(a, b))) / F.size(both))


def _count(sketch: Column, k: int) -> Column:
    share = (F.element_at(sketch, k).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def distinct_shingles(sketch: str, k: int = K) -> Column:
    """The number of different shingles: exact below ``k``, else estimated from the ``k``-th smallest hash."""
    return _count(F.col(sketch), k)


def containment(a: str, b: str, k: int = K) -> Column:
    """The estimated share of the shingles of ``a`` that ``b`` has too; 1 for an empty ``a``."""
    together = F.transform(F.array(merged(a, b, k)), lambda u: _count(u, k))[0]
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), resemblance(a, b, k) * together / distinct_shingles(a, k)))


def merge(parts: DataFrame, group: Sequence[str], sketch: str, k: int = K, salts: int = 64) -> DataFrame:
    """The sketch of each group of parts. Hashes are cut to ``k`` per salt first, so a group of any size stays small."""
    hashes = parts.select(*group, F.explode_outer(sketch).alias("__hash")).distinct()
    salted = hashes.withColumn("__salt", F.pmod(F.xxhash64("__hash"), F.lit(salts)))
    own = Window.partitionBy(*group, "__salt").orderBy("__hash")
    few = salted.withColumn("__at", F.row_number().over(own)).where(F.col("__at") <= k)
    out = few.groupBy(*group).agg(smallest(F.collect_list("__hash"), k).alias(sketch))
    return out


def hexed(sketch: str) -> Column:
    """The sketch as text: 16 hex digits for each hash."""
    return F.lower(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def _bucket(id: str, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are at most the id: a binary search in a constant array."""
    if not cuts:
        return F.lit(0)
    size = 1 << len(cuts).bit_length()
    held = constant_array(cuts + [cuts[-1]] * (size - len(cuts)))
    steps = constant_array([size >> k for k in range(1, size.bit_length())], "int")

    def down(low: Column, step: Column) -> Column:
        at = low + step
        return F.when((at <= len(cuts)) & (F.element_at(held, F.least(at, F.lit(size))) <= F.col(id)), at).otherwise(low)

    return F.coalesce(F.aggregate(steps, F.lit(0), down), F.lit(0))


def cut_by_id(docs: DataFrame, doc_id: str, each: int = 1000, most: int = 50_000) -> DataFrame:
    """``docs`` with ``__bucket`` and ``__tie``: buckets of about ``each`` rows (larger beyond ``most`` buckets) in the order of
    (id, tie), null ids first. ``__tie`` is a hash of the text.

    Ids are cut at percentiles. An id that is cut at several times has rows for several buckets, and so may have null:
    their rows are told apart by the tie. Only repeated rows, of one id and text, stay together.
    """
    ids = docs.agg(F.count("*").alias("n"), F.count(doc_id).alias("known")).first()
    buckets = min(most, ids["n"] // each)
    found: list[int] = []
    if buckets > 1 and ids["known"]:
        shares = constant_array([b / buckets for b in range(1, buckets)], "double")
        found = docs.agg(F.percentile_approx(doc_id, shares, F.lit(10 * buckets))).first()[0]
    cuts = sorted(set(found))
    times = constant_array([1, *[found.count(c) for c in cuts]])
    unknown = min(most, max(1, (ids["n"] - ids["known"]) // each))
    bucket, tie = _bucket(doc_id, cuts), F.xxhash64("text")
    start = F.element_at(constant_array([0, *cuts]), bucket + 1)
    n = F.when(bucket == 0, F.lit(unknown)).otherwise(F.element_at(times, bucket + 1))
    hot = F.when(bucket == 0, F.col(doc_id).isNull()).otherwise(F.col(doc_id) == start)
    share = F.least(F.floor((tie / F.lit(2.0**64) + 0.5) * n), n - 1)
    part = F.when(n == 1, F.lit(0)).when(hot, share).otherwise(n)
    return docs.withColumns({"__bucket": (bucket * F.lit(1 << 32) + part).cast("bigint"), "__tie": tie})


def with_next(docs: DataFrame, doc_id: str, shingle: int, k: int, each: int = 1000, most: int = 50_000) -> DataFrame:
    """(id, text, sketch, next_text, next_sketch): the next document's by ascending id, and after the last the first's.

    Buckets of ids are ordered side by side. Only the first row of every bucket is passed on to the bucket before it.
    """
    cut = cut_by_id(docs, doc_id, each, most)
    own = Window.partitionBy("__bucket").orderBy(F.col(doc_id).asc_nulls_first(), "__tie")
    rows = with_sketch(cut, "text", "sketch", shingle, k).withColumns(
        {"next_text": F.lead("text").over(own), "next_sketch": F.lead("sketch").over(own), "__last": F.lead(F.lit(1)).over(own).isNull()}
    )
    least = F.struct(F.coalesce(F.col(doc_id), F.lit(-(1 << 63))), "__tie")
    firsts = with_sketch(cut.groupBy("__bucket").agg(F.min_by("text", least).alias("__text")), "__text", "__sketch", shingle, k)
    # The buckets that hold rows, of a bounded number: each passes its first row to the one before, the first to the last.
    present = sorted(r[0] for r in cut.select("__bucket").distinct().collect())
    pairs = [{"__bucket": b, "__for": present[at - 1]} for at, b in enumerate(present)]
    before = small_table(docs.sparkSession, pairs, "__bucket: bigint, __for: bigint")
    passed = firsts.join(before, "__bucket").select(F.col("__for").alias("__bucket"), "__text", "__sketch", F.lit(True).alias("__last"))
    joined = rows.join(passed, ["__bucket", "__last"], "left")
    last = F.col("__last")
    return joined.select(
        doc_id,
        "text",
        "sketch",
        F.when(last, F.col("__text")).otherwise(F.col("next_text")).alias("next_text"),
        F.when(last, F.col("__sketch")).otherwise(F.col("next_sketch")).alias("next_sketch"),
    )


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """Sketches of each text and of an edited one, whose second half is the beginning of the next document.

    One row per document: id, ``n_chars``, ``edited`` (text), ``sketch``, ``edited_sketch``, ``next_sketch``.
    """
    own = docs.select(F.col(doc_id), F.coalesce(text, F.lit("")).alias("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = with_next(own, doc_id, shingle, k).select(doc_id, n.cast("bigint").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    return with_sketch(rows, "edited", "edited_sketch", shingle, k)

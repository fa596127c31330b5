"""Benchmark decontamination by winnowing.

Texts become words. Every run of ``GRAM`` consecutive words is hashed, and in every run of ``SPAN - GRAM + 1`` consecutive
hashes the smallest (the last of equals) is kept as a fingerprint, with the words around it. A passage of ``SPAN``
words that occurs in two texts spans exactly such a run, so the same fingerprint is kept in both: none can be missed.
Fingerprints of documents and items meet in a Spark join on their hash; each hit is then extended word by word to both
sides, and counts if ``SPAN`` words in a row are equal. An item of fewer words, but not none, must occur as a whole:
all runs of its length are its fingerprints' partners.

Most document fingerprints meet nothing. Where the items have at most ``FILTER_HASHES`` different hashes (16 MB), these
travel to the tasks and only fingerprints among them are given out; beyond that bound the join sees them all. The
result is the same.

Defined cases: null and empty texts have no words, no hits and ``items_sha256`` of the empty string. Items without
words, or with a null id, are left out. An item id that occurs in several rows counts once. Repeated document rows
get a result each. Empty tables give empty results (or no hits). Columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import staged, words_of

SPAN = 10  # words in a row that make a hit
GRAM = 5  # words in a hashed run
FILTER_HASHES = 2_000_000

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_PRINTS = pa.list_(
    pa.struct(
        [("hash", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("left", pa.string()), ("gram", pa.string()), ("right", pa.string())]
    )
)
_SCHEMA = "id {kind}, n_words int, prints array<struct<hash: bigint, at: int, n: int, left: string, gram: string, right: string>>"


def _run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` words, from the words' hashes."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = (out + words[k : k + count]) * _PRIME
        out ^= out >> np.uint64(29)
    return out * np.uint64(2 * n + 1)


def _winnowed(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash, the last of equals, of every ``window`` hashes in a row."""
    count = len(hashes) - window + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    best, at = hashes[:count].copy(), np.arange(count)
    for k in range(1, window):
        other = hashes[k : k + count]
        less = other <= best
        best[less] = other[less]
        at[less] = np.nonzero(less)[0] + k
    return np.unique(at)


def _prints(words: list[bytes], short: tuple[int, ...], only: np.ndarray | None, item: bool, span: int, gram: int) -> list[dict]:
    """The fingerprints of one text with their surroundings; of an item of fewer than ``span`` words, the whole."""
    if not words:
        return []
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    wanted: list[tuple[int, np.ndarray, np.ndarray]] = []
    if item and len(words) < span:
        wanted.append((len(words), np.zeros(1, np.int64), _run_hashes(each, len(words))))
    else:
        hashes = _run_hashes(each, gram)
        at = _winnowed(hashes, span - gram + 1)
        wanted.append((gram, at, hashes[at]))
        if not item:
            for n in short:
                hashes = _run_hashes(each, n)
                wanted.append((n, np.arange(len(hashes)), hashes))
    out = []
    for n, at, hashes in wanted:
        if only is not None and len(hashes):
            place = np.minimum(np.searchsorted(only, hashes), len(only) - 1)
            at, hashes = at[only[place] == hashes], hashes[only[place] == hashes]
        side = span - n if n == gram else 0
        for p, h in zip(at.tolist(), hashes.view(np.int64).tolist(), strict=True):
            join = lambda part: b" ".join(part).decode("utf-8", "surrogatepass")
            out.append(
                {"hash": h, "at": p, "n": n, "left": join(words[max(0, p - side) : p]), "gram": join(words[p : p + n]), "right": join(words[p + n : p + n + side])}
            )
    return out


def fingerprints(
    texts: DataFrame, id: str, text: str, item: bool, short: tuple[int, ...] = (), only=None, span: int = SPAN, gram: int = GRAM
) -> DataFrame:
    """(id, n_words, prints) of each row. ``short``: the lengths of whole items to look for; ``only``: a broadcast of
    the sorted hashes worth giving out, or None."""
    kind = texts.schema[id].dataType.simpleString()
    arrow_kind = texts.select(id).limit(0).toArrow().schema.field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = only.value if only is not None else None
        for batch in batches:
            rows = [words_of(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            prints = [_prints(w, short, keep, item, span, gram) for w in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_kind), pa.array([len(w) for w in rows], pa.int32()), pa.array(prints, _PRINTS)],
                names=["id", "n_words", "prints"],
            )

    return texts.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, _SCHEMA.format(kind=kind))


def _equal_right(a: str, b: str):
    """How many words in a row, from the first on, are equal."""
    x, y = F.split(F.col(a), " "), F.split(F.col(b), " ")
    same = F.zip_with(x, y, lambda p, q: p.eqNullSafe(q) & p.isNotNull() & (p != ""))
    return F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, F.size(same))


def _equal_left(a: str, b: str):
    x, y = F.reverse(F.split(F.col(a), " ")), F.reverse(F.split(F.col(b), " "))
    same = F.zip_with(x, y, lambda p, q: p.eqNullSafe(q) & p.isNotNull() & (p != ""))
    return F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, F.size(same))


def contamination(
    documents: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    filter_hashes: int = FILTER_HASHES,
) -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_hit``, ``n_items``, ``items`` (their ids as sorted strings)."""
    spark = documents.sparkSession
    known = staged(
        fingerprints(items.where(F.col(item_id).isNotNull()), item_id, text, True, span=span, gram=gram)
        .select("id", F.explode("prints").alias("p"))
        .select(F.col("id").cast("string").alias("item"), "p.*"),
        "item-prints",
    )
    # An item of exactly ``gram`` words is short as well; it is told by its empty surroundings.
    whole = (F.col("left") == "") & (F.col("right") == "")
    lengths = tuple(r[0] for r in known.where(whole & (F.col("n") < span)).select("n").distinct().orderBy("n").collect())
    only = None
    hashes = known.select("hash").distinct()
    if hashes.count() <= filter_hashes:
        held = np.sort(hashes.toPandas()["hash"].to_numpy(np.int64).view(np.uint64))
        only = spark.sparkContext.broadcast(held if len(held) else np.zeros(1, np.uint64))

    found = staged(
        fingerprints(documents, doc_id, text, False, lengths, only, span, gram).withColumn("row", F.monotonically_increasing_id()), "document-prints"
    )
    d = found.select("row", F.explode("prints").alias("p")).select("row", "p.*")
    k = known.select("item", "hash", "n", F.col("gram").alias("i_gram"), F.col("left").alias("i_left"), F.col("right").alias("i_right"))
    hits = d.join(k, ["hash", "n"]).where(F.col("gram") == F.col("i_gram"))
    before = F.when((F.col("left") == "") | (F.col("i_left") == ""), 0).otherwise(_equal_left("left", "i_left"))
    after = F.when((F.col("right") == "") | (F.col("i_right") == ""), 0).otherwise(_equal_right("right", "i_right"))
    alone = (F.col("i_left") == "") & (F.col("i_right") == "")
    spans = hits.select("row", "item", "at", "n", before.alias("before"), after.alias("after"), alone.alias("alone")).where(
        F.col("alone") | (F.col("n") + F.col("before") + F.col("after") >= span)
    )
    spans = staged(
        spans.select(
            "row",
            "item",
            (F.col("at") - F.when(F.col("alone"), 0).otherwise(F.col("before"))).alias("start"),
            (F.col("at") + F.col("n") + F.when(F.col("alone"), 0).otherwise(F.col("after"))).alias("end"),
        ).distinct(),
        "spans",
    )
    places = (
        spans.select("row", "start", "end")
        .distinct()
        .select("row", F.explode(F.sequence("start", F.col("end") - 1)).alias("place"))
        .distinct()
        .groupBy("row")
        .agg(F.count("*").alias("n_hit"))
    )
    named = spans.select("row", "item").distinct().groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return (
        found.select("row", "id", "n_words")
        .join(places, "row", "left")
        .join(named, "row", "left")
        .select(
            F.col("id").alias(doc_id),
            F.col("n_words").cast("bigint").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )

"""Exact Jaccard join of shingle sets by vertical partitioning.

A document's n-grams are hashed to 64 bits, and the hash order is the global n-gram order. It is cut into fragments twice.

*Candidates.* Sets that link differ in at most D n-grams, a bound that follows from their sizes. The order is cut into
F > D fragments of equal width (about nine n-grams each), so some fragment holds the same n-grams in both sets, and its
digest is a key under which they meet. F depends on the size class of the smaller set; a set gives out the keys of its
own class and of the classes of the smaller sets it may link with. F leaves room for D // ``SLACK`` empty fragments;
a set with more of them (rare) gives out the keys of further orders as well, until an order has few enough. Two
sets that could miss each other under one order both go on to the next, so no link is lost. Common passages
and frequent n-grams do not bring sets together: only a whole fragment does.

*Overlaps.* The order is cut once more into parts of some ``PART`` n-grams. A candidate pair's overlap is counted in every
part separately and summed per pair, so a very long document is many rows in many tasks.

Copies are one set, and no group gives out all its pairs. Every set has a level, falling off like 1/2, 1/4, ... In each
round the sets of the highest ``STEP`` levels of a group (twice as many in the second round, and so on) meet the others
of that group, but for those already linked to them through others; they are then done, and a group with one component left is done as a whole. A crowd of near copies
is one component after a round or two. Only members that are not linked to each other are compared one by one, and
most of those only by their parity sketches of ``SKETCH`` bits: in as many bits as these differ, at least, the sets do.

Defined cases: null and empty texts, and texts without words, have empty sets, which link with nothing: their component
is their own id. Texts of fewer words than the shingle have one n-gram, all their words. A null id is never a component's
smallest unless all its ids are null. Repeated rows are kept, each with the result. Empty tables give empty results.
Different n-grams of equal 64-bit hash count as one. Other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import discard, staged
from rollbook.llm.simhash import components

SHINGLE = 3
PERCENT = 90
LEAST_PERCENT = 85
SLACK = 64
PART = 512
SKETCH = 512
STEP = 3
BROADCAST_KEYS = 1_000_000  # sets asked for in the second pass travel to the tasks up to so many (16 MB)

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_WORDS_KEPT = 1 << 19  # words whose hash a task remembers
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_ALL = (1 << 64) - 1
_ROWS = 512  # documents whose n-grams are handed on at once


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of a well-known generator)."""
    h = (h ^ (h >> np.uint64(30))) * _ODD[1]
    h = (h ^ (h >> np.uint64(27))) * _ODD[2]
    return h ^ (h >> np.uint64(31))


class Words(dict):
    """Numbers of the words a task has met; ``hashes`` holds their 64-bit hashes by number."""

    def __init__(self):
        self.hashes = np.zeros(1 << 10, np.uint64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        if number == len(self.hashes):
            self.hashes = np.concatenate((self.hashes, np.zeros_like(self.hashes)))
        self.hashes[number] = xxhash.xxh64_intdigest(word)
        return number


def shingle_set(text: bytes | None, shingle: int, known: Words) -> np.ndarray:
    """The distinct n-grams of a text as sorted 64-bit hashes."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > _WORDS_KEPT:
        known.clear()
    hashes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    hashes = known.hashes[hashes]
    width = min(shingle, len(words))
    grams = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        grams = _mixed(grams * _ODD[0] + hashes[k : len(words) - width + 1 + k])
    grams.sort()
    return grams[np.concatenate(([True], grams[1:] != grams[:-1]))]


@lru_cache(maxsize=None)
def _classes(percent: int, most: int) -> tuple[list[int], list[int]]:
    """Size classes up to a size of ``most``: their first sizes, and in how many n-grams linked sets may differ."""
    lows, differ, low = [], [], 1
    while low <= most:
        after = low * 100 // percent + 1
        small, large = after - 1, (after - 1) * 100 // percent
        # 100 o >= percent (s + l - o)  <=>  s + l - 2 o <= (s + l) (100 - percent) / (100 + percent)
        lows.append(low)
        differ.append((small + large) * (100 - percent) // (100 + percent))
        low = after
    return lows, differ


def _fragment_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Digests of the fragments by which a set meets the sets it may link with."""
    n = len(hashes)
    # Up to a power of two, so that few tables are remembered.
    lows, differ = _classes(percent, 1 << n.bit_length())
    keys = []
    for k in range(bisect_right(lows, -(-n * percent // 100)) - 1, bisect_right(lows, n)):
        if differ[k] == 0:  # equal sets are one already
            continue
        empty = differ[k] // SLACK
        cuts = differ[k] + 1 + empty
        order = 0
        while True:
            ranks = hashes if order == 0 else np.sort(_mixed(hashes + np.uint64(order * int(_ODD[0]) & _ALL)))
            fragment = (ranks >> np.uint64(32)) * np.uint64(cuts) >> np.uint64(32)
            starts = np.concatenate(([0], np.flatnonzero(fragment[1:] != fragment[:-1]) + 1))
            some = fragment[starts]
            name = some + np.uint64(((lows[k] << 20) + order) * int(_ODD[2]) & _ALL)
            keys.append(_mixed(_mixed(name) + np.add.reduceat(_mixed(ranks ^ _ODD[1]), starts)))
            if cuts - len(some) <= empty:
                break
            order += 1
    return np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)


def _parts_of(n: int) -> int:
    """Into how many parts the order is cut for pairs whose smaller set has n n-grams: a power of two."""
    return 1 << max(0, (-(-n // PART) - 1).bit_length())


def _digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.astype("<u8").tobytes())


_BITS = [f"s{k}" for k in range(SKETCH // 64)]  # the columns of a sketch


def _sketch(hashes: np.ndarray) -> np.ndarray:
    """Per bit whether an odd number of the set's hashes fall on it."""
    odd = np.bincount((hashes & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint8) & 1
    return np.packbits(odd).view("<i8")


def _may_link(percent: int) -> Column:
    """Whether sizes and sketches of a row and its centre leave room for a link."""
    apart = reduce(Column.__add__, [F.bit_count(F.col(c).bitwiseXOR(F.col(f"c_{c}"))) for c in _BITS])
    sizes = F.least("n", "c_n") * 100 >= F.greatest("n", "c_n") * percent
    return sizes & (apart * (100 + percent) <= (F.col("n") + F.col("c_n")) * (100 - percent))


def _longs(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.uint64).view(np.int64)


def _prints(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(id, n, digest, keys, sketch) of each document; without n-grams the last three are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            sizes, digests, keys, sketches = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                own = shingle_set(text, shingle, known)
                sizes.append(len(own))
                digests.append(_digest(own) if len(own) else None)
                keys.append(_longs(_fragment_keys(own, percent)) if len(own) else None)
                sketches.append(_sketch(own))
            bits = np.array(sketches, np.int64).reshape(len(sizes), len(_BITS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                    *[pa.array(column) for column in bits.T],
                ],
                names=["id", "n", "digest", "keys", *_BITS],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {kind}, n bigint, digest binary, keys array<bigint>, " + ", ".join(f"{c} bigint" for c in _BITS))


def _segments(docs: DataFrame, sets: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The n-grams of the given ``sets`` (digest, node) by parts: (node, parts, part, grams), made from the texts again.

    The digests of a known, bounded number of sets travel to the tasks; of more, they are joined in a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for at in range(0, len(texts), _ROWS):
                own = [shingle_set(t, shingle, known) for t in texts[at : at + _ROWS].to_pylist()]
                own = [h for h in own if len(h)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(h) for h in own], pa.binary()), pa.array([h.astype("<u8").tobytes() for h in own], pa.binary())],
                    names=["digest", "grams"],
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, grams in zip(batch.column("node").to_pylist(), batch.column("grams"), strict=True):
                own = np.frombuffer(grams.as_py(), "<u8")
                n = len(own)
                for parts in sorted({_parts_of(n), _parts_of(-(-n * percent // 100))}):
                    part = ((own >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                    at = np.searchsorted(part, np.arange(parts + 1))
                    held = [k for k in range(parts) if at[k] < at[k + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([node] * len(held), pa.int64()),
                            pa.array([parts] * len(held), pa.int64()),
                            pa.array(held, pa.int64()),
                            pa.array([own[at[k] : at[k + 1]].tobytes() for k in held], pa.binary()),
                        ],
                        names=["node", "parts", "part", "grams"],
                    )

    asked = sets.select("digest", "node")
    if sets.count() <= BROADCAST_KEYS:
        asked = F.broadcast(asked)
    met = docs.select("text").mapInArrow(run, "digest binary, grams binary").join(asked, "digest").select("node", "grams")
    rows = met.mapInArrow(cut, "node bigint, parts bigint, part bigint, grams binary")
    # A set has the same rows in each of its copies: one of each is kept.
    return rows.groupBy("node", "parts", "part").agg(F.first("grams").alias("grams"))


def _overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """(a, b, na, nb, shared) of the pairs: overlaps counted in each part, then summed per pair."""
    smaller = F.least("na", "nb")
    over = F.ceil(smaller / F.lit(PART)) - 1
    parts = F.pow(F.lit(2), F.when(over > 0, F.length(F.bin(over))).otherwise(0)).cast("bigint")
    spread = pairs.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    left = segments.select(F.col("node").alias("a"), "parts", "part", F.col("grams").alias("ga"))
    right = segments.select(F.col("node").alias("b"), "parts", "part", F.col("grams").alias("gb"))
    both = spread.join(right, ["b", "parts", "part"]).join(left, ["a", "parts", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = [
                len(np.intersect1d(np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8"), assume_unique=True))
                for x, y in zip(batch.column("ga"), batch.column("gb"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(shared, pa.int64())], names=["a", "b", "na", "nb", "shared"])

    counted = both.select("a", "b", "na", "nb", "ga", "gb").mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, shared bigint")
    return counted.groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared"))


def _level(node: str):
    """In how many zeros the node's hash ends: half of all nodes have level 0, a quarter 1, and so on."""
    top = F.lit(1 << 62)
    h = F.xxhash64(F.lit("level"), node).bitwiseAND(top - 1).bitwiseOR(top)
    return F.bit_count(h.bitwiseAND(-h) - 1)


def linked(docs: DataFrame, sets: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Edges (node, root) from each set that links with others to its component's smallest.

    ``sets`` are distinct: (node, n, digest, keys, sketch).
    """
    keyed = sets.select("node", "n", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("sets")).where(F.col("sets") > 1).select("key")
    met = staged(keyed.join(shared, "key"), "keys")
    live = staged(met.join(sets.select("node", *_BITS), "node").withColumn("level", _level("node")), "met")
    discard(met)
    asked = staged(live.select("node").distinct().join(sets.select("node", "digest"), "node"), "asked")
    segments = staged(_segments(docs, asked, shingle, percent), "segments")
    discard(asked)
    roots = sets.sparkSession.createDataFrame([], "node bigint, root bigint")
    tested: list[DataFrame] = []
    left = live
    while True:
        # Who is linked already, and which groups still hold several components.
        placed = left.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        groups = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("level").alias("top"))
        groups = groups.where(F.col("low") < F.col("high")).select("key", "top")
        before, live = live, staged(placed.join(groups, "key"), "live")
        discard(before)
        if live.isEmpty():
            discard(live, segments, *tested)
            return roots
        centre = F.col("level") > F.col("top") - STEP * (len(tested) + 1)
        centres = live.where(centre).select("key", *[F.col(c).alias(f"c_{c}") for c in ("node", "n", "root", *_BITS)])
        met = live.join(centres, "key").where(
            (F.col("root") != F.col("c_root")) & _may_link(percent) & (~centre | (F.col("node") > F.col("c_node")))
        )
        first = F.col("node") < F.col("c_node")
        pairs = met.select(
            F.least("node", "c_node").alias("a"),
            F.greatest("node", "c_node").alias("b"),
            F.when(first, F.col("n")).otherwise(F.col("c_n")).alias("na"),
            F.when(first, F.col("c_n")).otherwise(F.col("n")).alias("nb"),
        ).distinct()
        for seen in tested:
            pairs = pairs.join(seen.select("a", "b"), ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        tested.append(pairs)
        shared = F.col("shared") * 100 >= (F.col("na") + F.col("nb") - F.col("shared")) * percent
        found = staged(_overlaps(pairs, segments).where(shared).select("a", "b"), "links")
        if not found.isEmpty():
            older, roots = roots, components(found.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
            discard(older)
        discard(found)
        # Centres have met all others of their groups: they leave them.
        left = live.where(~centre).drop("root", "top")


def joined(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: its id, ``n_shingles`` and ``component_id``, the smallest id that links reach."""
    if percent < LEAST_PERCENT:
        raise ValueError(f"fragments are too small to tell sets apart below {LEAST_PERCENT} percent")
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    prints = staged(_prints(docs, shingle, percent), "prints")
    distinct = prints.where("n > 0").groupBy("digest").agg(F.first("n").alias("n"), F.min("id").alias("least"), F.first("keys").alias("keys"), *[F.first(c).alias(c) for c in _BITS])
    sets = staged(distinct.withColumn("node", F.monotonically_increasing_id()), "sets")
    roots = linked(docs, sets, percent, shingle)
    placed = sets.select("node", "digest", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.select("digest", "root").join(smallest, "root").select("digest", "component_id")
    some = prints.where("n > 0").select("id", "n", "digest").join(named, "digest").select("id", "n", "component_id")
    none = prints.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return some.union(none).select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id")

"""Near-duplicate search by SimHash with a hierarchical index in Gray order.

Distinct fingerprints are sorted by their rank in the reflected Gray code, so neighbours differ in few bits, and cut
into blocks of at most ``BLOCK``. A block's node holds the bits that all its fingerprints share: a mask and a pattern.
``FAN`` consecutive nodes are factored into an upper node in the same way, up to one root. The search starts with the
root against itself and descends by equi-joins from pairs of nodes to pairs of their children. Two nodes are at least
as many bits apart as differ among the bits both share; the difference only grows on the way down, so a pair of groups
beyond ``MAX_BITS`` is pruned with all that is below it. Surviving pairs of blocks are compared in numpy, first by
nodes of ``LEAF`` fingerprints, then by exact differences. The result is exact: there is no cap on a group.

A block pair gives out a spanning forest of its links, not all pairs: copies meet in one fingerprint first, and a
crowd of near copies costs one row per fingerprint. Components come from alternating large-star and small-star
rounds over that forest, each a written table.

Defined cases: null and empty texts, and texts without words, have fingerprint 0 and link like any other. A null id is
never a component's smallest unless all its ids are null. Repeated rows are kept, each with the result. Empty tables
give empty results. Other columns are kept; one with the name of an output is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.common import discard, free_of, staged

SHINGLE = 3
MAX_BITS = 2
SEED = 42
BLOCK = 4096
LEAF = 64
FAN = 32
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_CHUNK = 16384  # shingles counted at once


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes (repeats count)."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        line, digest = b" ".join(words), xxhash.xxh64_intdigest
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    counts = np.zeros(64, np.int64)
    every = np.array(hashes, np.uint64)
    for k in range(0, len(every), _CHUNK):
        bits = np.unpackbits(every[k : k + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(every)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "code", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit number."""
    docs = free_of(docs, out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [fingerprint(t, shingle) for t in batch.column(at).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.array(codes, np.uint64).view(np.int64), pa.int64())], names=[*batch.schema.names, out]
            )

    return docs.mapInArrow(run, schema)


def gray_rank(code: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray code."""
    rank = code.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _rank_column(code: str):
    """``gray_rank`` as a column, shifted so that signed order is the order of ranks."""
    rank = F.col(code)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


_NODES = "node bigint, mask bigint, pattern bigint, codes binary"


def _blocks(codes: DataFrame, block: int) -> DataFrame:
    """Consecutive codes in Gray order, at most ``block`` to a row, with what they share."""
    ranked = codes.withColumn("rank", _rank_column("code"))
    n = max(1, -(-codes.count() // (16 * block)))
    part = F.spark_partition_id().alias("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, number = np.zeros(0, np.int64), 0

        def row(held: np.ndarray, where: int) -> pa.RecordBatch:
            mask = ~(np.bitwise_or.reduce(held) ^ np.bitwise_and.reduce(held))
            values = ([where], [mask], [held[0] & mask], [held.astype("<i8").tobytes()])
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                names=["node", "mask", "pattern", "codes"],
            )

        where = 0
        for batch in batches:
            rest = np.concatenate((rest, batch.column("code").to_numpy(zero_copy_only=False)))
            where = (batch.column("part")[0].as_py() << 32) if batch.num_rows else where
            while len(rest) > block:
                yield row(rest[:block], where + number)
                rest, number = rest[block:], number + 1
        if len(rest):
            yield row(rest, where + number)

    return ranked.repartitionByRange(n, "rank").sortWithinPartitions("rank").select("code", part).mapInArrow(run, _NODES)


def _upper(nodes: DataFrame) -> DataFrame:
    """Parents of consecutive nodes: ``parent`` is already set; what all children share is and-ed together."""
    shared = F.bit_and("mask")
    ones, zeros = F.bit_and(F.col("pattern")), F.bit_or(F.col("pattern"))
    return (
        nodes.groupBy(F.col("parent").alias("node"))
        .agg(shared.alias("m"), ones.alias("a"), zeros.alias("o"))
        .select("node", F.col("m").bitwiseAND(F.bitwise_not(F.col("a").bitwiseXOR(F.col("o")))).alias("mask"), F.col("a").alias("pattern"))
    )


def _near(a: str, b: str, limit: int):
    """The accumulated difference of two nodes' shared bits is within the limit."""
    both = F.col(f"{a}.mask").bitwiseAND(F.col(f"{b}.mask"))
    return F.bit_count(F.col(f"{a}.pattern").bitwiseXOR(F.col(f"{b}.pattern")).bitwiseAND(both)) <= limit


def _levels(blocks: DataFrame, fan: int) -> list[DataFrame]:
    """The index from the blocks up to one root: (node, parent, mask, pattern) each."""
    # Consecutive numbers: counted per range partition (the upper half of the node), then added up.
    keys = blocks.select("node", "mask", "pattern").withColumn("part", F.shiftright("node", 32))
    per_part = keys.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # one row per partition
    starts, total = {}, 0
    for r in per_part:
        starts[r["part"]], total = total, total + r["n"]
    offsets = blocks.sparkSession.createDataFrame(list(starts.items()) or [(0, 0)], "part bigint, start bigint")
    level = keys.join(offsets, "part").select(
        "node", (F.col("start") + F.col("node").bitwiseAND(F.lit((1 << 32) - 1))).alias("place"), "mask", "pattern"
    )
    levels, size = [], total
    while True:
        level = staged(level.withColumn("parent", F.floor(F.col("place") / fan)), f"level{len(levels)}")
        levels.append(level)
        if size <= 1:
            return levels
        size = -(-size // fan)
        level = _upper(level).withColumn("place", F.col("node"))


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edges (code, root) of a spanning forest of the links ``a[i] - b[i]``; each joins a code with its smallest."""
    codes, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(codes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(codes))
    return np.stack((codes[moved], codes[root[moved]]))


def _links(a: np.ndarray, b: np.ndarray, limit: int, leaf: int) -> np.ndarray:
    """Spanning forest of all links between two blocks, pruning leaf nodes by the bits they share."""

    def nodes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.arange(0, len(codes), leaf)
        ones, some = np.bitwise_and.reduceat(codes, at), np.bitwise_or.reduceat(codes, at)
        return at, ~(ones ^ some), ones

    at_b, mask_b, ones_b = nodes(b)
    xs, ys, held = [], [], 0
    for at, mask, ones in zip(*nodes(a), strict=True):
        near = np.bitwise_count((ones_b ^ ones) & mask_b & mask) <= limit
        if not near.any():
            continue
        own = a[at : at + leaf]
        other = np.concatenate([b[k : k + leaf] for k in at_b[near]])
        linked = np.bitwise_count(own[:, None] ^ other[None, :]) <= limit
        linked &= own[:, None] != other[None, :]
        if not linked.any():
            continue
        # Per other code one link to its first own code; own codes that share another are linked to one another.
        some = linked.any(axis=0)
        xs.append(own[linked.argmax(axis=0)[some]])
        ys.append(other[some])
        wide = linked.astype(np.float32)
        i, j = np.nonzero(np.triu(wide @ wide.T > 0, 1))
        xs.append(own[i])
        ys.append(own[j])
        held += len(xs[-1]) + len(xs[-2])
        if held > 500_000:
            forest = _forest(np.concatenate(xs), np.concatenate(ys))
            xs, ys, held = [forest[0]], [forest[1]], 0
    if not xs:
        return np.zeros((2, 0), np.uint64)
    return _forest(np.concatenate(xs), np.concatenate(ys))


def links(codes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK, leaf: int = LEAF, fan: int = FAN) -> DataFrame:
    """Edges (a, b) that connect exactly those distinct ``code`` that chains of links connect."""
    blocks = staged(_blocks(codes, block), "blocks")
    levels = _levels(blocks, fan)
    root = levels[-1]
    pairs = root.select(F.col("node").alias("x"), F.col("node").alias("y"))
    done = [blocks, *levels]
    for depth, level in enumerate(reversed(levels[:-1])):
        a, b = level.alias("a"), level.alias("b")
        pairs = (
            pairs.join(a, F.col("a.parent") == F.col("x"))
            .join(b, F.col("b.parent") == F.col("y"))
            .where(_near("a", "b", max_bits) & (F.col("a.place") <= F.col("b.place")))
            .select(F.col("a.node").alias("x"), F.col("b.node").alias("y"))
        )
        pairs = staged(pairs, f"pairs{depth}")
        done.append(pairs)
    held = blocks.select("node", "codes")
    both = pairs.join(held.withColumnsRenamed({"node": "x", "codes": "cx"}), "x").join(
        held.withColumnsRenamed({"node": "y", "codes": "cy"}), "y"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("cx"), batch.column("cy"), strict=True):
                found = _links(np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8"), max_bits, leaf)
                if found.shape[1]:
                    yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in found], names=["a", "b"])

    found = staged(both.select("cx", "cy").repartition(F.xxhash64("cx", "cy")).mapInArrow(run, "a bigint, b bigint"), "links")
    discard(*done)
    return found


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of some edge reaches; alternating star rounds."""
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            pairs = both(e)
        else:
            pairs = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        met = pairs.join(low, "a")
        if large:
            out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = met.select("b", "low").union(low.select(F.col("a"), F.col("low"))).toDF("a", "b")
        return out.where(F.col("a") != F.col("b")).distinct()

    edges = staged(edges.where(F.col("a") != F.col("b")).distinct(), "edges0")
    mark, number = None, 0
    while True:
        number += 1
        before, edges = edges, staged(star(star(edges, True), False), f"edges{number}")
        discard(before)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            out = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            out.staged_at = edges.staged_at
            return out
        mark = now


def _groups(coded: DataFrame, max_bits: int) -> DataFrame:
    """(code, least, group_code): each distinct code with its smallest id and its component, from (id, code)."""
    # Copies share a code: from here on distinct codes only.
    codes = staged(coded.groupBy("code").agg(F.min("id").alias("least")), "distinct")
    roots = components(links(codes.select("code"), max_bits))
    return codes.join(roots, F.col("node") == F.col("code"), "left").select("code", "least", F.coalesce("root", "code").alias("group_code"))


def _coded(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return staged(with_fingerprint(own, "text", "code", shingle).select("id", "code"), "codes")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``. Texts are read once."""
    coded = _coded(docs, doc_id, text, shingle)
    placed = _groups(coded, max_bits)
    smallest = placed.groupBy("group_code").agg(F.min("least").alias("component_id"))
    named = placed.select("code", "group_code").join(smallest, "group_code")
    fingerprint = F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint")
    return coded.join(named, "code").select(F.col("id").alias(doc_id), fingerprint, "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component: that of smallest id (of a repeated id, that of smallest fingerprint).

    Fingerprints are worked out a second time rather than written beside the texts, and rows meet their
    component's choice by fingerprint and id together: texts are shuffled once, and copies are spread by their ids.
    """
    placed = _groups(_coded(docs, doc_id, text, shingle), max_bits)
    first = F.min(F.struct(F.col("least").isNull().alias("unknown"), F.col("least"), F.col("code")))
    chosen = placed.groupBy("group_code").agg(first.alias("first")).select(F.col("first.code").alias("__code"), F.col("first.least").alias("__id"))
    rows = with_fingerprint(docs, text, "__own", shingle)
    met = rows.join(staged(chosen, "chosen"), (F.col("__own") == F.col("__code")) & F.col(doc_id).eqNullSafe(F.col("__id")))
    # Only repeated rows are left to be told apart; they lie together already.
    return met.dropDuplicates(["__own", doc_id]).drop("__own", "__code", "__id")

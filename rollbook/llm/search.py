"""Ranked lexical search, reversed: the queries are indexed and every document is streamed through that index.

The items' terms make up a vocabulary with postings (term -> items). One pass over the documents counts what the weights
need: documents with terms, all terms, and the documents holding each term of the vocabulary. A second pass looks up
each document's term counts in the postings, adds up the scores of the items it touches, and keeps a heap of the ``TOP``
best documents for every item. A task's heaps are its only output; they are merged per item by score and id.

The index of a block of items travels to the tasks whole, so items are cut into blocks of at most about ``BLOCK_BYTES`` of
text (by a hash of the row, never less than one block); every block is searched against all documents.

Defined cases: null and empty texts have no terms, match nothing and do not count as documents. Each item row is an item
of its own, whatever its id (null and repeated ids too). Documents of equal score come by ascending id, null ids last;
repeated rows take a place each. Empty tables give empty results. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import discard, staged, words_of

TOP = 10
BLOCK_BYTES = 16 << 20
_SCORES = "item int, doc_id bigint, score bigint"
_NO_ID = 1 << 63  # sorts behind every id


class Index:
    """The vocabulary of a block of items and, per term, the items that hold it."""

    def __init__(self, texts: list[bytes | None]):
        self.items = len(texts)
        self.terms: dict[bytes, int] = {}
        holders: list[list[int]] = []
        for item, text in enumerate(texts):
            for term in sorted(set(words_of(text))):
                place = self.terms.setdefault(term, len(holders))
                if place == len(holders):
                    holders.append([])
                holders[place].append(item)
        self.postings = [np.array(h, np.int32) for h in holders]

    def counts(self, text: bytes | None) -> tuple[int, list[tuple[int, int]]]:
        """Number of a text's terms, and (term, occurrences) of those that some item holds."""
        words = words_of(text)
        if not words:
            return 0, []
        terms = self.terms
        return len(words), [(terms[w], c) for w, c in Counter(words).items() if w in terms]


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def damping(length: int, documents: int, terms: int) -> int:
    """How much a document's length, against the mean, holds its term counts back."""
    return 100 - 90 + (90 * length * documents) // terms


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()


def statistics(docs: DataFrame, index: Index) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and per term of the index the documents holding it."""
    size = len(index.postings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(size + 2, np.int64)
        for batch in batches:
            for text in _texts(batch):
                n, found = index.counts(text)
                if n:
                    totals[size] += 1
                    totals[size + 1] += n
                    totals[[term for term, _ in found]] += 1
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(totals[some])], names=["place", "n"])

    summed = docs.select("text").mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    totals = np.zeros(size + 2, np.int64)
    for row in summed.toLocalIterator():  # at most one row per term of the block
        totals[row["place"]] = row["n"]
    return int(totals[size]), int(totals[size + 1]), totals[:size]


def _searched(docs: DataFrame, index: Index, top: int) -> DataFrame:
    """Per task and item the ``top`` best documents: (item, doc_id, score)."""
    documents, terms, holding = statistics(docs, index)
    weights = [weight(documents, int(h)) for h in holding]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Heaps of (score, -id, id); the worst of each full heap beside it, for whole arrays of items at once.
        heaps: list[list[tuple]] = [[] for _ in range(index.items)]
        least = np.zeros(index.items, np.int64)  # a score has to be above 0
        scores = np.zeros(index.items, np.int64)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), _texts(batch), strict=True):
                n, found = index.counts(text)
                if not found:
                    continue
                m = damping(n, documents, terms)
                touched = []
                for term, tf in found:
                    holders = index.postings[term]
                    scores[holders] += weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                    touched.append(holders)
                touched = np.unique(np.concatenate(touched)) if len(touched) > 1 else touched[0]
                own = scores[touched]
                scores[touched] = 0
                key = _NO_ID if doc_id is None else doc_id
                good = (own >= least[touched]) & (own > 0)
                for item, score in zip(touched[good].tolist(), own[good].tolist(), strict=True):
                    heap = heaps[item]
                    entry = (score, -key, doc_id)
                    if len(heap) < top:
                        heapq.heappush(heap, entry)
                    elif entry[:2] > heap[0][:2]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == top:
                        least[item] = heap[0][0]
        rows = [(item, entry[2], entry[0]) for item, heap in enumerate(heaps) for entry in heap]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["item", "doc_id", "score"]
        )

    return docs.select("doc_id", "text").mapInArrow(run, _SCORES)


def ranked(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    top: int = TOP, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its ``top`` documents of highest score above 0."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = staged(rows, "items")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    found = []
    for block in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).orderBy("row").collect()  # bounded by block_bytes
        if not own:
            continue
        index = Index([r["text"].encode() if r["text"] is not None else None for r in own])
        best = _searched(docs, index, top)
        # Merging the tasks' heaps: Spark keeps the first rows of each task before it shuffles.
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = docs.sparkSession.createDataFrame([(k, r["item_id"]) for k, r in enumerate(own)], "item int, item_id bigint")
        found.append(staged(best.join(names, "item").select("item_id", "rank", "doc_id", "score"), f"ranked{block}"))
    discard(rows)
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out

"""Toxicity: embeddings of subwords, averaged into a linear softmax, trained jointly in numpy.

The subwords of a text are its runs of 3 to 5 bytes within words (A-Z lowered, the ends of a word marked), hashed to
``BUCKETS`` vectors of ``DIM``. A misspelt word shares most of its runs, and so their vectors, with the words seen. A
word that repeats itself at once counts once, else its runs alone would make up a window. A text is read in windows of ``2 * STRIDE`` bytes, half overlapping; each window's vectors are averaged, the average goes
through the softmax, and the text's score is that of its most toxic window: one remark in a long text is not thinned
out. Training follows the same rule: each step takes every text's worst window under the current model and moves
embeddings and softmax together.

The model is fitted on the driver on at most ``MAX_SAMPLE`` labelled documents per label, of those of at most
``SAMPLE_BYTES`` each (so 2 * MAX_SAMPLE * SAMPLE_BYTES bytes at the very most), of smallest id hash. For scoring, the
linear model is folded into one number per bucket, 4 * BUCKETS bytes, which is broadcast. All documents are scored over
their whole texts.

Defined cases: null and empty texts, and texts without a word, have no subword and get the score of the bias alone.
Without labelled documents every score is 0.5. Repeated rows get the same score. Empty tables give empty results.
Other columns are kept; one with the name of an output is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.common import free_of

SIZES = (3, 4, 5)
BUCKETS = 1 << 16
DIM = 8
STRIDE = 64
MAX_SAMPLE = 2000  # labelled documents per label
SAMPLE_BYTES = 20_000
EPOCHS = 10
STEPS = 400  # at least, so small samples are seen more often
RATE = 0.5
GAIN = 150  # of the embeddings: each gets only its share of a bag's gradient
BATCH = 32
SEED = 7
THRESHOLD = 0.3
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_PIECE = STRIDE << 14  # bytes of a text looked at together


def _normal(text: bytes | None) -> np.ndarray:
    """Lowered words with one space before, between and after; a word that repeats itself at once counts once."""
    words = text.translate(_LOWER).split() if text else []
    words = [w for w, before in zip(words, [b"", *words], strict=False) if w != before]
    return np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8) if words else np.zeros(0, np.uint8)


def _subwords(b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per size: the bucket at each place, and whether the run there stays within one word and its marks."""
    space = b == 32
    hashed = b.astype(np.uint32)
    crosses = np.zeros(len(b), bool)
    for n in range(2, max(SIZES) + 1):
        count = len(b) - n + 1
        if count <= 0:
            return
        hashed = hashed[:count] * np.uint32(0x01000193) + b[n - 1 :]
        crosses = crosses[:count]
        if n > 2:
            crosses = crosses | space[n - 2 : n - 2 + count]
        if n in SIZES:
            yield ((hashed ^ np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - 16), ~crosses


def window_scores(b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The average value of the subwords that start in each window."""
    sums, counts = [], []
    for at in range(0, len(b), _PIECE):
        part = b[at : at + _PIECE + max(SIZES) - 1]
        size = min(_PIECE, len(b) - at)
        total, count = np.zeros(size, np.float32), np.zeros(size, np.int32)
        for bucket, valid in _subwords(part):
            m = min(size, len(bucket))
            total[:m] += values[bucket[:m]] * valid[:m]
            count[:m] += valid[:m]
        steps = np.arange(0, size, STRIDE)
        sums.append(np.add.reduceat(total, steps))
        counts.append(np.add.reduceat(count, steps))
    if not sums:
        return np.zeros(0)
    total, count = np.concatenate(sums).astype(np.float64), np.concatenate(counts)
    if len(total) > 1:
        total, count = total[:-1] + total[1:], count[:-1] + count[1:]
    return total / np.maximum(count, 1)


@dataclass(frozen=True)
class Model:
    values: np.ndarray  # of each bucket: embedding times the difference of the two classes' weights
    bias: float

    def score(self, text: bytes | None) -> float:
        found = window_scores(_normal(text), self.values)
        logit = self.bias + (float(found.max()) if len(found) else 0.0)
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Joint training of embeddings and softmax by gradient descent: windows at random at first, then the worst ones."""
    if not len(texts):
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
    weight = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    normal = [_normal(t) for t in texts]
    epochs = max(epochs, -(-STEPS * 64 // len(texts)))
    for epoch in range(epochs):
        values = emb @ (weight[:, 1] - weight[:, 0])
        rate = RATE * (1 - 0.8 * epoch / epochs)
        bags = []
        for k, b in enumerate(normal):
            n = max(1, -(-len(b) // STRIDE) - 1)
            # At first every window is as good as another. All windows of a clean text are clean: one more at random.
            windows = set(rng.integers(n, size=2).tolist() if 2 * epoch < epochs else rng.integers(n, size=1 - labels[k]).tolist())
            if 2 * epoch >= epochs:
                found = window_scores(b, values)
                windows |= {int(found.argmax())} if len(found) else set()
            for at in sorted(windows):
                part = b[at * STRIDE : (at + 2) * STRIDE + max(SIZES) - 1]
                ids = [bucket[: 2 * STRIDE][valid[: 2 * STRIDE]] for bucket, valid in _subwords(part)]
                if ids and sum(map(len, ids)):
                    bags.append((k, np.concatenate(ids)))
        # Both labels count alike, however many texts each has.
        counts = np.bincount(labels[[k for k, _ in bags]], minlength=2) if bags else np.ones(2)
        even = len(bags) / np.maximum(2 * counts, 1)
        order = rng.permutation(len(bags))
        for start in range(0, len(order), BATCH):
            batch = [bags[i] for i in order[start : start + BATCH]]
            ids = np.concatenate([x for _, x in batch])
            sizes = np.array([len(x) for _, x in batch])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            mean = np.add.reduceat(emb[ids], starts, axis=0) / sizes[:, None]
            logits = mean @ weight + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            y = labels[[k for k, _ in batch]]
            p[np.arange(len(batch)), y] -= 1
            p *= even[y][:, None] / len(batch)
            spread = np.repeat((p @ weight.T) / sizes[:, None], sizes, axis=0)
            seen, place = np.unique(ids, return_inverse=True)
            move = np.stack([np.bincount(place, spread[:, d], len(seen)) for d in range(DIM)], axis=1)
            emb[seen] -= (rate * GAIN * move).astype(np.float32)
            weight -= (rate * (mean.T @ p)).astype(np.float32)
            bias -= (rate * p.sum(axis=0)).astype(np.float32)
    return Model((emb @ (weight[:, 1] - weight[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, allowed: Column, label: str, doc_id: str = "doc_id", text: str = "text", bound: int = MAX_SAMPLE) -> Model:
    """A model from those labelled documents whose id is ``allowed``; see the module's text for the bound."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("id"))
        .agg(F.max(label).cast("int").alias("label"))
        .where(allowed)
    )
    sizes = docs.select(F.col(doc_id).alias("id"), F.octet_length(text).alias("size")).where(F.col("size") <= SAMPLE_BYTES).select("id").distinct()
    fitting = known.join(sizes, "id", "left_semi").withColumn("order", F.xxhash64("id"))
    chosen = [r for y in (0, 1) for r in fitting.where(F.col("label") == y).orderBy("order", "id").limit(bound).collect()]
    if not chosen:
        return fit([], np.zeros(0, int))
    picked = F.broadcast(docs.sparkSession.createDataFrame(chosen, fitting.schema))
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES)
    rows = own.join(picked, "id").groupBy("order", "id").agg(F.min("text").alias("text"), F.min("label").alias("label")).orderBy("order", "id")
    found = rows.select("text", "label").toArrow()
    return fit(found["text"].cast(pa.binary()).to_pylist(), found["label"].to_numpy())


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is toxic."""
    docs = free_of(docs, out)
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [held.value.score(t) for t in batch.column(at).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, schema)

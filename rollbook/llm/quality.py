"""Quality classifier: votes of nearest labelled neighbours among latent-semantic vectors.

A text's terms are its byte trigrams (hashed, so whole texts of any language cost one pass of numpy) and some traits of
shape: how often words and lines repeat, how long words are, and the share of capitals, digits and signs. Weighted by
inverse document frequency and scaled to length 1 they are projected to ``RANK`` latent dimensions, from the singular
vectors of the labelled texts. Every document is compared, by exact cosine products in blocks, with all labelled
vectors; the ``NEIGHBOURS`` nearest vote with weight similarity ** ``POWER``.

The model is fitted on at most ``MAX_SAMPLE`` labelled documents per label, those of smallest id hash, by one task; it is
broadcast, and its size is fixed by that bound: 2 * MAX_SAMPLE * RANK * 4 bytes for the neighbours, TERMS * RANK * 4 for the
projection. All documents are scored, over their whole texts.

Defined cases: null and empty texts have one shared vector (of the shape traits) and get a score like any other. Without any
labelled document every score is 0.5; with one label only, that label. Repeated rows get the same score. Empty tables
give empty results. Ties among neighbours go to the earlier in the sample's fixed order. Other columns are kept; one
with the name of an output is replaced by it.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.common import free_of

HASHED = 2048  # terms of hashed byte trigrams
TRAITS = 6
STEPS = 16  # each trait is one of so many terms
TERMS = HASHED + TRAITS * STEPS
RANK = 64
NEIGHBOURS = 15
POWER = 4
MAX_SAMPLE = 3000  # labelled documents per label
THRESHOLD = 0.3
_TRAIT_WEIGHT = 0.25  # length of one trait's term, against 1 of all trigrams together
_BLOCK = 512
_PIECE = 1 << 20  # bytes hashed at once

_KIND = np.zeros(256, np.int8)  # 1 capital, 2 digit, 3 sign
_KIND[0x41:0x5B] = 1
_KIND[0x30:0x3A] = 2
for _low, _high in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
    _KIND[_low:_high] = 3


def term_counts(text: bytes | None) -> np.ndarray:
    """Damped counts of the hashed trigrams, and the term of each trait."""
    text = text or b""
    out = np.zeros(TERMS, np.float32)
    raw = np.frombuffer(text, np.uint8)
    counts = np.zeros(HASHED, np.int64)
    kinds = np.zeros(4, np.int64)
    for at in range(0, len(raw), _PIECE):
        part = raw[at : at + _PIECE + 2].astype(np.uint32)
        kinds += np.bincount(_KIND[raw[at : at + _PIECE]], minlength=4)
        if len(part) > 2:
            hashed = (part[:-2] * np.uint32(0x10001) + part[1:-1] * np.uint32(0x101) + part[2:]) * np.uint32(0x9E3779B1)
            counts += np.bincount(hashed >> np.uint32(21), minlength=HASHED)
    np.log1p(counts, out=out[:HASHED], casting="unsafe")
    words = text.split()
    lines = [line for line in text.split(b"\n") if line]
    size = max(1, len(raw))
    pairs = Counter(zip(words, words[1:], strict=False))
    repeated = sum(n - 1 for n in pairs.values()) / max(1, len(words) - 1)
    same_lines = 1 - len(set(lines)) / len(lines) if lines else 0.0
    length = len(raw) / max(1, len(words))
    traits = (repeated, same_lines, min(1.0, length / 32), kinds[1] / size, kinds[2] / size * 2, min(1.0, kinds[3] / size * 4))
    for k, value in enumerate(traits):
        out[HASHED + k * STEPS + min(STEPS - 1, int(float(value) * STEPS))] = 1
    return out


def _weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Trigrams weighted and scaled to length 1, then the traits."""
    x = counts.astype(np.float32) * weights
    x[:, :HASHED] /= np.maximum(np.linalg.norm(x[:, :HASHED], axis=1, keepdims=True), 1e-9)
    x[:, HASHED:] *= _TRAIT_WEIGHT
    return x


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of the terms
    projection: np.ndarray  # terms x rank
    vectors: np.ndarray  # labelled x rank, each of length 1
    labels: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        y = _weighted(counts, self.weights) @ self.projection
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        near = np.maximum(self.project(counts) @ self.vectors.T, 0)
        k = min(NEIGHBOURS, len(self.labels))
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.take_along_axis(near, top, axis=1).astype(np.float64) ** POWER + 1e-9
        return (weight * self.labels[top]).sum(axis=1) / weight.sum(axis=1)


def fit(counts: np.ndarray, labels: np.ndarray, rank: int = RANK) -> Model:
    """Inverse document frequencies, the leading singular vectors and the labelled vectors, in blocks of rows."""
    n = len(counts)
    blocks = [slice(k, k + _BLOCK) for k in range(0, n, _BLOCK)]
    weights = np.ones(TERMS, np.float32)
    seen = sum(((counts[k, :HASHED] > 0).sum(axis=0) for k in blocks), np.zeros(HASHED))
    weights[:HASHED] = np.log((1 + n) / (1 + seen)) + 1
    if n == 0:
        return Model(weights, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    products = np.zeros((TERMS, TERMS), np.float32)
    for k in blocks:
        x = _weighted(counts[k], weights)
        products += x.T @ x
    values, vectors = np.linalg.eigh(products)
    projection = np.ascontiguousarray(vectors[:, np.argsort(-values)[:rank]], np.float32)
    model = Model(weights, projection, np.zeros((0, rank), np.float32), np.zeros(0))
    return Model(weights, projection, np.concatenate([model.project(counts[k]) for k in blocks]), labels.astype(np.float64))


def train(docs: DataFrame, labels: DataFrame, allowed: Column, label: str, doc_id: str = "doc_id", text: str = "text", bound: int = MAX_SAMPLE) -> Model:
    """A model from those labelled documents whose id is ``allowed``; see the module's text for the bound."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("id"))
        .agg(F.max(label).cast("int").alias("label"))
        .where(allowed)
        .withColumn("order", F.xxhash64("id"))
    )
    spark = docs.sparkSession
    chosen = [r for y in (0, 1) for r in known.where(F.col("label") == y).orderBy("order", "id").limit(bound).collect()]
    if not chosen:
        return fit(np.zeros((0, TERMS), np.float32), np.zeros(0))
    picked = F.broadcast(spark.createDataFrame(chosen, known.schema))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(picked, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [term_counts(t).astype(np.float16).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("order"), batch.column("label"), pa.array(held, pa.binary())], names=["order", "label", "counts"])

    one = texts.mapInArrow(run, "order bigint, label int, counts binary").groupBy("order").agg(F.min_by("label", "counts").alias("label"), F.min("counts").alias("counts"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [np.zeros((0, TERMS), np.float16)], [np.zeros(0, np.int64)]
        for batch in batches:
            rows += [np.frombuffer(held.as_buffer(), np.float16)[None, :] for held in batch.column("counts")]
            labels.append(batch.column("label").to_numpy(zero_copy_only=False))
        model = fit(np.concatenate(rows), np.concatenate(labels))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # The sample is bounded, and one task learns from it: the driver only gets the model.
    found = one.repartition(1).sortWithinPartitions("order").mapInArrow(learn, "model binary").first()
    return pickle.loads(found["model"]) if found else fit(np.zeros((0, TERMS), np.float16), np.zeros(0))


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 of every whole text."""
    docs = free_of(docs, out)
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            scores = [
                held.value.score(np.stack([term_counts(t) for t in texts[k : k + _BLOCK].to_pylist()]))
                for k in range(0, len(texts), _BLOCK)
            ]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.clip(scores, 0, 1), pa.float64())], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, schema)

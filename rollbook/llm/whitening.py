"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors become whole numbers x = floor(SCALE * entry) + SHIFT, whose count and sums per dimension are exact. The leading
eigenvectors of their covariance V are found without ever forming V: a pass over the stored vectors gives V Q for a block
Q of a few columns, as the sum of C' (C Q) over the tasks' centred rows C. Each round filters the block by a Chebyshev
polynomial of V (one pass a degree, by the three-term recurrence), which damps the unwanted spectrum, up to the block's
smallest Ritz value, and lets the wanted part grow; then come QR and Rayleigh-Ritz (one more pass). Where the spectrum
begins is estimated by ``BOUND_STEPS`` Lanczos passes; a poor estimate costs rounds, not accuracy. The degree is
chosen so that the block stays well conditioned. Rounds go on until every wanted pair's residual |V q - e q| is within
``RESIDUAL`` of the largest eigenvalue; if ``ROUNDS`` are not enough, the operator raises and gives no result.

Tasks send their sums to ``MERGERS`` tasks, so the driver gets that many blocks of (dimensions x columns) per pass, however
many tasks there are. Vectors are held as a narrow table in the shared folder; a lost task only repeats its own sums.

Defined cases: vectors that are null, empty or hold null or non-finite entries are left out; so are entries beyond
+-``LARGEST``, which have no exact whole number here, and vectors of another length than most (of equally frequent lengths
the greatest counts). Ids may be null or repeated: each row is a vector of its own. Components whose eigenvalue is
within ``RANK`` of the largest of zero cannot be whitened and give no rows, so equal vectors, or one alone, give none, and
neither does an empty table. ``deviation`` is null where it exceeds 64 bits. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import discard, staged

SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**40
COMPONENTS = 8
SPARE = 24  # columns of the block beyond the wanted ones: the wider, the further the damped spectrum lies below
DEGREE = 16
BOUND_STEPS = 6
GROWTH = 1e9  # how much more a filter may magnify the first vector than the last
RESIDUAL = 1e-12
RANK = 1e-12
ROUNDS = 200
MERGERS = 8

_OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whole_numbers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x): the vectors that can be used, as whole numbers, all of one length."""
    entries = F.col(embedding).cast("array<double>")
    usable = F.forall(entries, lambda c: F.coalesce((c >= -LARGEST) & (c <= LARGEST), F.lit(False)))
    whole = F.transform(entries, lambda c: F.floor(c * SCALE) + SHIFT).cast("array<bigint>")
    held = staged(vectors.where((F.size(entries) > 0) & usable).select(F.col(vec_id).alias("vec_id"), whole.alias("x")), "whole")
    lengths = held.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"))
    most = lengths.agg(F.max(F.struct("n", "length")).alias("most")).first()["most"]
    return held if most is None else _kept(held, held.where(F.size("x") == most["length"]))


def _kept(held: DataFrame, narrowed: DataFrame) -> DataFrame:
    """``narrowed`` with the files of ``held`` that it still reads."""
    narrowed.staged_at = held.staged_at
    return narrowed


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    x = batch.column(batch.schema.get_field_index("x"))
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), dims)


def _summed(vectors: DataFrame, size: int, of: Callable[[np.ndarray], np.ndarray], dims: int, kind: type = np.float64) -> np.ndarray:
    """The sum over all rows of ``of`` (rows of a batch -> ``size`` numbers): per task, then by a few tasks, then here."""
    kept = np.dtype(kind).newbyteorder("<")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, kind)
        for batch in batches:
            if batch.num_rows:
                total += of(_matrix(batch, dims))
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(kept).tobytes()], pa.binary())], names=["part"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, kind)
        for batch in batches:
            for part in batch.column("part"):
                total += np.frombuffer(part.as_py(), kept)
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(kept).tobytes()], pa.binary())], names=["part"])

    parts = vectors.select("x").mapInArrow(partial, "part binary").repartition(MERGERS).mapInArrow(merged, "part binary")
    total = np.zeros(size, kind)
    for row in parts.collect():  # one row per merging task
        total += np.frombuffer(row["part"], kept)
    return total


def _spectrum_begins(apply: Callable[[np.ndarray], np.ndarray], dims: int, steps: int) -> float:
    """An estimate, from below, of the smallest eigenvalue: the smallest Ritz value of a short Lanczos run less its residual."""
    start = np.random.default_rng(7).standard_normal(dims)
    held, diagonal, beside = [start / np.linalg.norm(start)], [], []
    for _ in range(min(steps, dims)):
        image = apply(held[-1][:, None])[:, 0]
        diagonal.append(held[-1] @ image)
        basis = np.array(held)
        for _ in range(2):  # twice is enough
            image = image - basis.T @ (basis @ image)
        beside.append(np.linalg.norm(image))
        if beside[-1] <= RANK * abs(diagonal[-1]):
            break
        held.append(image / beside[-1])
    theta, turn = np.linalg.eigh(np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1))
    return max(0.0, theta[0] - beside[-1] * abs(turn[-1, 0]))


def leading(apply: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, spare: int = SPARE) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues (falling), their vectors as columns, and the largest residual, of a symmetric
    positive operator known only by ``apply(Q)``."""
    wanted = min(wanted, dims)
    width = min(dims, wanted + spare)
    low = _spectrum_begins(apply, dims, BOUND_STEPS) if width < dims else 0.0
    block = np.linalg.qr(np.random.default_rng(42).standard_normal((dims, width)))[0]
    image = apply(block)
    for _ in range(ROUNDS):
        small = block.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        residual = np.linalg.norm(image - block * theta, axis=0)[:wanted].max()
        if residual <= RESIDUAL * max(theta[0], 0) or theta[0] <= 0:
            return theta[:wanted], block[:, :wanted], residual
        high = max(theta[-1], low + RANK * theta[0])
        centre, half = (high + low) / 2, (high - low) / 2
        # The highest degree at which the first vector grows at most GROWTH times as much as the last.
        growth = np.arccosh(max((theta[0] - centre) / half, 1.0))
        degree = DEGREE if growth == 0 else int(np.clip(np.log(2 * GROWTH) / growth, 1, DEGREE))
        before, now = block, (image - centre * block) / half
        for _ in range(degree - 1):
            before, now = now, 2 * (apply(now) - centre * now) / half - before
        # QR loses columns of very different length: they are scaled first.
        block = np.linalg.qr(now / np.linalg.norm(now, axis=0))[0]
        image = apply(block)
    raise ArithmeticError(f"eigenvectors not certified after {ROUNDS} rounds: residual {residual:.3g}")


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums of squares; in whole numbers of any size where 64 bits might not do."""
    far = n * np.abs(x.astype(np.float64)).max(initial=0) + np.abs(sums.astype(np.float64)).max(initial=0)
    if far * far * x.shape[1] < 2.0**62:
        off = n * x - sums
        return (off * off).sum(axis=1).tolist()
    total = [int(sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True))) for row in x]
    return [t if t < 1 << 63 else None for t in total]


def whitened(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: see the query's contract for the columns."""
    spark = vectors.sparkSession
    held = whole_numbers(vectors, vec_id, embedding)
    first = held.select("x").first()
    if first is None:
        discard(held)
        return spark.createDataFrame([], _OUT)
    dims = len(first["x"])
    sums = _summed(held, dims + 1, lambda x: np.concatenate(([len(x)], x.sum(axis=0))), dims, np.int64)
    n, sums = int(sums[0]), sums[1:]
    mean = sums // n, (sums % n) / n  # whole and broken part: centring loses no digits

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - mean[0]) - mean[1]

    def apply(block: np.ndarray) -> np.ndarray:
        def product(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return (c.T @ (c @ block)).ravel()

        return _summed(held, block.size, product, dims).reshape(block.shape) / n

    trace = _summed(held, 1, lambda x: np.array([np.square(centred(x)).sum()]), dims)[0] / n
    values, axes, _ = leading(apply, dims, components)
    kept = values > RANK * values[0] if values[0] > 0 else np.zeros(len(values), bool)
    values, axes = values[kept], axes[:, kept]
    k = len(values)
    if not k:
        discard(held)
        return spark.createDataFrame([], _OUT)
    whiten = axes / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ whiten
        return np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))

    found = _summed(held, k + k * k, moments, dims)
    middle = found[:k] / n
    error = float(np.abs(found[k:].reshape(k, k) / n - np.outer(middle, middle) - np.eye(k)).max())
    shares = values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = _matrix(batch, dims)
            out = centred(x) @ whiten
            own = np.repeat(np.arange(rows), k)
            columns = [
                batch.column(0).take(pa.array(own)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, n, np.int64)),
                pa.array(_deviation(x, n, sums), pa.int64()).take(pa.array(own)),
                pa.array(out.ravel()),
                pa.array(np.tile(shares, rows)),
                pa.array(np.full(rows * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _OUT.split(", ")])

    return held.select("vec_id", "x").mapInArrow(run, _OUT)

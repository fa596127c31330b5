"""Packing into length buckets whose boundaries minimise padding.

Lengths are counted into one global histogram. Its cells are single lengths up to ``FINE`` and ``FINE / 2`` steps per
doubling beyond, so it has a bounded number of cells (about 2,700 for lengths up to 2^40); a cell knows its rows, their
total length and its longest. Dynamic programming over the cells finds those ``buckets`` groups of consecutive cells
that need the least padding, where every row of a bucket is padded to the bucket's longest. Within a bucket rows are
numbered, without gaps and without sorting a bucket in one task, and batches take as many rows as the token budget
allows at the bucket's length.

Defined cases: null and empty texts have length 0. A row longer than the budget is a batch of its own, whole. Ids
are not looked at: rows of null or repeated ids are packed each. Of several best boundaries the first in order is taken. Empty tables give empty results. Other
columns are kept; one with the name of an output is replaced by it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import constant_array, free_of, numbered, slices_for, staged

FINE = 128
BUCKETS = 16
BUDGET = 65_536  # tokens of a batch, padding included
# A token is a word or a sign.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("bigint")


def cell_of(length: Column, fine: int = FINE) -> Column:
    """The histogram's cell: ordered as the lengths are."""
    bits = F.length(F.bin(F.greatest(length, F.lit(1)))) - 1  # whole logarithm
    low = F.lit(fine.bit_length() - 1)
    step = F.call_function("shiftright", length, F.greatest(bits - low + 1, F.lit(0)).cast("int"))
    return F.when(length < fine, length).otherwise(fine + (bits - low) * (fine // 2) + step - fine // 2).cast("bigint")


def best_boundaries(longest: list[int], rows: list[int], total: list[int], buckets: int) -> list[int]:
    """The cells that end a bucket, by dynamic programming; the padding of all cells together is least."""
    n = len(longest)
    if n == 0:
        return []
    top = np.array(longest, np.float64)
    row_sum = np.concatenate(([0], np.cumsum(np.array(rows, np.float64))))
    size_sum = np.concatenate(([0], np.cumsum(np.array(total, np.float64))))
    buckets = min(buckets, n)
    # least[j]: of the first j cells in k buckets. The cost of cells i..j-1 is top[j-1] * rows - sizes.
    least = np.full(n + 1, np.inf)
    least[0] = 0
    came = np.zeros((buckets + 1, n + 1), np.int64)
    for k in range(1, buckets + 1):
        new = np.full(n + 1, np.inf)
        for j in range(1, n + 1):
            cost = least[:j] + top[j - 1] * (row_sum[j] - row_sum[:j]) - (size_sum[j] - size_sum[:j])
            came[k, j] = int(cost.argmin())
            new[j] = cost[came[k, j]]
        least = new
    ends, j = [], n
    for k in range(buckets, 0, -1):
        ends.append(j - 1)
        j = int(came[k, j])
    return ends[::-1]


def packed(
    docs: DataFrame, length: Column | None = None, text: str = "text", buckets: int = BUCKETS, budget: int = BUDGET
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``bucket`` (0 is the shortest), ``bucket_tokens`` (padded length), ``batch``
    (number within the bucket), ``batch_row`` and ``padding``. ``length`` counts tokens in a way of its own."""
    docs = free_of(docs, "n_tokens", "bucket", "bucket_tokens", "batch", "batch_row", "padding", "__cell", "__row", "__number")
    measured = docs.withColumn("n_tokens", token_count(F.col(text)) if length is None else length.cast("bigint"))
    # A number of its own for each stored row: rows of one id, or of none, are dealt out like all others.
    measured = measured.withColumns({"__cell": cell_of(F.col("n_tokens")), "__row": F.monotonically_increasing_id()})
    measured = staged(measured, "measured")
    cells = (
        measured.groupBy("__cell").agg(F.max("n_tokens").alias("top"), F.count("*").alias("n"), F.sum("n_tokens").alias("sum")).orderBy("__cell").collect()
    )
    ends = best_boundaries([c["top"] for c in cells], [c["n"] for c in cells], [c["sum"] for c in cells], buckets)
    last_cells, tops = [cells[e]["__cell"] for e in ends], [cells[e]["top"] for e in ends]
    bucket = F.size(F.filter(constant_array(last_cells), lambda c: c < F.col("__cell")))
    rows = measured.withColumn("bucket", bucket.cast("int")).withColumn(
        "bucket_tokens", F.element_at(constant_array(tops or [0]), F.col("bucket") + 1)
    )
    capacity = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket_tokens", F.lit(1))), F.lit(1)).cast("bigint")
    done = numbered(rows, ["bucket"], "__row", "__number", slices_for(sum(c["n"] for c in cells)))
    return (
        done.withColumn("batch", F.floor(F.col("__number") / capacity).cast("bigint"))
        .withColumn("batch_row", F.col("__number") % capacity)
        .withColumn("padding", F.col("bucket_tokens") - F.col("n_tokens"))
        .drop("__cell", "__row", "__number")
    )

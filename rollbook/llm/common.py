"""Helpers shared by the operators: tables, word rules, staged results and exact distributed numbering."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.session import remove, scratch_path

# Digits, letters and everything beyond ASCII make up a word (after lower-casing A-Z).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The same rule on UTF-8 bytes: upper-case ASCII is lowered, every other ASCII byte outside words becomes a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_table(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """A few rows from the driver as a constant inside the plan: no Python process and no file takes part."""
    every = F.from_json(F.lit(json.dumps(list(rows))), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(every))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends in files that outlive executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Removes the files of staged frames that nothing reads any more; others are left alone."""
    for df in frames:
        if path := df.__dict__.get("staged_at"):
            remove(df.sparkSession, path.rsplit("/", 1)[0])


def lower_az(text: Column) -> Column:
    """``text`` with A-Z lowered and nothing else; texts of ASCII alone take the quick way."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, capitals, capitals.lower()))


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8; null and empty texts have none."""
    return text.translate(WORD_BYTES).split() if text else []


def free_of(df: DataFrame, *added: str) -> DataFrame:
    """``df`` without columns, in whatever case, named like one to be added: the new one takes its place."""
    names = {c.lower() for c in added}
    return df.drop(*[df[f"`{c}`"] for c in df.columns if c.lower() in names])


def numbered(df: DataFrame, group: Sequence[str], key: str, out: str, slices: int) -> DataFrame:
    """``df`` with a gapless number from 0 within each group, in the order of a hash of ``key``, then of ``key``.

    A group is cut into ``slices`` by that hash. Slices are counted first, then numbered side by side from the
    running total of the counts, so no task ever sorts a whole group. Rows of equal key get different numbers.
    """
    cut = "__slice"
    rows = df.withColumn(cut, F.pmod(F.xxhash64(F.lit("slice"), key), F.lit(slices)).cast("int"))
    keys = [*group, cut]
    ahead = Window.partitionBy(*group).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    starts = counts.select(*keys, F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*keys).orderBy(F.xxhash64(F.lit("order"), key), key)
    return (
        rows.withColumn("__at", F.row_number().over(inside))
        .join(starts, keys)
        .withColumn(out, F.col("__start") + F.col("__at") - 1)
        .drop(cut, "__at", "__start")
    )


def slices_for(rows: int, each: int = 100_000) -> int:
    """So many slices that each has about ``each`` rows."""
    return max(1, -(-rows // each))


def constant_array(values: Sequence, kind: str = "bigint") -> Column:
    """A constant array column; the optimiser folds it into one literal, however many values it has."""
    if not values:
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")

"""Checks made before anything is stored: keys, text lengths, parents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.operators.flatten import STRICT_DATES
from rollbook.schemas.tables import TABLES


def key_violations(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. Counted map-side first."""
    return rows.groupBy(*key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def request_report(rows: DataFrame, table: str, day: str | None = None) -> DataFrame:
    """One row per request: how many rows it brought for ``table``, and whether they break a rule.

    One pass over the rows and one shuffle, on the table's key: repeated keys, texts that are too long, missing
    dates and rows of another day than the one asked for are all found in it. ``day`` names the slice column that
    must hold the day asked for.
    """
    spec = TABLES[table]
    never = F.lit(False)
    strict = STRICT_DATES.get(table)
    per_key = rows.groupBy("request_id", *spec.key).agg(
        F.count("*").alias("rows"),
        F.bool_or(too_long(table)).alias("long"),
        F.bool_or(F.col(strict).isNull() if strict else never).alias("undated"),
        F.bool_or(~F.col(day).eqNullSafe(F.col("AskedDay")) if day else never).alias("stray"),
    )
    repeated = F.bool_or(F.col("rows") > 1) if spec.key else F.lit(False)
    return per_key.groupBy("request_id").agg(
        F.sum("rows").alias("rows"), F.bool_or("long").alias("long"), F.bool_or("undated").alias("undated"),
        F.bool_or("stray").alias("stray"), repeated.alias("repeated"),
    )


def shared_key_failures(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Requests that bring a key which an earlier request of the same run brings too. The first one keeps it."""
    per_request = rows.groupBy(*key, "request_id").agg(F.count("*").alias("rows"))
    shared = (
        per_request.groupBy(*key)
        .agg(F.min("request_id").alias("first"), F.count("*").alias("requests"))
        .filter(F.col("requests") > 1)
        .drop("requests")
    )
    same = reduce(Column.__and__, [per_request[c].eqNullSafe(shared[c]) for c in key])
    later = per_request.join(shared, same).filter(F.col("request_id") != F.col("first"))
    return later.select("request_id").distinct()


def stored_key_failures(rows: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """Requests that bring a key which a row outside their slices already holds."""
    taken = stored.select(*key).distinct()
    return rows.join(taken, list(key), "left_semi").select("request_id").distinct()


def too_long(table: str) -> Column:
    """True for a row with a text longer than its column accepts."""
    tests = [F.coalesce(F.length(column) > limit, F.lit(False)) for column, limit in TABLES[table].limits.items()]
    return reduce(Column.__or__, tests, F.lit(False))


def length_violations(rows: DataFrame, table: str) -> DataFrame:
    """One row per limited column of ``table``: the limit and how many rows exceed it. One pass over the rows."""
    limits = {c: n for c, n in TABLES[table].limits.items() if c in rows.columns}
    counts = rows.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    return counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("max_length"), F.col(c).alias("rows"))
                    for c, n in limits.items()
                ]
            )
        ).alias("v")
    ).select("v.column_name", "v.max_length", "v.rows")


def orphan_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """For every foreign key between the given tables: how many child rows have no parent.

    The keys of a parent table and all columns that refer to them are counted together, map-side first: one shuffle a
    parent table, which holds one row per key and task however often a key occurs, and nothing is sorted or joined. A
    NULL key refers to nothing and is no orphan.
    """
    edges = [(name, p) for name in tables for p in TABLES[name].parents if p.table in tables]
    counts = [
        _orphans(tables, parent, [(k, child, p.column) for k, (child, p) in enumerate(edges) if p.table == parent])
        for parent in dict.fromkeys(p.table for _, p in edges)
    ]
    every = F.array(
        *[
            F.struct(F.lit(k).alias("edge"), F.lit(c).alias("child"), F.lit(p.column).alias("child_column"), F.lit(p.table).alias("parent"))
            for k, (c, p) in enumerate(edges)
        ]
    )
    listed = next(iter(tables.values())).sparkSession.range(1).select(F.inline(every))
    return listed.join(reduce(DataFrame.unionByName, counts), "edge", "left").select(
        "child", "child_column", "parent", F.coalesce("orphans", F.lit(0)).cast("bigint").alias("orphans")
    )


def _orphans(tables: Mapping[str, DataFrame], parent: str, edges: Sequence[tuple[int, str, str]]) -> DataFrame:
    """One row per foreign key (its number, child table and column) to ``parent``: how many of its rows have no parent.

    NULL keys are left out of the sums and not of the rows: a filter would sink into tables that are worked out, and
    those that are read for several keys would then no longer share one shuffle.
    """
    sides = [(None, parent, TABLES[parent].key[0]), *edges]
    # Ids of one type are compared as they are, others by their text.
    mixed = len({tables[name].schema[column].dataType for _, name, column in sides}) > 1
    keys = reduce(DataFrame.unionByName, [
        tables[name].select(
            (F.col(column).cast("string") if mixed else F.col(column)).alias("key"), F.lit(k).cast("int").alias("edge"),
        )
        for k, name, column in sides
    ])
    per_key = keys.groupBy("key").agg(
        F.bool_or(F.col("edge").isNull()).alias("known"), *[F.count_if(F.col("edge") == k).alias(f"edge_{k}") for k, _, _ in edges]
    )
    orphan = F.col("key").isNotNull() & ~F.col("known")
    sums = per_key.agg(*[F.sum(F.when(orphan, F.col(f"edge_{k}"))).alias(f"edge_{k}") for k, _, _ in edges])
    return sums.select(
        F.inline(F.array(*[F.struct(F.lit(k).alias("edge"), F.col(f"edge_{k}").alias("orphans")) for k, _, _ in edges]))
    )

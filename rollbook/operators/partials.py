"""Attribute look-ups from partial aggregates that merge.

A partial row stands for all values of one student under one attribute type and academic year (NULL is a year of its
own): the greatest and the smallest dated value, and the greatest undated value with the number of undated ones. Any
set of partial rows gives the look-ups of the values behind them, so slices can be reduced on their own, at different
times, and are taken out again by leaving their rows out. Types are looked up only when the partial rows are merged: a
type that is renamed or goes needs no new ones.

Defined cases: repeated values count each; a NULL value is a value; values whose type is unknown are in no look-up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.operators.attributes import OWNER, pick_sole

OF = ("AttributeTypeId", "StudentId", "AcademicYear")


def partial_values(values: DataFrame, slice: Sequence[str] = ()) -> DataFrame:
    """One row per type, student, year and slice. Combines map-side, so no student's values are gathered."""
    undated = F.col("Date").isNull()
    return values.groupBy(*OF, *slice).agg(
        F.max(F.struct("Date", "Value")).alias("Last"),
        F.min(F.struct("Date", "Value")).alias("First"),
        F.max(F.when(undated, F.col("Value"))).alias("Undated"),
        F.count_if(undated).alias("UndatedRows"),
    )


def named_partials(types: DataFrame, partials: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Partial rows with the academy, year and name of their type. ``names`` restricts the types before the join."""
    kept = types if names is None else types.filter(F.col("AttributeName").isin(*names))
    kept = kept.select("AttributeTypeId", "Academy", "DataSet", "AttributeName")
    return partials.select(*OF, "Last", "First", "Undated", "UndatedRows").join(kept, "AttributeTypeId")


def latest_value(named: DataFrame) -> DataFrame:
    """As ``attributes.latest_value`` of the values behind the rows."""
    return _pick(named, F.max(F.struct("Last.Date", "AcademicYear", "Last.Value")))


def earliest_value(named: DataFrame) -> DataFrame:
    """As ``attributes.earliest_value`` of the values behind the rows."""
    return _pick(named, F.min(F.struct("First.Date", "AcademicYear", "First.Value")))


def value_for_year(named: DataFrame, academic_year: str, strict: bool = False) -> DataFrame:
    """As ``attributes.value_for_year`` of the values behind the rows."""
    return pick_sole(_undated(named.filter(F.col("AcademicYear") == academic_year), OWNER), strict)


def value_without_timestamp(named: DataFrame, strict: bool = False) -> DataFrame:
    """As ``attributes.value_without_timestamp`` of the values behind the rows."""
    return pick_sole(_undated(named.filter(F.col("AcademicYear").isNull()), OWNER), strict)


def values_by_year(named: DataFrame) -> DataFrame:
    """As ``attributes.values_by_year`` of the values behind the rows."""
    return _undated(named.filter(F.col("AcademicYear").isNotNull()), (*OWNER, "AcademicYear"))


def _pick(named: DataFrame, pick) -> DataFrame:
    return named.groupBy(*OWNER).agg(pick.alias("__row")).select(*OWNER, F.col("__row.Value").alias("Value"))


def _undated(named: DataFrame, by: Sequence[str]) -> DataFrame:
    rows = named.filter(F.col("UndatedRows") > 0)
    return rows.groupBy(*by).agg(F.max("Undated").alias("Value"), F.sum("UndatedRows").alias("Matches"))

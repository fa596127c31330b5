"""Attribute look-ups and the attribute pivot over the (type, value) tables.

The look-ups answer for all students and all the names asked for in one pass: the values are reduced to one row
per student and name by an aggregate that combines map-side, so no student's values need to fit in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.columns import yes_no

OWNER = ("StudentId", "Academy", "DataSet", "AttributeName")


def named_values(types: DataFrame, values: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Values with the academy, year and name of their type. ``names`` restricts the types before the join."""
    kept = types if names is None else types.filter(F.col("AttributeName").isin(*names))
    kept = kept.select("AttributeTypeId", "Academy", "DataSet", "AttributeName")
    owned = values.select("AttributeTypeId", "StudentId", "Value", "AcademicYear", "Date")
    return owned.join(kept, "AttributeTypeId")


def value_for_year(named: DataFrame, academic_year: str, strict: bool = False) -> DataFrame:
    """The undated value recorded for one academic year."""
    return _sole(named.filter((F.col("AcademicYear") == academic_year) & F.col("Date").isNull()), strict)


def values_by_year(named: DataFrame) -> DataFrame:
    """The undated values of all academic years, the year as a column: what ``value_for_year`` finds for each."""
    undated = named.filter(F.col("AcademicYear").isNotNull() & F.col("Date").isNull())
    return undated.groupBy(*OWNER, "AcademicYear").agg(F.max("Value").alias("Value"), F.count("*").alias("Matches"))


def value_without_timestamp(named: DataFrame, strict: bool = False) -> DataFrame:
    """The value recorded with neither a date nor an academic year."""
    return _sole(named.filter(F.col("Date").isNull() & F.col("AcademicYear").isNull()), strict)


def latest_value(named: DataFrame) -> DataFrame:
    """The value with the greatest date, then academic year; undated values come last. Ties: greatest value."""
    return _pick(named, F.max(_dated()))


def earliest_value(named: DataFrame) -> DataFrame:
    """The value with the smallest date, then academic year; an undated value wins. Ties: smallest value."""
    return _pick(named, F.min(_dated()))


def lookup_conflicts(found: DataFrame) -> DataFrame:
    """Owners for whom a single-value look-up met several values (two groups may share an attribute name)."""
    return found.filter(F.col("Matches") > 1)


def attach(students: DataFrame, found: DataFrame, names: Sequence[str], prefix: str = "") -> DataFrame:
    """One column per name on the students; NULL where nothing was found."""
    wide = found.groupBy("StudentId", "Academy", "DataSet").agg(
        *[F.max(F.when(F.col("AttributeName") == n, F.col("Value"))).alias(prefix + n) for n in names]
    )
    return students.join(wide, ["StudentId", "Academy", "DataSet"], "left")


@dataclass(frozen=True)
class PivotColumn:
    """One column of the context pivot: the attribute it shows and what stands for "no such attribute"."""

    name: str
    attribute: str
    default: str = ""
    as_yes_no: bool = True

    def pick(self) -> Column:
        value = yes_no("Value") if self.as_yes_no else F.col("Value")
        return F.max(F.when(F.col("AttributeName") == self.attribute, value).otherwise(F.lit(self.default)))


# The columns of the student context report.
CONTEXT_COLUMNS = (
    PivotColumn("OnRoll", "On roll"),
    PivotColumn("Enrolled", "Enrollment status", as_yes_no=False),
    PivotColumn("FSM_Now", "FSM"),
    PivotColumn("FSM6", "FSMEver6"),
    PivotColumn("PP", "Pupil Premium Indicator", default="No"),
    PivotColumn("Disadvantaged", "Disadvantaged", default="No"),
    PivotColumn("Bursary", "Bursary"),
    PivotColumn("LookedAfter", "Looked After"),
    PivotColumn("EverInCare", "Ever in Care"),
    PivotColumn("EAL", "EAL"),
    PivotColumn("Ethnicity", "Ethnicity", as_yes_no=False),
    PivotColumn("SENCode", "SEN Code", as_yes_no=False),
)


def pivot_attributes(
    types: DataFrame, values: DataFrame, columns: Sequence[PivotColumn] = CONTEXT_COLUMNS
) -> DataFrame:
    """One row per student that has any value; a column is the greatest of its values and, where the student has
    other values as well, its default."""
    named = values.select("AttributeTypeId", "StudentId", "Value").join(
        types.select("AttributeTypeId", "AttributeName"), "AttributeTypeId", "left"
    )
    return named.groupBy("StudentId").agg(*[c.pick().alias(c.name) for c in columns])


def attach_pivot(
    students: DataFrame, pivot: DataFrame, columns: Sequence[PivotColumn] = CONTEXT_COLUMNS
) -> DataFrame:
    """The pivot on all students; those without any value show the defaults."""
    marked = pivot.select("StudentId", F.lit(True).alias("__has_values"), *[c.name for c in columns])
    joined = students.join(marked, "StudentId", "left")
    shown = {c.name: F.when(F.col("__has_values"), F.col(c.name)).otherwise(F.lit(c.default)) for c in columns}
    return joined.withColumns(shown).drop("__has_values")


def _dated() -> Column:
    return F.struct("Date", "AcademicYear", "Value")


def _pick(named: DataFrame, pick: Column) -> DataFrame:
    return named.groupBy(*OWNER).agg(pick.alias("__row")).select(*OWNER, F.col("__row.Value").alias("Value"))


def _sole(named: DataFrame, strict: bool) -> DataFrame:
    return pick_sole(named.groupBy(*OWNER).agg(F.max("Value").alias("Value"), F.count("*").alias("Matches")), strict)


def pick_sole(found: DataFrame, strict: bool) -> DataFrame:
    """``found`` as it is, or, if ``strict``, failing where an owner has several values."""
    if strict:
        clash = F.raise_error(F.concat(F.lit("several values for "), F.concat_ws(" / ", *OWNER))).cast("string")
        found = found.withColumn("Value", F.when(F.col("Matches") > 1, clash).otherwise(F.col("Value")))
    return found

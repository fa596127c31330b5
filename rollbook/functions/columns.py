"""Keys, dates and text rules as Column functions; all run inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one text date form the source uses, and the default text width of a conversion.
TEXT_DATE = "yyyy-MM-dd'T'HH:mm:ss'Z'"
CONVERT_WIDTH = 30
RECEPTION = "Reception"


def surrogate_key(*ids: Column | str) -> Column:
    """Academy + year + "-" + id [+ "-" + id ...]; a missing id leaves its place empty."""
    parts = [F.coalesce(_col(i).cast("string"), F.lit("")) for i in ids]
    return F.concat(F.col("Academy"), F.col("DataSet"), F.lit("-"), F.concat_ws("-", *parts))


def optional_key(id_: Column | str) -> Column:
    """Like :func:`surrogate_key`, but NULL when the id is NULL."""
    return F.concat(F.col("Academy"), F.col("DataSet"), F.lit("-"), _col(id_).cast("string"))


def text_date(value: Column | str) -> Column:
    """The day of a text date in the source's exact form, NULL for any other text."""
    return F.to_date(F.try_to_timestamp(_col(value), F.lit(TEXT_DATE)))


def text_moment(value: Column | str) -> Column:
    """An ISO date-time as wall-clock time in UTC, NULL when it is not one."""
    return _col(value).try_cast("timestamp_ntz")


def year_group_label(year: Column | str) -> Column:
    """Year 0 is written out, the others are their number as text."""
    year = _col(year)
    return F.when(year == 0, F.lit(RECEPTION)).otherwise(year.cast("string"))


def request_date_label(day: Column | str) -> Column:
    return F.date_format(_col(day), "yyyy-MM-dd")


def number_or_zero(value: Column | str) -> Column:
    return F.coalesce(_col(value), F.lit(0))


def flag_or_false(value: Column | str) -> Column:
    return F.coalesce(_col(value), F.lit(False))


def yes_no(value: Column | str) -> Column:
    """True -> Yes and False -> No, wherever they occur in the text."""
    replaced = F.replace(_col(value), F.lit("True"), F.lit("Yes"))
    return F.replace(replaced, F.lit("False"), F.lit("No"))


def converted_text(value: Column | str, width: int = CONVERT_WIDTH) -> Column:
    return F.substring(_col(value).cast("string"), 1, width)


def same_year(dataset: Column | str, year: int) -> Column:
    """Text year against a number; text that is no number does not match."""
    return _col(dataset).try_cast("int") == F.lit(year)


def grade_text(plain: Column | str, alias: Column | str, prefer_alias: bool = False) -> Column:
    """The grade a report shows.

    The shipped reports compare the alias with NULL by equality, which never holds, so they always show the
    plain grade. ``prefer_alias`` gives what they evidently meant.
    """
    return F.coalesce(_col(alias), _col(plain)) if prefer_alias else _col(plain)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value

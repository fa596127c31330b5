"""How the slices of a table lie in folders: each in one of its own, or, where they are many, many in one.

Up to ``MAX_FOLDERS`` slices are a folder each, so a replacement reads nothing else. A folder and its file cost the same
however few rows they hold, so beyond that slices share folders: by academic year, by month where a slice is a day, and by
one of ``PARTS`` numbers for the rest. The slice columns are then stored like all others, and a replacement writes the
folders anew in which its slices lie. A table that outgrows the first form changes to the second in the commit that does it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.sources.commits import folder_names, leaves

MAX_FOLDERS = 2000
PARTS = 64

_PART, _MONTH, _YEAR = "part", "month", "DataSet"
_DAYS = ("Date", "EventDay")


def shared(spark: SparkSession, path: str) -> bool:
    """Whether the slices below ``path`` share folders, as the folders' names tell."""
    return any(name.startswith(f"{_PART}=") for name in folder_names(spark, path))


def own_folders(spark: SparkSession, path: str, slice: Sequence[str]) -> list[str]:
    """The folders of a table whose slices have one each, relative to it."""
    return [leaf for leaf in leaves(spark, path, len(slice)) if leaf.startswith(f"{slice[0]}=")]


def folder_columns(slice: Sequence[str]) -> list[str]:
    """What names a shared folder."""
    return [_PART, *([_YEAR] if _YEAR in slice else []), *([_MONTH] if _day(slice) else [])]


def placed(rows: DataFrame, slice: Sequence[str]) -> DataFrame:
    """``rows``, which hold the slice columns, with the shared folder of each."""
    day = _day(slice)
    made: dict[str, Column] = {_MONTH: F.date_format(day, "yyyy-MM")} if day else {}
    rest = [F.col(c).cast("string") for c in slice if c not in (day, _YEAR)]
    return rows.withColumns({_PART: (F.crc32(F.concat_ws("|", *rest)) % PARTS).cast("int")} | made)


def stored_schema(schema: T.StructType, slice: Sequence[str]) -> T.StructType:
    """A table's columns and those of its shared folders."""
    more = [T.StructField(_PART, T.IntegerType()), *([T.StructField(_MONTH, T.StringType())] if _day(slice) else [])]
    return T.StructType([*schema.fields, *more])


def in_slices(rows: DataFrame, slices: DataFrame, slice: Sequence[str], how: str) -> DataFrame:
    """The rows that lie in the slices (``left_semi``) or in none of them (``left_anti``). NULL is a value like others."""
    names = {c: f"__{c}" for c in slice}
    asked = slices.select(*[F.col(c).alias(n) for c, n in names.items()])
    return rows.join(asked, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()], how)


def _day(slice: Sequence[str]) -> str | None:
    return next((c for c in slice if c in _DAYS), None)

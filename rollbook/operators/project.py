"""Projection to a declared table: by name, with its types; columns the table lacks are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.schemas.tables import TABLES


def project(df: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    fields = TABLES[table].storage_schema.fields
    return df.select(*keep, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])

"""Stand-in relations stored as a warehouse."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import functions as F

from rollbook.schemas.tables import TABLES
from rollbook.sources.warehouse import Warehouse
from standins.relations import Standins


def store(warehouse: Warehouse, standins: Standins, names: Iterable[str]) -> None:
    """The named relations, every row, in one commit. Columns that a relation lacks are empty."""
    with warehouse.commit() as made:
        for name in names:
            rows = standins[name]
            lacking = {f.name: F.lit(None) for f in TABLES[name].storage_schema if f.name not in rows.columns}
            rows = rows.withColumns(lacking) if lacking else rows
            slices = rows.select(*TABLES[name].slice)
            made.replace_slices(name, rows, slices, empty=slices.where("false"))

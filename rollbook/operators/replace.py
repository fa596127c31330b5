"""Replacing slices of a table, as pure functions of DataFrames.

``existing`` and ``incoming`` are the stored and the new rows. ``slices`` holds one row per slice to replace and
comes from the requests that were made, never from the incoming rows, so a slice that came back empty is
emptied.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.schemas.tables import TABLES, children_of
from rollbook.session import materialize


def replace_slices(existing: DataFrame, incoming: DataFrame, slices: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows outside the slices stay as they are; inside, only the incoming rows remain."""
    kept = existing.join(slices.select(*on).distinct(), list(on), "left_anti")
    return kept.unionByName(incoming.select(*existing.columns))


def replace_events(
    events: DataFrame, involved: DataFrame, new_events: DataFrame, new_involved: DataFrame, days: DataFrame,
    by: str = "day", sent_ids: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Replace the events of the given (Academy, DataSet, Date) rows, and any stored event whose id comes again.

    ``by="day"`` removes every stored event of that day; ``by="exact"`` only those whose time equals the start
    of the day. A stored event whose id was sent goes wherever it is stored; ``sent_ids`` names the ids when some
    sent events are not stored (those without a student list). The students of removed events go with them.
    """
    sent = (new_events if sent_ids is None else sent_ids).select("BehEventId")
    stamp = F.col("EventDate") if by == "exact" else F.to_date("EventDate")
    asked = days.select(
        "Academy", "DataSet", (F.col("Date").cast("timestamp_ntz") if by == "exact" else F.col("Date")).alias("__at")
    ).distinct()
    of_days = events.select("BehEventId", "Academy", "DataSet", stamp.alias("__at"))
    of_days = of_days.join(asked, ["Academy", "DataSet", "__at"], "left_semi").select("BehEventId")
    removed = of_days.unionByName(sent).distinct()
    kept = events.join(removed, "BehEventId", "left_anti").select(*events.columns)
    kept_involved = involved.join(removed, "BehEventId", "left_anti").select(*involved.columns)
    return (
        kept.unionByName(new_events.select(*events.columns)),
        kept_involved.unionByName(new_involved.select(*involved.columns)),
    )


def upsert_by_id(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows with an incoming id are replaced; rows whose id did not come again stay."""
    kept = existing.join(incoming.select(key).distinct(), key, "left_anti").select(*existing.columns)
    return kept.unionByName(incoming.select(*existing.columns))


def replace_children(
    existing: DataFrame, incoming: DataFrame, parents: DataFrame, key: str, slices: DataFrame, on: Sequence[str]
) -> DataFrame:
    """Children of the stored parents inside the slices go; the incoming children take their place.

    For child tables whose own columns do not name their slice. The result does not depend on whether the
    parents were replaced before.
    """
    gone = parents.join(slices.select(*on).distinct(), list(on), "left_semi").select(key).distinct()
    kept = existing.join(gone, key, "left_anti").select(*existing.columns)
    return kept.unionByName(incoming.select(*existing.columns))


def cascade_delete(tables: Mapping[str, DataFrame], root: str, deleted: DataFrame) -> dict[str, DataFrame]:
    """Delete the ``root`` rows whose key is in ``deleted``, and all rows that hang on them, at any depth.

    Returns the surviving rows of every table given. The foreign keys are walked parents first, so a table with
    several parents loses a row when any of them loses its own. Each step removes by key with an anti join. The keys
    that go from a table are written out once, so the tables below it don't work them out again.
    """
    survivors = dict(tables)
    gone: dict[str, DataFrame] = {root: deleted.distinct()}
    for name in _downwards(root):
        if name not in tables:
            continue
        own_key = _single_key(name)
        if name == root:
            survivors[name] = _without(tables[name], gone[name], own_key)
            continue
        lost = []
        for parent in TABLES[name].parents:
            if parent.table in gone:
                keys = gone[parent.table].withColumnRenamed(_single_key(parent.table), parent.column)
                survivors[name] = _without(survivors[name], keys, parent.column)
                if own_key:
                    lost.append(tables[name].join(keys, parent.column, "left_semi").select(own_key))
        if lost:
            all_lost = lost[0]
            for more in lost[1:]:
                all_lost = all_lost.unionByName(more)
            gone[name] = all_lost.distinct()
            if any(child.name in tables for child, _ in children_of(name)):
                gone[name] = materialize(gone[name], f"gone-{name}")
    return survivors


def _without(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    return df.join(keys, column, "left_anti").select(*df.columns)


def _single_key(name: str) -> str | None:
    """The key other tables refer to; tables with a composite key have no children."""
    key = TABLES[name].key
    return key[0] if len(key) == 1 else None


def _downwards(root: str) -> list[str]:
    """``root`` and the tables below it, every table after all of its parents."""
    below, found = [root], {root}
    for name in below:
        for child, _ in children_of(name):
            if child.name not in found:
                found.add(child.name)
                below.append(child.name)
    ordered: list[str] = []
    while len(ordered) < len(below):
        for name in below:
            parents = {p.table for p in TABLES[name].parents if p.table in found} - {name}
            if name not in ordered and (name == root or parents <= set(ordered)):
                ordered.append(name)
    return ordered

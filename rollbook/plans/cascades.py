"""Cascading deletes in the stored warehouse.

The keys that go are walked down the foreign keys, parents before children. Of a child table only the columns that
refer to parents are read to find the doomed rows; only the slices that hold such rows are written anew, and all
tables are replaced in one commit, so that no reader after it, or after a recovery, sees a child without its parent.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.schemas.tables import TABLES, children_of
from rollbook.session import materialize, remove, scratch_path
from rollbook.sources.warehouse import Replacement, Warehouse

_WITHIN = ("Academy", "DataSet")
_MAX_PLACES = 200  # academies and years named one by one in a scan; of more, all are read


def delete_stored(warehouse: Warehouse, table: str, keys: DataFrame, same_slice: bool = False) -> dict[str, int]:
    """Deletes the rows of ``table`` with the given keys and all rows that hang on them, at any depth.

    Returns how many slices of each table were written anew. With ``same_slice`` only folders of the doomed parents'
    academies and years are looked at, which holds wherever keys name both, as those of the sync jobs do.
    """
    key = TABLES[table].key[0]
    folder = scratch_path(warehouse.spark, "cascade")
    warehouse.recover()
    try:
        doomed = materialize(keys.select(key).where(F.col(key).isNotNull()).distinct(), f"{table}-keys", folder)
        with warehouse.commit() as made:
            return stage_cascade(made, {table: doomed}, folder, same_slice=same_slice, roots_stay=False)
    finally:
        remove(warehouse.spark, folder)


def stage_cascade(
    made: Replacement, doomed: Mapping[str, DataFrame], folder: str, same_slice: bool = False, roots_stay: bool = True
) -> dict[str, int]:
    """Stages, in a commit, the tables below those whose keys are ``doomed``, without the rows that go.

    ``doomed`` holds distinct keys by table. With ``roots_stay`` the tables it names are replaced already and only those
    below them lose rows. Tables that the commit has replaced are left as they are.
    """
    warehouse, gone, written = made.warehouse, dict(doomed), {}
    within: dict[str, set | None] = {}
    for name in _parents_first(doomed):
        spec = TABLES[name]
        lost = [(p.column, gone[p.table], within.get(p.table)) for p in spec.parents if p.table in gone]
        own = spec.key[0] if len(spec.key) == 1 else None
        if name in doomed:
            if roots_stay:
                continue
            lost = [(own, doomed[name], None)]
        if name in made.tables or not lost:
            continue
        found = []
        for column, keys, places in lost:
            rows = warehouse.read(name)
            if same_slice and places is not None:
                rows = rows.where(_in_places(places))
            keys = keys.toDF(column)
            columns = dict.fromkeys([*spec.slice, *([own] if own else [])])
            found.append(rows.join(keys, column, "left_semi").select(*columns))
        hit = materialize(reduce(DataFrame.unionByName, found).distinct(), f"{name}-hit", folder)
        touched = materialize(hit.select(*spec.slice).distinct(), f"{name}-touched", folder)
        if not (number := touched.count()):
            continue
        left = warehouse.read_slices(name, touched)
        for column, keys, _ in lost:
            left = left.join(keys.toDF(column), column, "left_anti")
        made.replace_slices(name, left, touched)
        written[name] = number
        if own:
            gone[name] = hit.select(own).where(F.col(own).isNotNull()).distinct()
            # A key that names its academy and year is only referred to from there.
            named = isinstance(spec.storage_schema[own].dataType, T.StringType) and all(c in spec.slice for c in _WITHIN)
            places = touched.select(*_WITHIN).distinct().limit(_MAX_PLACES + 1).collect() if named else []
            within[name] = {tuple(r) for r in places} if 0 < len(places) <= _MAX_PLACES else None
    return written


def keys_that_go(warehouse: Warehouse, table: str, rows: DataFrame, slices: DataFrame) -> DataFrame:
    """Keys stored in the slices that the new rows don't bring back."""
    key = TABLES[table].key[0]
    stored = warehouse.read_slices(table, slices)
    return stored.select(key).distinct().join(rows.select(key), key, "left_anti")


def has_children(table: str) -> bool:
    return len(TABLES[table].key) == 1 and bool(children_of(table))


def _in_places(places: set):
    tests = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(_WITHIN, place, strict=True)]) for place in sorted(places)]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _parents_first(roots: Iterable[str]) -> list[str]:
    """The roots and all tables below them, every table after its parents."""
    below = list(roots)
    for name in below:
        below += [child.name for child, _ in children_of(name) if child.name not in below]
    ordered: list[str] = []
    while len(ordered) < len(below):
        ready = [
            name for name in below
            if name not in ordered and all(p.table in ordered or p.table not in below for p in TABLES[name].parents)
        ]
        ordered += ready
    return ordered

"""Stored tables: Parquet folders partitioned by slice, read by name and replaced slice by slice."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameReader, Row, SparkSession
from pyspark.sql import types as T

from rollbook.operators.project import project
from rollbook.schemas.tables import GRADE_TYPES, TABLES
from rollbook.session import file_system, materialize
from rollbook.sources import layout
from rollbook.sources.commits import Commit, Part, folder_names, leaves, recover, slice_folder
from rollbook.sources.idindex import INDEXED, IdIndex
from rollbook.sources.lookups import TABLE as LOOKED_UP
from rollbook.sources.lookups import LookUps


class Warehouse:
    """The tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        """The table with its declared types; filters on the slice columns prune folders (where slices share folders, those
        on the academic year). Empty if never written."""
        if table == "GradeTypes":
            return grade_types(self.spark)
        schema = TABLES[table].storage_schema
        fs, where = file_system(self.spark, self.path(table))
        if not fs.exists(where):
            return self.spark.createDataFrame([], schema)
        # The log's folders are its runs, which are no column of it.
        return self._reader(table, self.shared(table)).parquet(self.path(table)).select(*schema.names)

    def _reader(self, table: str, shared: bool) -> DataFrameReader:
        spec = TABLES[table]
        schema = layout.stored_schema(spec.storage_schema, spec.slice) if shared else spec.storage_schema
        return self.spark.read.schema(schema).option("basePath", self.path(table))

    def shared(self, table: str) -> bool:
        """Whether the table's slices share folders."""
        return layout.shared(self.spark, self.path(table))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in TABLES}

    def read_slices(self, table: str, slices: Iterable[Row] | DataFrame) -> DataFrame:
        """Only the rows of the given slices; no folder without one is read. Slices never written are empty."""
        spec = TABLES[table]
        if self.shared(table):
            if not isinstance(slices, DataFrame):
                by = T.StructType([spec.storage_schema[c] for c in spec.slice])
                slices = self.spark.createDataFrame([tuple(r[c] for c in spec.slice) for r in slices], by)
            rows = self.read_folders(table, self.shared_folders(table, slices))
            return layout.in_slices(rows, slices, spec.slice, "left_semi")
        rows = slices.select(*spec.slice).distinct().toLocalIterator() if isinstance(slices, DataFrame) else slices
        stored = set(layout.own_folders(self.spark, self.path(table), spec.slice))
        asked = dict.fromkeys(slice_folder(spec.slice, row) for row in rows)
        return self.read_folders(table, [folder for folder in asked if folder in stored], shared=False)

    def shared_folders(self, table: str, slices: DataFrame) -> list[str]:
        """The stored folders that the slices share with others. Far fewer than slices: academies are not told apart."""
        by = layout.folder_columns(TABLES[table].slice)
        named = layout.placed(slices, TABLES[table].slice).select(*by).distinct().collect()
        stored = set(leaves(self.spark, self.path(table), len(by)))
        return sorted({slice_folder(by, row) for row in named} & stored)

    def read_folders(self, table: str, folders: Sequence[str], shared: bool = True) -> DataFrame:
        """The rows in the named folders below the table's."""
        schema = TABLES[table].storage_schema
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path(table)}/{folder}" for folder in folders]
        return self._reader(table, shared).parquet(*paths).select(*schema.names)

    def ids(self, table: str) -> IdIndex:
        """The table's index from id to slice, made from the stored rows if there is none yet."""
        index = IdIndex(self.spark, self.root, table)
        fs, where = file_system(self.spark, self.path(table))
        if fs.exists(where) and not index.exists():
            index.rebuild(self.read(table))
        return index

    def lookups(self) -> LookUps:
        """The kept partial look-ups over the attribute values, made from the stored rows if there are none yet."""
        found = LookUps(self.spark, self.root)
        if not found.kept():
            found.build(self.read(LOOKED_UP), self.shared(LOOKED_UP))
        return found

    def recover(self) -> list[str]:
        """Finishes or undoes what a job that died has left. To be called while no other job writes."""
        return recover(self.spark, self.root)

    @contextmanager
    def commit(self) -> Iterator[Replacement]:
        """Replacements that are made together: all of them, or, if the body raises, none."""
        with Commit(self.spark, self.root) as made:
            yield Replacement(self, made)

    def replace_slices(self, table: str, rows: DataFrame, slices: DataFrame, empty: DataFrame | None = None) -> None:
        """Make ``rows`` the whole content of ``slices``; other slices are not touched or read."""
        with self.commit() as made:
            made.replace_slices(table, rows, slices, empty)

    def replace_by_id(
        self, table: str, rows: DataFrame, slices: DataFrame, key: str, sent_ids: DataFrame, inside: bool = True,
        folder: str | None = None,
    ) -> None:
        """Replace the slices, and remove rows with a sent id from every other slice as well."""
        with self.commit() as made:
            made.replace_by_id(table, rows, slices, key, sent_ids, inside, folder)

    def write_log(self, rows: DataFrame, run: str) -> DataFrame:
        """The log rows of one run, in a folder of their own: a run made again replaces them. Returns them as stored."""
        path = f"{self.path('SyncResults')}/run={run}"
        project(rows, "SyncResults").write.mode("overwrite").parquet(path)
        return self.spark.read.schema(TABLES["SyncResults"].storage_schema).parquet(path)


class Replacement:
    """What one commit replaces. The stored tables stay as they are until the commit is over."""

    def __init__(self, warehouse: Warehouse, made: Commit):
        self.warehouse = warehouse
        self._made = made

    @property
    def tables(self) -> set[str]:
        """The tables that have been replaced in this commit."""
        return {part.target for part in self._made.parts}

    def replace_slices(self, table: str, rows: DataFrame, slices: DataFrame, empty: DataFrame | None = None) -> None:
        """``rows`` become the whole content of ``slices``; other slices are not touched or read.

        ``empty`` names the slices without rows where the caller knows them; else they are looked up.
        """
        spec = TABLES[table]
        slices = slices.select(*spec.slice).distinct()
        share = self.warehouse.shared(table)
        stored = [] if share else layout.own_folders(self.warehouse.spark, self.warehouse.path(table), spec.slice)
        if not share:
            # More slices than may have a folder each need not be counted to the end.
            asked = {slice_folder(spec.slice, row) for row in slices.limit(layout.MAX_FOLDERS + 1).collect()}
            share = len(asked.union(stored)) > layout.MAX_FOLDERS
        if share:
            self._replace_in_shared_folders(table, rows, slices, bool(stored))
            return
        parts, staged = self._stage(table, project(rows, table), shared=False)
        if empty is None:
            empty = slices.join(staged.select(*spec.slice).distinct(), list(spec.slice), "left_anti")
        # One short row per slice that was asked for and came back empty. Only those that are stored are to be emptied.
        found = empty.select(*spec.slice).distinct().toLocalIterator() if stored else ()
        emptied = sorted({slice_folder(spec.slice, row) for row in found}.intersection(stored))
        for each in parts:
            each.emptied = emptied

    def _replace_in_shared_folders(self, table: str, rows: DataFrame, slices: DataFrame, moving: bool) -> None:
        """The folders in which the slices lie are written anew: other slices' rows as they were, then ``rows``. With
        ``moving`` the stored slices have a folder each and all move."""
        spec, warehouse = TABLES[table], self.warehouse
        rows = project(rows, table)
        emptied = folder_names(warehouse.spark, warehouse.path(table)) if moving else []
        if moving or warehouse.shared(table):
            replaced = slices.unionByName(rows.select(*spec.slice)).distinct()
            replaced = materialize(replaced, f"replaced-{table}", self._made.folder)
            emptied = emptied or warehouse.shared_folders(table, replaced)
            before = warehouse.read(table) if moving else warehouse.read_folders(table, emptied)
            rows = layout.in_slices(before, replaced, spec.slice, "left_anti").unionByName(rows)
        parts, _ = self._stage(table, rows, shared=True)
        for each in parts:
            # A folder that keeps rows is not emptied.
            each.emptied = sorted(set(emptied).difference(leaves(warehouse.spark, each.staged, each.depth)))

    def _stage(self, table: str, rows: DataFrame, shared: bool) -> tuple[list[Part], DataFrame]:
        """Stages rows with what is kept beside them; returns the parts, and the rows as they are staged."""
        spec, spark = TABLES[table], self.warehouse.spark
        by, order, schema = spec.slice, [k for k in spec.key if k not in spec.slice], spec.storage_schema
        if shared:
            by, order = layout.folder_columns(spec.slice), list(dict.fromkeys([*spec.slice, *order]))
            rows, schema = layout.placed(rows, spec.slice), layout.stored_schema(schema, spec.slice)
        parts = [self._made.stage(table, rows, by, [c for c in order if c not in by])]
        # What else there is to know of the rows is read from where they are staged, a few columns each.
        staged = spark.read.schema(schema).parquet(parts[0].staged)
        if table in INDEXED:
            self.warehouse.ids(table).add(staged)
        if table == LOOKED_UP and (kept := LookUps(spark, self.warehouse.root)).kept():
            parts.append(kept.stage(self._made, staged, shared))
        return parts, staged

    def replace_by_id(
        self, table: str, rows: DataFrame, slices: DataFrame, key: str, sent_ids: DataFrame, inside: bool = True,
        folder: str | None = None,
    ) -> None:
        """Replaces the slices, and removes rows with a sent id from every other slice as well.

        The id index names the slices that may hold such rows. Of these alone the ids are read, and only those that
        do hold one are written anew. ``inside`` says that all rows lie in the slices; otherwise the slices they
        fall into keep their other rows. ``folder`` is where to stage what is used more than once.
        """
        spec = TABLES[table]
        on = list(spec.slice)
        ids = materialize(sent_ids.select(key).distinct(), f"{table}-ids", folder)
        asked = slices.select(*on).distinct()
        named = self.warehouse.ids(table).slices_of(ids).select(*on).distinct()
        named = materialize(named.join(asked, on, "left_anti"), f"{table}-named", folder)
        touched = self.warehouse.read_slices(table, named).join(ids, key, "left_semi").select(*on)
        if not inside:
            touched = touched.unionByName(rows.select(*on).join(asked, on, "left_anti"))
        touched = materialize(touched.distinct(), f"{table}-touched", folder)
        if touched.isEmpty():
            self.replace_slices(table, rows, slices)
            return
        survivors = self.warehouse.read_slices(table, touched).join(ids, key, "left_anti")
        content = project(survivors, table).unionByName(project(rows, table))
        self.replace_slices(table, content, asked.unionByName(touched))


def grade_types(spark: SparkSession) -> DataFrame:
    """The fixed grade types, as constants inside the plan."""
    rows = ", ".join(f"({number}, '{name}')" for number, name in GRADE_TYPES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(GradeTypeId, Name)")

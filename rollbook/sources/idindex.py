"""From an id to the slices that may hold it, for tables in which an id can come back in another slice.

The index is a narrow table of (id, slice), in folders of ``WIDTH`` consecutive ids, so a batch of ids opens only the
folders of their ranges, each of bounded size. Entries are added before the rows they speak of are stored and never
withdrawn when rows go: the index names every slice that holds an id, and perhaps some that no longer do, which the
caller finds out by reading those slices alone. ``compact`` drops such entries and joins the files of many additions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.schemas.tables import TABLES
from rollbook.session import file_system, remove
from rollbook.sources.commits import Commit

FOLDER = "_ids"
# Tables whose id decides which stored rows a new one replaces, wherever they lie.
INDEXED = {"BehEvents": "BehEventId", "BehEventStudents": "BehEventId", "Staff": "StaffId"}
_BITS = 20
WIDTH = 1 << _BITS
MAX_NAMED = 1000  # ranges named one by one in a scan; of more, the scan is told the first and the last


class IdIndex:
    def __init__(self, spark: SparkSession, root: str, table: str):
        self.spark = spark
        self.root = root
        self.table = table
        self.key = INDEXED[table]
        self.slice = TABLES[table].slice
        self.target = f"{FOLDER}/{table}"
        self.path = f"{root}/{self.target}"
        known = {f.name: f for f in TABLES[table].storage_schema}
        self.schema = T.StructType([known[self.key], *[known[c] for c in self.slice], T.StructField("span", T.LongType())])

    def exists(self) -> bool:
        fs, where = file_system(self.spark, self.path)
        return fs.exists(where)

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def slices_of(self, ids: DataFrame) -> DataFrame:
        """(id, slice): where rows of the ids may be stored. Opens only the folders of the ids' ranges."""
        named = self.read().where(self._in_ranges(ids))
        return named.join(ids.select(self.key).distinct(), self.key, "left_semi").select(self.key, *self.slice)

    def add(self, rows: DataFrame) -> None:
        """Enters rows that are about to be stored; what is entered already is not entered again."""
        new = rows.select(self.key, *self.slice).where(F.col(self.key).isNotNull()).distinct()
        if self.exists():
            known = self.read().where(self._in_ranges(new)).select(self.key, *self.slice)
            same = [new[c].eqNullSafe(known[c]) for c in (self.key, *self.slice)]
            new = new.join(known, same, "left_anti")
        self._entries(new).write.mode("append").partitionBy("span").parquet(self.path)

    def rebuild(self, stored: DataFrame) -> None:
        """The index of a table that has none yet, from one scan of its ids and slices. It appears when complete."""
        draft = f"{self.root}/{FOLDER}/_{self.table}"
        rows = stored.select(self.key, *self.slice).where(F.col(self.key).isNotNull()).distinct()
        self._entries(rows).write.mode("overwrite").partitionBy("span").parquet(draft)
        fs, target = file_system(self.spark, self.path)
        remove(self.spark, self.path)
        fs.rename(file_system(self.spark, draft)[1], target)

    def compact(self, stored: DataFrame, most_files: int = 16) -> int:
        """Writes the ranges of more than ``most_files`` files anew, without repeated entries and those that no stored
        row bears out. Returns the number of ranges."""
        fs, where = file_system(self.spark, self.path)
        if not fs.exists(where):
            return 0
        spans = [s.getPath() for s in fs.listStatus(where) if s.isDirectory()]
        full = [int(p.getName().split("=")[1]) for p in spans if len(fs.listStatus(p)) > most_files]
        if not full:
            return 0
        entries = self.read().where(F.col("span").isin(full)).select(self.key, *self.slice).distinct()
        held = stored.select(self.key, *self.slice).where(_span(F.col(self.key)).isin(full)).distinct()
        same = [entries[c].eqNullSafe(held[c]) for c in (self.key, *self.slice)]
        with Commit(self.spark, self.root) as commit:
            kept = entries.join(held, same, "left_semi").withColumn("span", _span(F.col(self.key)))
            commit.stage(self.target, kept, ["span"], [self.key], [f"span={n}" for n in full])
            # A range that keeps entries is not emptied.
            left = {f"span={r[0]}" for r in self.spark.read.schema(self.schema).parquet(commit.parts[0].staged).select("span").distinct().collect()}
            commit.parts[0].emptied = [name for name in commit.parts[0].emptied if name not in left]
        return len(full)

    def _entries(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("span", _span(F.col(self.key))).hint("rebalance", F.col("span")).sortWithinPartitions("span", self.key)

    def _in_ranges(self, ids: DataFrame) -> Column:
        """The ids' ranges as a constant: a scan skips all other folders."""
        spans = ids.where(F.col(self.key).isNotNull()).select(_span(F.col(self.key)).alias("span")).distinct()
        named = [r["span"] for r in spans.limit(MAX_NAMED + 1).collect()]
        if len(named) <= MAX_NAMED:
            return F.col("span").isin(named)
        ends = spans.agg(F.min("span").alias("low"), F.max("span").alias("high")).first()
        return F.col("span").between(ends["low"], ends["high"])


def _span(id: Column) -> Column:
    return F.shiftright(id, _BITS).cast("bigint")

"""Partial look-ups kept beside the attribute values: a look-up merges them instead of reading every value.

The partial rows of a slice lie in a folder of the slice's name and are replaced in the same commit as its values, so
the two agree after every job, and after the recovery of one that died. Only the rows that a commit stages are reduced;
no stored value is read again. A warehouse keeps them from the first ``build`` on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rollbook.operators import partials
from rollbook.schemas.tables import TABLES
from rollbook.session import file_system, remove
from rollbook.sources import layout
from rollbook.sources.commits import Commit, Part

FOLDER = "_lookups"
TABLE = "AttributeValues"


class LookUps:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.slice = TABLES[TABLE].slice
        self.target = f"{FOLDER}/{TABLE}"
        self.path = f"{root}/{self.target}"
        known = {f.name: f.dataType for f in TABLES[TABLE].storage_schema}
        dated = T.StructType([T.StructField(c, known[c]) for c in ("Date", "Value")])
        own = {"Last": dated, "First": dated, "Undated": known["Value"], "UndatedRows": T.LongType()}
        columns = {c: known[c] for c in partials.OF} | own | {c: known[c] for c in self.slice}
        self.schema = T.StructType([T.StructField(name, kind) for name, kind in columns.items()])

    def kept(self) -> bool:
        fs, where = file_system(self.spark, self.path)
        return fs.exists(where)

    def read(self) -> DataFrame:
        """The partial rows; filters on the slice columns prune folders."""
        schema = layout.stored_schema(self.schema, self.slice) if layout.shared(self.spark, self.path) else self.schema
        return self.spark.read.schema(schema).parquet(self.path).select(*self.schema.names)

    def build(self, stored: DataFrame, shared: bool = False) -> None:
        """Reduces all stored values once. The partial rows appear when they are complete; earlier ones go.

        ``shared`` says that the values' slices share folders; those of the partial rows then do as well.
        """
        draft = f"{self.root}/{FOLDER}/_{TABLE}"
        rows, by = self._reduced(stored, shared)
        rows = rows.hint("rebalance", *by).sortWithinPartitions(*by, *partials.OF)
        rows.write.mode("overwrite").partitionBy(*by).parquet(draft)
        fs, target = file_system(self.spark, self.path)
        remove(self.spark, self.path)
        if not fs.rename(file_system(self.spark, draft)[1], target):
            raise OSError(f"could not rename {draft} to {self.path}")

    def stage(self, commit: Commit, staged: DataFrame, shared: bool = False) -> Part:
        """The partial rows of values that are about to be stored join their commit."""
        return commit.stage(self.target, *self._reduced(staged, shared), partials.OF)

    def _reduced(self, values: DataFrame, shared: bool) -> tuple[DataFrame, Sequence[str]]:
        """The partial rows of whole slices, and the columns that name their folders."""
        rows = partials.partial_values(values, self.slice)
        return (layout.placed(rows, self.slice), layout.folder_columns(self.slice)) if shared else (rows, self.slice)

    def views(self, types: DataFrame) -> dict[str, DataFrame]:
        """The attribute look-ups under the names that ``reports.attribute_look_ups`` gives them."""
        named = partials.named_partials(types, self.read())
        return {
            "v_AttributeValueLatest": partials.latest_value(named),
            "v_AttributeValueEarliest": partials.earliest_value(named),
            "v_AttributeValueAcademicYear": partials.values_by_year(named),
            "v_AttributeValueNoTimeStamp": partials.value_without_timestamp(named),
        }

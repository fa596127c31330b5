"""What a run has done so far: one folder per endpoint that is finished, kept until the run's log is written.

An endpoint is entered after its tables are committed. A run that died in between does that one endpoint again, which
replaces the same slices with the same rows. An endpoint that broke off is entered as well: its failure is its outcome.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollbook.session import file_system, remove

FOLDER = "_runs"


class Journal:
    def __init__(self, spark: SparkSession, root: str, run: str):
        self.spark = spark
        self.path = f"{root}/{FOLDER}/{run}"

    def outcome(self, endpoint: str) -> DataFrame | None:
        """The endpoint's outcome by request, if it was finished. Spark's mark of a whole table tells."""
        path = f"{self.path}/{endpoint}"
        fs, mark = file_system(self.spark, f"{path}/_SUCCESS")
        return self.spark.read.parquet(path) if fs.exists(mark) else None

    def enter(self, endpoint: str, outcome: DataFrame) -> DataFrame:
        path = f"{self.path}/{endpoint}"
        outcome.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(outcome.schema).parquet(path)

    def finished(self) -> list[str]:
        fs, where = file_system(self.spark, self.path)
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
        return sorted(name for name in names if self.outcome(name) is not None)

    def close(self) -> None:
        """The run has ended: nothing is left to go on with."""
        remove(self.spark, self.path)

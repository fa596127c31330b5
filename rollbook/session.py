"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the library relies on. Everything else (cores, memory, shuffle width) is the cluster's business.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Scratch folders of local sessions that name none, by application: the setting itself can't be changed afterwards.
_own_roots: dict[str, str] = {}


def local_session(cores: str | int = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rollbook")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder shared by all executors, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _own_roots:
        _own_roots[application] = tempfile.mkdtemp(prefix="rollbook-")
    return _own_roots[application]


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it wants it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/rollbook/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, or a ``folder`` in it, and read it back.

    Cuts the lineage in files that survive the loss of an executor, and lets later steps read only the
    columns they need.
    """
    path = f"{folder}/{name}" if folder else scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

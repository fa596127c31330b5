"""Rolling re-sync: landed pages are picked up as they arrive and their slices replaced again.

Whole slices are replaced, so late corrections need no watermark: a day that is landed again replaces itself, and
a batch that is run twice stores the same rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollbook.functions.columns import request_date_label, year_group_label
from rollbook.plans.jobs import sync_requests
from rollbook.plans.requests import PLAN_COLUMNS
from rollbook.schemas.endpoints import ENDPOINTS, PAGE_SCHEMA
from rollbook.sources.landing import read_landing
from rollbook.sources.warehouse import Warehouse


def rolling_sync(
    warehouse: Warehouse, landing: str, checkpoint: str, endpoints: Sequence[str], files_per_batch: int = 1000
) -> StreamingQuery:
    """Load everything landed since the last run, then stop (``availableNow``).

    A request may arrive in several files and batches. Each batch takes the requests it saw and hands them, with
    all of their pages so far, to the batch job, which stores only whole requests; one that is not complete yet
    is logged as such and comes again with its next page.
    """
    spark = warehouse.spark
    arriving = (
        spark.readStream.schema(PAGE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
        .filter(F.col("endpoint").isin(*endpoints))
        .select("request_id", "endpoint", "Academy", "DataSet", "NCYear", "Date", "fetched_at")
    )
    stream = f"{zlib.crc32(checkpoint.encode()):08x}"

    def store(batch: DataFrame, number: int) -> None:
        seen = requests_of(batch)
        # The newest fetch of a request seen here is not older than what was seen: earlier days stay unread.
        since = batch.agg(F.min(F.to_date("fetched_at"))).first()[0]
        # A batch that is run again replaces its own log.
        sync_requests(
            warehouse, read_landing(spark, landing), seen, endpoints, run=f"{stream}-{number}", landed_since=since
        )

    return (
        arriving.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def requests_of(batch: DataFrame) -> DataFrame:
    """The requests a batch of pages belongs to, in the form of a request plan."""
    area = F.create_map(*[F.lit(x) for e in ENDPOINTS.values() for x in (e.name, e.area)])
    path = F.create_map(*[F.lit(x) for e in ENDPOINTS.values() for x in (e.name, e.path)])
    seen = batch.select("request_id", "endpoint", "Academy", "DataSet", "NCYear", "Date").distinct()
    return seen.select(
        "*", area[F.col("endpoint")].alias("area"), path[F.col("endpoint")].alias("path"),
        year_group_label("NCYear").alias("YearGroup"), request_date_label("Date").alias("DateText"),
    ).select(*PLAN_COLUMNS)

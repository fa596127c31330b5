"""The log of requests: one row per request with its outcome, and what can be read from it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.operators.project import project


def log_rows(outcomes: DataFrame, logged_at: datetime | None = None) -> DataFrame:
    """Outcomes (Academy, DataSet, NCYear, Date, path, problem, detail) as log rows; no problem is success.

    Requests that were never made, because an earlier year group of theirs failed, are not logged.
    """
    at = F.lit(logged_at).cast("timestamp") if logged_at else F.current_timestamp()
    made = outcomes.filter(~F.coalesce(F.col("skipped"), F.lit(False)))
    rows = made.select(
        at.alias("LoggedAt"),
        F.col("Academy").alias("AcademyCode"),
        F.col("path").alias("EndPoint"),
        F.col("DataSet"),
        F.col("NCYear").alias("YearGroup"),
        F.col("Date"),
        F.col("problem").isNull().alias("Result"),
        F.col("problem").alias("Exception"),
        F.col("detail").alias("InnerException"),
    )
    return project(rows, "SyncResults")


def log_summary(log: DataFrame) -> DataFrame:
    """Per academy and endpoint: the last result, when it was logged, and how many requests failed."""
    last = F.max(F.struct("LoggedAt", (~F.col("Result")).alias("failed")))
    return (
        log.groupBy("AcademyCode", "EndPoint")
        .agg(
            last.alias("last"), F.count("*").alias("requests"), F.count_if(~F.col("Result")).alias("failures")
        )
        .select(
            "AcademyCode", "EndPoint", F.col("last.LoggedAt").alias("LoggedAt"),
            (~F.col("last.failed")).alias("LastResult"), "requests", "failures",
        )
    )


def failed_requests(log: DataFrame) -> DataFrame:
    return log.filter(~F.col("Result"))

"""Which requests a run makes: one row per academy and endpoint, cut by year group or by day.

Everything is expanded from the config rows, without joins: a config row carries its endpoints, years and days
as arrays and is exploded.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.columns import request_date_label, year_group_label
from rollbook.schemas.endpoints import AREAS, ENDPOINTS, Endpoint

PLAN_COLUMNS = (
    "request_id", "area", "endpoint", "path", "Academy", "DataSet", "NCYear", "YearGroup", "Date", "DateText"
)


def active_academies(config: DataFrame) -> DataFrame:
    return config.filter(F.col("Active"))


def request_plan(
    config: DataFrame, as_of: date, areas: Iterable[str] = AREAS, dataset: str | None = None
) -> DataFrame:
    """All requests of a run over the given areas, as of a day.

    ``dataset`` asks for another academic year than the academies' current one (a historic back-fill).
    """
    wanted = [e for area in areas for e in ENDPOINTS.values() if e.area == area]
    return plan_endpoints(config, as_of, wanted, dataset)


def plan_endpoints(
    config: DataFrame, as_of: date, endpoints: Iterable[Endpoint], dataset: str | None = None
) -> DataFrame:
    made = F.array(*[_requests_of(e, as_of) for e in endpoints])
    year = F.lit(dataset) if dataset else F.col("CurrentAcademicYear")
    plan = active_academies(config).select(
        F.col("AcademyCode").alias("Academy"), year.alias("DataSet"), F.explode(F.flatten(made)).alias("request")
    )
    plan = plan.select("Academy", "DataSet", "request.*").withColumns(
        {"YearGroup": year_group_label("NCYear"), "DateText": request_date_label("Date")}
    )
    return plan.withColumn("request_id", request_id()).select(*PLAN_COLUMNS)


def request_id() -> Column:
    """What identifies a request, also in the landing folder. Year groups sort by number."""
    return F.concat_ws(
        "|",
        "endpoint",
        "Academy",
        "DataSet",
        F.coalesce(F.lpad(F.col("NCYear").cast("string"), 2, "0"), F.lit("")),
        F.coalesce(F.date_format("Date", "yyyy-MM-dd"), F.lit("")),
    )


def _requests_of(endpoint: Endpoint, as_of: date) -> Column:
    """The requests one config row makes at an endpoint, as an array; empty where its flag is off."""
    if endpoint.scope == "year_group":
        cuts = F.transform(
            _numbers(F.col("LowestYear"), F.col("HighestYear")), lambda y: _request(endpoint, year=y)
        )
    elif endpoint.scope == "day":
        first, last, back_from, back_to = endpoint.window
        today = F.lit(as_of)
        start = F.coalesce(F.col(first), F.date_sub(today, back_from))
        end = F.coalesce(F.col(last), F.date_sub(today, back_to))
        offsets = _numbers(F.lit(0), F.datediff(end, start))
        cuts = F.transform(offsets, lambda n: _request(endpoint, day=F.date_add(start, n)))
    else:
        cuts = F.array(_request(endpoint))
    if endpoint.enabled_by:
        cuts = F.filter(cuts, lambda _: F.coalesce(F.col(endpoint.enabled_by), F.lit(False)))
    return cuts


def _request(endpoint: Endpoint, year: Column | None = None, day: Column | None = None) -> Column:
    return F.struct(
        F.lit(endpoint.area).alias("area"),
        F.lit(endpoint.name).alias("endpoint"),
        F.lit(endpoint.path).alias("path"),
        (F.lit(None) if year is None else year).cast("int").alias("NCYear"),
        (F.lit(None) if day is None else day).cast("date").alias("Date"),
    )


def _numbers(low: Column, high: Column) -> Column:
    """low..high, or nothing when the bounds are reversed (``sequence`` alone would count down)."""
    numbers = F.sequence(low, F.greatest(low, high))
    return F.when(high >= low, numbers).otherwise(F.array().cast("array<int>"))

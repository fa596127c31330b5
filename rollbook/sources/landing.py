"""Landed pages -> typed records, and the proof that every request's page chain is whole.

A page is one response body. It may be an envelope, a bare array, or one bare object. Bodies are parsed
once; the parsed pages keep the records as a typed array, so that they can be stored and read column-wise.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.schemas.endpoints import PAGE_SCHEMA, Endpoint

PAGE_COLUMNS = ("request_id", "Academy", "DataSet", "NCYear", "Date", "page_no", "cursor_in")


# Where the landing folder is partitioned by the day of the fetch as well, a read that knows its days opens only those.
FETCH_DAY = "fetch_day"
LANDING_PARTITIONS = ("endpoint", FETCH_DAY)


def read_landing(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The landing folder, partitioned by endpoint and, if it is, by ``fetch_day``: reads of one skip all others."""
    return spark.read.schema(PAGE_SCHEMA).format(fmt).load(path)


def land(pages: DataFrame, path: str) -> None:
    """Add pages to a landing folder, partitioned by endpoint and day of the fetch."""
    days = pages.withColumn(FETCH_DAY, F.to_date("fetched_at"))
    days.write.mode("append").partitionBy(*LANDING_PARTITIONS).parquet(path)


def asked_pages(pages: DataFrame, requests: DataFrame, first_day: date | None = None) -> DataFrame:
    """``pages`` without those that no request asks for, as far as constants can tell: a scan skips their folders.

    The endpoints and data sets of the requests are collected, which are few however many requests there are.
    ``first_day`` is the earliest day on which a request of these can have been fetched, where the caller knows it.
    """
    sets = requests.agg(F.collect_set("endpoint").alias("endpoints"), F.min("DataSet").alias("low"), F.max("DataSet").alias("high")).first()
    pages = pages.filter(F.col("endpoint").isin(*sets["endpoints"]) & F.col("DataSet").between(sets["low"], sets["high"]))
    if first_day is not None and FETCH_DAY in pages.columns:
        pages = pages.filter(F.col(FETCH_DAY) >= F.lit(first_day))
    return pages


def pages_of_days(pages: DataFrame, fetches: DataFrame) -> DataFrame:
    """``pages`` of the days on which the fetches were made; their folders are named in the scan."""
    if FETCH_DAY not in pages.columns:
        return pages
    days = [r[0] for r in fetches.select(F.to_date("fetched_at")).distinct().collect()]
    return pages.filter(F.col(FETCH_DAY).isin(days))


def newest_fetches(pages: DataFrame, requests: DataFrame) -> DataFrame:
    """For each of the requests: when it was last made. Reads two narrow columns of the landing folder."""
    asked = pages.select("request_id", "fetched_at").join(requests.select("request_id"), "request_id", "left_semi")
    return asked.groupBy("request_id").agg(F.max("fetched_at").alias("fetched_at"))


def parse_pages(pages: DataFrame, endpoint: Endpoint) -> DataFrame:
    """One row per page: its place in the chain, its records, and whether its text made sense.

    An envelope without its row key, text that is not JSON, a value of the wrong type and a record without
    its mandatory fields all make ``page_ok`` false; no default-valued row is ever made up.

    The parsed struct passes through ``inline``: later filters are not pushed below it, where they would repeat the
    parsing for every column they mention.
    """
    body = F.col("body")
    as_envelope = F.when(
        F.ltrim(body).startswith("["), _wrap(endpoint, F.lit(""), body, F.lit(""))
    ).otherwise(body)
    parsed = pages.select(
        *PAGE_COLUMNS, "body", F.inline(F.array(F.from_json(as_envelope, endpoint.page_ddl)))
    )
    records = F.col(f"`{endpoint.key}`")
    page = F.struct(records, "has_more", "cursor", "_corrupt_record")
    is_envelope = records.isNotNull() | F.col("_corrupt_record").isNotNull()
    as_object = F.from_json(_wrap(endpoint, F.lit("["), body, F.lit("]")), endpoint.page_ddl)
    parsed = parsed.select(*PAGE_COLUMNS, F.inline(F.array(F.when(is_envelope, page).otherwise(as_object))))
    complete = F.forall(
        records,
        lambda r: r.isNotNull() & reduce(Column.__and__, [r[f].isNotNull() for f in endpoint.must_have]),
    )
    return parsed.select(
        *PAGE_COLUMNS,
        F.coalesce(F.col("has_more"), F.lit(False)).alias("has_more"),
        F.col("cursor").alias("cursor_out"),
        F.coalesce(F.col("_corrupt_record").isNull() & complete, F.lit(False)).alias("page_ok"),
        records.alias("records"),
    )


def records_of(parsed: DataFrame) -> DataFrame:
    """One row per record, in column ``row``, with the request it came from and the day it asked for."""
    return parsed.select(
        "request_id", "Academy", "DataSet", "NCYear", F.col("Date").alias("AskedDay"), F.explode("records").alias("row")
    )


def chain_status(parsed: DataFrame) -> DataFrame:
    """One row per request: are its pages readable, and do they form one whole chain?

    A whole chain has one first page (asked for without a cursor), one last page (nothing more to come), and
    every page in between was asked for with the cursor of the page before it. Each page contributes the link
    it arrived by and the link it hands on, keyed by request and page number; a whole chain has exactly one of
    each with the same cursor. Counting links needs no window over a request's pages, so a request with very
    many pages is spread over all tasks.
    """
    page_no, no_cursor = F.col("page_no"), F.lit(None).cast("long")
    marks = parsed.select(
        "request_id",
        F.explode(
            F.filter(
                F.array(
                    _mark(
                        page_no, no_cursor, page=1, first=(page_no == 1) & F.col("cursor_in").isNull(),
                        last=~F.col("has_more"), unreadable=~F.col("page_ok"),
                    ),
                    F.when(page_no > 1, _mark(page_no, F.col("cursor_in"), arrival=1)),
                    F.when(F.col("has_more"), _mark(page_no + 1, F.col("cursor_out"), departure=1)),
                ),
                lambda m: m.isNotNull(),
            )
        ).alias("mark"),
    )
    is_link = F.col("mark.arrival") + F.col("mark.departure") > 0
    per_page = marks.groupBy("request_id", "mark.page_no").agg(
        *[F.sum(f"mark.{c}").alias(c) for c in _COUNTS],
        F.min("mark.cursor").alias("low"),
        F.max("mark.cursor").alias("high"),
        F.count_if(is_link & F.col("mark.cursor").isNull()).alias("blank"),
    )
    links = F.col("arrival") + F.col("departure")
    whole = (
        (F.col("arrival") == 1) & (F.col("departure") == 1) & (F.col("blank") == 0) & (F.col("low") == F.col("high"))
    )
    status = per_page.groupBy("request_id").agg(
        *[F.sum(c).alias(c) for c in ("page", "first", "last", "unreadable")],
        F.count_if((links > 0) & ~whole).alias("broken"),
    )
    reason = (
        F.when(F.col("unreadable") > 0, "unreadable page")
        .when((F.col("first") != 1) | (F.col("last") != 1) | (F.col("broken") > 0), "broken page chain")
    )
    return status.select(
        "request_id", F.col("page").alias("pages"), "unreadable", F.col("broken").alias("broken_links"),
        reason.alias("problem"),
    )


def _wrap(endpoint: Endpoint, before: Column, body: Column, after: Column) -> Column:
    return F.concat(F.lit(f'{{"{endpoint.key}":'), before, body, after, F.lit("}"))


_COUNTS = ("page", "first", "last", "unreadable", "arrival", "departure")


def _mark(page_no: Column, cursor: Column, **counts: Column | int) -> Column:
    """What a page says about one place in the chain; counts not given are zero."""
    values = [
        (c if isinstance(c := counts.get(name, 0), Column) else F.lit(c)).cast("int").alias(name) for name in _COUNTS
    ]
    return F.struct(page_no.alias("page_no"), cursor.alias("cursor"), *values)

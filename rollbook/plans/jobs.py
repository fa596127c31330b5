"""Sync jobs: landed pages of planned requests -> replaced slices and a log.

Each endpoint goes through the same steps. The pages are parsed once into a staged, typed table; the checks and
the writes read only the columns they need from it. Whether a request may be stored is a column, not an
exception, so one bad request never stops another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from functools import reduce
from itertools import groupby
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.operators.checks import request_report, shared_key_failures, stored_key_failures
from rollbook.operators.flatten import flatten
from rollbook.operators.synclog import log_rows
from rollbook.plans.cascades import has_children, keys_that_go, stage_cascade
from rollbook.plans.requests import request_plan
from rollbook.schemas.endpoints import AREAS, ENDPOINTS, Endpoint
from rollbook.schemas.tables import TABLES
from rollbook.session import materialize, remove, scratch_path
from rollbook.sources.chains import numbered_chains
from rollbook.sources.journal import Journal
from rollbook.sources.landing import asked_pages, chain_status, newest_fetches, pages_of_days, parse_pages, records_of
from rollbook.sources.warehouse import Replacement, Warehouse

# Areas of the three ways a sync is started.
FULL = AREAS
ATTENDANCE = ("attendance",)
BEHAVIOUR = ("attendance", "behaviour")

_GROUPS = {
    "general_attributes": "General",
    "demographic_attributes": "Demographic",
    "send_attributes": "Send",
    "sensitive_attributes": "Sensitive",
}
# Tables whose key does not name its slice, so that another slice may hold the same key.
_SHARED_KEYS = ("BehClassifications", "BehEventTypes", "Grades")
# Where an id that was sent before, by whatever request, is replaced.
_LAST_WINS = {"beh_events": "BehEventId", "staff": "StaffId"}


def full_sync(warehouse: Warehouse, pages: DataFrame, config: DataFrame, as_of: date, **options) -> DataFrame:
    """Every area. With ``cascade=True``, what hangs on rows that did not come back goes with them."""
    return run_sync(warehouse, pages, config, as_of, FULL, **options)


def attendance_sync(warehouse: Warehouse, pages: DataFrame, config: DataFrame, as_of: date, **options) -> DataFrame:
    return run_sync(warehouse, pages, config, as_of, ATTENDANCE, **options)


def behaviour_sync(warehouse: Warehouse, pages: DataFrame, config: DataFrame, as_of: date, **options) -> DataFrame:
    """Attendance comes first, then behaviour."""
    return run_sync(warehouse, pages, config, as_of, BEHAVIOUR, **options)


def run_sync(
    warehouse: Warehouse, pages: DataFrame, config: DataFrame, as_of: date, areas: Iterable[str] = FULL,
    dataset: str | None = None, logged_at: datetime | None = None, parallel: int = 4, landed_since: date | None = None,
    **options,
) -> DataFrame:
    """Plan the requests of ``areas``, store what they brought, log every one. Returns the new log rows.

    ``dataset`` re-loads another academic year (a historic back-fill); all other years stay untouched. For ``options``
    see ``sync_requests``.
    """
    areas = tuple(areas)
    plan = request_plan(config, as_of, areas, dataset)
    names = [e.name for area in areas for e in ENDPOINTS.values() if e.area == area]
    return sync_requests(warehouse, pages, plan, names, logged_at, parallel, landed_since=landed_since, **options)


def sync_requests(
    warehouse: Warehouse, pages: DataFrame, plan: DataFrame, endpoints: Iterable[str],
    logged_at: datetime | None = None, parallel: int = 4, run: str | None = None, landed_since: date | None = None,
    cascade: bool = False, page_numbers: bool = True,
) -> DataFrame:
    """Store the requests in ``plan``, area after area in the order given; ``parallel`` endpoints at a time.

    Of the landing folder only the endpoints and data sets asked are looked at (two narrow columns, from the day
    ``landed_since`` on if that is given), and page texts are read only from the days of the newest fetches.

    What a job that died left half-way is finished or undone first. With ``cascade``, rows of other tables whose parent
    does not come back with its slice go with it; endpoints then take turns. Without ``page_numbers`` the pages are put
    in order by their cursors.

    A named ``run`` keeps a journal of the endpoints that are done. Made again after it died, it goes on with the
    others; made again after it ended, it replaces its log rows. An endpoint whose job breaks off
    fails its own requests, with the error in the log; all others are stored and logged.
    """
    # Plan and fetches hold one short row per request. Written out, their size is known when the joins with the
    # pages are planned, so the page texts are not shuffled unless there really are too many requests to broadcast.
    folder = scratch_path(warehouse.spark, "sync")
    warehouse.recover()
    journal = Journal(warehouse.spark, warehouse.root, run) if run else None
    try:
        plan = materialize(plan, "plan", folder)
        pages = asked_pages(pages, plan, landed_since)
        fetches = materialize(newest_fetches(pages, plan), "fetches", folder)
        pages = pages_of_days(pages, fetches)
        outcomes: list[DataFrame] = []
        for _, area in groupby((ENDPOINTS[name] for name in endpoints), key=lambda e: e.area):
            # Endpoints that feed the same table take turns; the others run side by side and share the cluster.
            lanes: dict[str, list[Endpoint]] = {}
            for endpoint in area:
                lanes.setdefault("" if cascade else endpoint.tables[0], []).append(endpoint)
            with ThreadPoolExecutor(parallel) as pool:
                made = pool.map(
                    lambda lane: [_journaled(journal, e, lambda e=e: _isolated(
                        warehouse, pages, plan, fetches, e, folder, cascade, page_numbers)) for e in lane],
                    lanes.values(),
                )
                outcomes += [outcome for lane in made for outcome in lane]
        log = log_rows(reduce(DataFrame.unionByName, outcomes), logged_at)
        written = warehouse.write_log(log, run or uuid4().hex)
        if journal:
            journal.close()
        return written
    finally:
        remove(warehouse.spark, folder)


def _journaled(journal: Journal | None, endpoint: Endpoint, make: Callable[[], DataFrame]) -> DataFrame:
    """The endpoint's outcome: as the journal holds it, or made now and entered."""
    if journal is None:
        return make()
    return journal.outcome(endpoint.name) or journal.enter(endpoint.name, make())


def _isolated(
    warehouse: Warehouse, pages: DataFrame, plan: DataFrame, fetches: DataFrame, endpoint: Endpoint, folder: str,
    cascade: bool, page_numbers: bool,
) -> DataFrame:
    try:
        return _sync_endpoint(warehouse, pages, plan, fetches, endpoint, folder, cascade, page_numbers)
    except Exception as error:  # whatever it is, it is logged, and the other endpoints go on
        asked = plan.filter(F.col("endpoint") == endpoint.name)
        return asked.withColumns(
            {"problem": F.lit("endpoint failed"), "detail": F.lit(f"{type(error).__name__}: {error}"), "skipped": F.lit(False)}
        )


def _sync_endpoint(
    warehouse: Warehouse, pages: DataFrame, plan: DataFrame, fetches: DataFrame, endpoint: Endpoint, folder: str,
    cascade: bool = False, page_numbers: bool = True,
) -> DataFrame:
    asked = plan.filter(F.col("endpoint") == endpoint.name)
    landed = pages.filter(F.col("endpoint") == endpoint.name)
    landed = landed.join(fetches, ["request_id", "fetched_at"], "left_semi")
    parsed = materialize(parse_pages(landed, endpoint), f"{endpoint.name}-pages", folder)
    if not page_numbers:
        # A page without a place has number 0, which no whole chain has.
        parsed = numbered_chains(parsed, f"{folder}/{endpoint.name}-chain").withColumn("page_no", F.coalesce("page_no", F.lit(0)))

    chains = asked.select("request_id").join(chain_status(parsed), "request_id", "left")
    chains = chains.select(
        "request_id", F.when(F.col("pages").isNull(), "no page landed").otherwise(F.col("problem")).alias("problem")
    )
    chains = materialize(chains, f"{endpoint.name}-chains", folder)
    readable = parsed.join(chains.filter(F.col("problem").isNull()), "request_id", "left_semi")
    tables = flatten(records_of(readable), endpoint.name)

    found = chains.withColumns({"detail": F.lit(None).cast("string"), "rows": F.lit(None).cast("long")})
    for name, rows in tables.items():
        found = found.unionByName(_report(endpoint, name, rows))
    outcome = found.groupBy("request_id").agg(
        F.min(F.when(F.col("problem").isNotNull(), F.struct("problem", "detail"))).alias("first"),
        *[F.sum(F.when(F.col("detail") == name, F.col("rows"))).alias(f"rows_{name}") for name in tables],
    )
    outcome = asked.join(outcome, "request_id").select(
        *asked.columns, F.col("first.problem").alias("problem"), F.col("first.detail").alias("detail"),
        *[f"rows_{name}" for name in tables],
    )
    outcome = materialize(_stop_after_failed_year(outcome, endpoint), f"{endpoint.name}-outcome", folder)
    shared = {name: rows for name, rows in tables.items() if name in _SHARED_KEYS}
    if shared:
        outcome = _reject_key_conflicts(warehouse, endpoint, shared, outcome, folder)

    stored = outcome.filter(F.col("problem").isNull() & ~F.col("skipped"))
    slices = _slices(stored, endpoint)
    good_records = records_of(readable).join(stored.select("request_id"), "request_id", "left_semi")
    # Parents and children of the requests are replaced as one step.
    with warehouse.commit() as made:
        gone = {}
        for name, rows in tables.items():
            good = rows.join(stored.select("request_id"), "request_id", "left_semi")
            empty = slices.filter(F.col(f"rows_{name}").isNull())
            _store(made, endpoint, name, good, slices, empty, good_records, folder)
            if cascade and has_children(name) and endpoint.name not in _LAST_WINS:
                keys = materialize(keys_that_go(warehouse, name, good, slices), f"{name}-gone", folder)
                gone |= {} if keys.isEmpty() else {name: keys}
        stage_cascade(made, gone, folder, same_slice=True)
    return outcome.drop(*[f"rows_{name}" for name in tables])


def _reject_key_conflicts(
    warehouse: Warehouse, endpoint: Endpoint, tables: dict[str, DataFrame], outcome: DataFrame, folder: str
) -> DataFrame:
    """Of the requests that are good in themselves, rejects those whose keys another slice will hold.

    Only the slices of requests that are stored are replaced. A rejected request keeps its old slice, whose keys
    then stand against the others, so the check is repeated until nothing more is rejected. Keys that stored
    rows hold come first; only when none is left does the first of several requests with one key take it. A
    request that was rejected for its key does not come back, even if the other is rejected later.
    """
    number = 0
    while True:
        good = outcome.filter(F.col("problem").isNull() & ~F.col("skipped"))
        for failing in (_held_elsewhere, _sent_twice):
            conflicts = failing(warehouse, endpoint, tables, good)
            conflicts = materialize(conflicts, f"{endpoint.name}-conflicts-{number}-{failing.__name__}", folder)
            if not conflicts.isEmpty():
                break
        else:
            return outcome
        number += 1
        first = conflicts.groupBy("request_id").agg(F.min(F.struct("problem", "detail")).alias("conflict"))
        columns = [c for c in outcome.columns if c not in ("problem", "detail", "skipped")]
        outcome = outcome.join(first, "request_id", "left").select(
            *columns,
            F.coalesce("problem", "conflict.problem").alias("problem"),
            F.when(F.col("problem").isNull(), F.col("conflict.detail")).otherwise(F.col("detail")).alias("detail"),
        )
        outcome = materialize(_stop_after_failed_year(outcome, endpoint), f"{endpoint.name}-outcome-{number}", folder)


def _held_elsewhere(warehouse: Warehouse, endpoint: Endpoint, tables: dict[str, DataFrame], good: DataFrame) -> DataFrame:
    """Requests with a key that is stored outside the slices about to be replaced."""
    found = []
    for name, rows in tables.items():
        spec = TABLES[name]
        slices = _slices(good, endpoint).select(*spec.slice).distinct()
        stored = warehouse.read(name)
        if name == "Grades":
            # The key holds academy and year, so only their slices can hold it; the others' folders are not read.
            stored = stored.join(slices.select("Academy", "DataSet").distinct(), ["Academy", "DataSet"], "left_semi")
        elsewhere = stored.join(slices, list(spec.slice), "left_anti")
        own = rows.join(good.select("request_id"), "request_id", "left_semi")
        found.append(_failed(stored_key_failures(own, elsewhere, spec.key), "key held by another slice", name))
    return reduce(DataFrame.unionByName, found)


def _sent_twice(warehouse: Warehouse, endpoint: Endpoint, tables: dict[str, DataFrame], good: DataFrame) -> DataFrame:
    """Requests with a key that an earlier good request of the run brings too."""
    found = []
    for name, rows in tables.items():
        own = rows.join(good.select("request_id"), "request_id", "left_semi")
        found.append(_failed(shared_key_failures(own, TABLES[name].key), "duplicate key", name))
    return reduce(DataFrame.unionByName, found)


def _failed(requests: DataFrame, problem: str, table: str) -> DataFrame:
    return requests.select("request_id", F.lit(problem).alias("problem"), F.lit(table).alias("detail"))


def _store(
    made: Replacement, endpoint: Endpoint, name: str, rows: DataFrame, slices: DataFrame, empty: DataFrame,
    records: DataFrame, folder: str,
) -> None:
    if endpoint.name not in _LAST_WINS:
        made.replace_slices(name, rows, slices, empty)
        return
    key = _LAST_WINS[endpoint.name]
    sent = records.select(F.col("row.id").alias(key), "request_id")
    last = sent.groupBy(key).agg(F.max("request_id").alias("request_id"))
    rows = rows.join(last, [key, "request_id"], "left_semi")
    # Only the staff who were sent again are replaced; leavers stay, so no slice is emptied.
    whole_slices = endpoint.name != "staff"
    replaced = slices if whole_slices else slices.filter(F.lit(False))
    made.replace_by_id(name, rows, replaced, key, sent, whole_slices, folder)


def _report(endpoint: Endpoint, name: str, rows: DataFrame) -> DataFrame:
    """Requests with the number of rows they bring for a table, and the rule of their own that they break."""
    day = TABLES[name].slice[-1] if endpoint.scope == "day" else None
    problem = (
        F.when(F.col("undated"), "bad date")
        .when(F.col("long"), "text too long")
        .when(F.col("repeated"), "duplicate key")
        .when(F.col("stray"), "row of another day")
    )
    return request_report(rows, name, day).select(
        "request_id", problem.alias("problem"), F.lit(name).alias("detail"), "rows"
    )


def _slices(requests: DataFrame, endpoint: Endpoint) -> DataFrame:
    """The requests with the slice each covers, under every name a table may give its slice columns."""
    return requests.withColumns(
        {"EventDay": F.col("Date"), "AttributeGroup": F.lit(_GROUPS.get(endpoint.name)).cast("string")}
    )


def _stop_after_failed_year(outcome: DataFrame, endpoint: Endpoint) -> DataFrame:
    """Year groups after the first failed one of an academy are not stored and not logged."""
    if endpoint.scope != "year_group":
        return outcome.withColumn("skipped", F.lit(False))
    failed = outcome.filter(F.col("problem").isNotNull())
    first = failed.groupBy("Academy", "DataSet").agg(F.min("NCYear").alias("__failed_year"))
    marked = outcome.join(first, ["Academy", "DataSet"], "left")
    return marked.withColumn(
        "skipped", F.coalesce(F.col("NCYear") > F.col("__failed_year"), F.lit(False))
    ).select(*outcome.columns, "skipped")

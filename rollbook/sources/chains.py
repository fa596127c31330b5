"""Page chains without page numbers: the pages of a request are put in order by their cursors alone.

A page is asked for with the cursor its predecessor handed on; the first page is asked for without one. The order is
found by pointer doubling: every page starts out knowing its predecessor, and in each round takes over what its
predecessor knows, so the known distance doubles and a chain of n pages takes log2(n) rounds of one join, all requests
together, with no request gathered into one task. Where there are very many pages, most are taken out of their chains
beforehand, round by round, and put back afterwards. Pages that never reach a first page hang on a gap or run in a circle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.session import materialize, scratch_path

_LINK = "__link"
MAX_DOUBLED = 1 << 20  # pages that are placed by doubling; more are thinned out first


def numbered_chains(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """``pages`` with ``page_no`` worked out (any they have is replaced) and ``chain_problem``; one row per page.

    Needs ``request_id``, ``cursor_in``, ``cursor_out`` and ``has_more``. A problem is told on all pages concerned:

    * ``several first pages``: the request has more than one page without ``cursor_in``
    * ``fork``: two pages of the request were asked for with the same cursor, or hand on the same
    * ``circle or gap``: the page has no chain of predecessors back to a first page

    Pages with a problem have no number. A page handed on by a page that says there is no more counts as a gap. The
    rounds and the result are staged in ``folder``, which is the caller's to remove.
    """
    folder = folder or scratch_path(pages.sparkSession, "chains")
    kept = [c for c in pages.columns if c not in ("page_no", "chain_problem")]
    # Every stored page gets a name of its own.
    own = materialize(pages.select(*kept).withColumn(_LINK, F.monotonically_increasing_id()), "pages", folder)
    faults = _faults(own)
    placed = _distances(_predecessors(own, faults), folder)
    out = own.join(faults.withColumnRenamed("fault", "__fault"), "request_id", "left").join(placed, _LINK, "left")
    problem = F.coalesce(F.col("__fault"), F.when(F.col("__place").isNull(), "circle or gap"))
    out = out.select(*kept, F.when(problem.isNull(), F.col("__place")).cast("int").alias("page_no"), problem.alias("chain_problem"))
    return materialize(out, "numbered", folder)


def _faults(pages: DataFrame) -> DataFrame:
    """(request_id, fault) of requests whose pages cannot be in one line. Counted per cursor, then per request."""
    ends = pages.select("request_id", F.explode(F.array(
        F.struct(F.lit(True).alias("arrives"), F.col("cursor_in").alias("cursor")),
        F.struct(F.lit(False).alias("arrives"), F.when(F.col("has_more"), F.col("cursor_out")).alias("cursor")),
    )).alias("end"))
    uses = ends.groupBy("request_id", "end.arrives", "end.cursor").agg(F.count("*").alias("uses"))
    first = F.max(F.when(F.col("cursor").isNull() & F.col("arrives"), F.col("uses")))
    forked = F.bool_or(F.col("cursor").isNotNull() & (F.col("uses") > 1))
    found = uses.groupBy("request_id").agg(first.alias("first"), forked.alias("forked"))
    fault = F.when(F.col("first") > 1, "several first pages").when(F.col("forked"), "fork")
    return found.select("request_id", fault.alias("fault")).where(F.col("fault").isNotNull())


def _predecessors(pages: DataFrame, faults: DataFrame) -> DataFrame:
    """(page, before, steps): each page of a sound request with its predecessor; a first page is its own, at 0 steps."""
    sound = pages.join(faults.select("request_id"), "request_id", "left_anti")
    arrivals = sound.select("request_id", F.col("cursor_in").alias("cursor"), F.col(_LINK).alias("page"))
    departures = sound.where("has_more and cursor_out is not null").select(
        "request_id", F.col("cursor_out").alias("cursor"), F.col(_LINK).alias("before")
    )
    first = arrivals.where("cursor is null").select("page", F.col("page").alias("before"), F.lit(0).cast("bigint").alias("steps"))
    later = arrivals.join(departures, ["request_id", "cursor"]).select("page", "before", F.lit(1).cast("bigint").alias("steps"))
    return first.unionByName(later)


def _distances(known: DataFrame, folder: str) -> DataFrame:
    """(__link, __place): each page's number from 1, for those that reach a first page.

    Long lists are shortened first: each round takes out about a quarter of the pages, and those behind them point past
    them. So the rounds shrink, and together cost a few times the pages, not log2 of them. What is left is placed by
    doubling; then the pages taken out follow, the last first, each from the place of the page it pointed to.
    """
    known = materialize(known, "round0", folder)
    # A page that points to itself otherwise, now or after some rounds, is what is left of a circle and has no place.
    firsts, rest = known.where("page = before and steps = 0"), known.where("page <> before")
    taken: list[DataFrame] = []
    total = rest.count()
    while total > MAX_DOUBLED:
        number = len(taken)
        # A page goes if its own coin says so and that of the page ahead does not: no two neighbours go together.
        goes = _coin("page", number) & ~_coin("before", number)
        out = materialize(rest.where(goes), f"taken{number}", folder)
        stay = rest.where(~goes)
        past = out.select(F.col("page").alias("before"), F.col("before").alias("further"), F.col("steps").alias("more"))
        behind = stay.where(_coin("before", number)).join(past, "before", "left").select(
            "page", F.coalesce("further", "before").alias("before"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")
        )
        behind = behind.where("page <> before")
        rest = materialize(stay.where(~_coin("before", number)).unionByName(behind), f"short{number}", folder)
        taken.append(out)
        total = rest.count()
    if not taken:
        return _doubled(known, folder)
    # Of the first pages, which have number 1, only those still pointed to take part in the doubling.
    asked = firsts.join(rest.select(F.col("before").alias("page")).distinct(), "page", "left_semi").select(*known.columns)
    later = _doubled(materialize(rest.unionByName(asked), "rest", folder), folder).where("__place > 1")
    placed = firsts.select(F.col("page").alias(_LINK), F.lit(1).cast("bigint").alias("__place"))
    placed = placed.unionByName(materialize(later, "placed", folder))
    for number in reversed(range(len(taken))):
        ahead = placed.select(F.col(_LINK).alias("before"), "__place")
        more = taken[number].join(ahead, "before").select(F.col("page").alias(_LINK), (F.col("__place") + F.col("steps")).alias("__place"))
        placed = placed.unionByName(materialize(more, f"placed{number}", folder))
    return placed


def _coin(page: str, number: int) -> Column:
    return F.xxhash64(F.col(page), F.lit(number)) % 2 == 0


def _doubled(known: DataFrame, folder: str) -> DataFrame:
    """The same by pointer doubling alone.

    ``before`` is the page ``steps`` ahead. A page whose ``before`` is a first page is done. The others take over what
    that page knows; one whose ``before`` knows nothing hangs on a gap and is dropped. In a circle distances go on
    doubling past the number of pages, which ends the rounds.
    """
    total = known.count()
    rounds = 0
    while True:
        ahead = known.select(F.col("page").alias("before"), F.col("before").alias("further"), F.col("steps").alias("more"))
        joined = known.join(ahead, "before")
        moved = joined.select("page", F.col("further").alias("before"), (F.col("steps") + F.col("more")).alias("steps"))
        rounds += 1
        moved = materialize(moved, f"round{rounds}", folder)
        # A page is done if it has reached a first page: its own predecessor, at 0 steps. (In a circle steps grow.)
        firsts = moved.where("page = before and steps = 0").select(F.col("page").alias("before"))
        open_pages = moved.join(firsts, "before", "left_anti")
        if (1 << rounds) > total or open_pages.isEmpty():
            done = moved.join(firsts, "before", "left_semi")
            return done.select(F.col("page").alias(_LINK), (F.col("steps") + 1).alias("__place"))
        known = moved

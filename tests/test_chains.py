"""Putting pages in order by their cursors alone."""

import random

from pyspark.sql import functions as F

from rollbook.plans import jobs
from rollbook.session import scratch_path
from rollbook.sources import chains
from rollbook.sources.warehouse import Warehouse
from rollbook.streaming.rolling import requests_of
from tests.landed import page, pages
from tests.test_jobs import stored, subjects

SCHEMA = "request_id string, cursor_in bigint, cursor_out bigint, has_more boolean, place int, page_no string"


def chain(request, cursors):
    """Pages of one request: (request, cursor_in, cursor_out, has_more, place, something else called page_no)."""
    return [
        (request, cursors[k - 1] if k else None, c if k < len(cursors) - 1 else None, k < len(cursors) - 1, k + 1, "x")
        for k, c in enumerate(cursors)
    ]


def numbered(spark, rows):
    rng = random.Random(1)
    rows = rng.sample(rows, len(rows))
    found = chains.numbered_chains(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert found.columns == ["request_id", "cursor_in", "cursor_out", "has_more", "place", "page_no", "chain_problem"]
    return found


def test_long_and_short_chains(spark, interpreted):
    rng = random.Random(2)
    rows = chain("long", rng.sample(range(-(10**6), 10**6), 3000))
    for k in range(40):
        rows += chain(f"r{k}", rng.sample(range(10**6), 1 + k % 7))
    found = numbered(spark, rows)
    assert found.where("page_no = place and chain_problem is null").count() == len(rows)


def test_rounds_grow_with_the_logarithm(spark, interpreted, monkeypatch):
    made = []
    keep = chains.materialize
    monkeypatch.setattr(chains, "materialize", lambda df, name, folder: made.append(name) or keep(df, name, folder))
    numbered(spark, chain("r", list(range(1024))))
    assert sum(name.startswith("round") for name in made) <= 12


def test_faults_stay_with_their_request(spark, interpreted):
    good = chain("good", [5, 6, 7])
    gap = [r for r in chain("gap", [1, 2, 3, 4, 5]) if r[4] != 3]
    circle = [("circle", 1, 2, True, 1, ""), ("circle", 2, 3, True, 2, ""), ("circle", 3, 1, True, 3, "")]
    for size in (1, 2, 4, 8):
        circle += [(f"circle{size}", k or size, k + 1, True, k, "") for k in range(size)]
    fork = [*chain("fork", [1, 2, 3]), ("fork", 2, 9, True, 3, "")]
    meet = [*chain("meet", [1, 2, 3]), ("meet", 7, 2, True, 9, "")]
    two = [*chain("two", [1, 2]), ("two", None, None, False, 1, "")]
    stray = [*chain("stray", [1, 2]), ("stray", 8, None, False, 3, "")]
    ended = [("ended", None, 1, False, 1, ""), ("ended", 1, None, False, 2, "")]
    found = numbered(spark, good + gap + circle + fork + meet + two + stray + ended).collect()
    problems = {}
    for r in found:
        problems.setdefault(r.request_id, []).append((r.place, r.page_no, r.chain_problem))
    lost = "circle or gap"
    assert sorted(problems["good"]) == [(1, 1, None), (2, 2, None), (3, 3, None)]
    assert sorted(problems["gap"]) == [(1, 1, None), (2, 2, None), (4, None, lost), (5, None, lost)]
    assert sorted(problems["circle"]) == [(k, None, lost) for k in (1, 2, 3)]
    for size in (1, 2, 4, 8):
        assert sorted(problems[f"circle{size}"]) == [(k, None, lost) for k in range(size)]
    assert {p for _, n, p in problems["fork"]} == {"fork"} == {p for _, n, p in problems["meet"]}
    assert {(n, p) for _, n, p in problems["two"]} == {(None, "several first pages")}
    assert sorted(problems["stray"]) == [(1, 1, None), (2, 2, None), (3, None, lost)]
    assert sorted(problems["ended"]) == [(1, 1, None), (2, None, lost)]


def test_no_pages(spark, interpreted):
    assert chains.numbered_chains(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_sync_without_page_numbers(spark, interpreted):
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    whole = [page("subjects", {**subjects(k), "has_more": k < 4, **({"cursor": 90 - k} if k < 4 else {})}, cursor=None if k == 1 else 91 - k) for k in (1, 2, 3, 4)]
    broken = [page("subjects", {**subjects(k), "has_more": True, "cursor": 90 - k}, "B", cursor=91 - k) for k in (2, 3)]
    landed = pages(spark, *whole, *broken).withColumn("page_no", F.lit(None).cast("int"))
    log = jobs.sync_requests(warehouse, landed, requests_of(landed), ["subjects"], page_numbers=False)
    assert {(r.AcademyCode, r.Exception) for r in log.collect()} == {("A", None), ("B", "broken page chain")}
    assert len(stored(warehouse, "Subjects", "SubjectId")) == 4


def test_very_many_pages_are_thinned_out_first(spark, interpreted, monkeypatch):
    """The rounds shrink: together they write a few times the pages, not one copy for each doubling."""
    rows = chain("long", random.Random(5).sample(range(-(10**6), 10**6), 2000))
    gap = chain("gap", list(range(300)))
    rows += gap[:100] + gap[101:]
    circle = [("circle", (k - 1) % 200, k, True, k + 1, "x") for k in range(200)]
    rows += circle + [("self", 5, 5, True, 1, "x")]
    for k in range(40):
        rows += chain(f"r{k}", list(range(1 + k % 7)))
    placed = sorted(numbered(spark, rows).select("request_id", "place", "page_no", "chain_problem").collect(), key=str)
    made = {}
    keep = chains.materialize

    def counted(df, name, folder):
        kept = keep(df, name, folder)
        made[name] = kept.count()
        return kept

    monkeypatch.setattr(chains, "materialize", counted)
    monkeypatch.setattr(chains, "MAX_DOUBLED", 100)
    found = numbered(spark, rows).select("request_id", "place", "page_no", "chain_problem").collect()
    assert sorted(found, key=str) == placed
    assert all(r.page_no == r.place for r in found if r.request_id == "long")
    assert sum(n for name, n in made.items() if name not in ("pages", "numbered")) < 7 * len(rows)

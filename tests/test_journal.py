"""Runs that are stopped and made again."""

import pytest

from rollbook.plans import jobs
from rollbook.session import file_system, scratch_path
from rollbook.sources.journal import Journal
from rollbook.sources.warehouse import Warehouse
from rollbook.streaming.rolling import requests_of
from tests.landed import page, pages
from tests.test_commits import Killed, files
from tests.test_jobs import stored, subjects

ORDER = ["students", "departments", "subjects", "groups"]


@pytest.fixture
def warehouse(spark, interpreted):
    return Warehouse(spark, scratch_path(spark, "warehouse"))


def landed(spark):
    return pages(
        spark, page("students", {"students": [{"id": 1, "date_of_birth": "bad"}]}), page("departments", {"departments": [{"id": 1}]}),
        page("subjects", subjects(1)), page("groups", {"groups": [{"id": 1, "subject_id": 1}]}),
    )


def run(warehouse, name="night"):
    found = landed(warehouse.spark)
    return jobs.sync_requests(warehouse, found, requests_of(found), ORDER, run=name, parallel=1)


def stopped_at(monkeypatch, endpoint):
    """From this endpoint on nothing is done any more."""
    whole = jobs.parse_pages

    def dying(found, e):
        if ORDER.index(e.name) >= ORDER.index(endpoint):
            raise Killed
        return whole(found, e)

    monkeypatch.setattr(jobs, "parse_pages", dying)


def test_a_stopped_run_goes_on_with_the_rest(spark, warehouse, monkeypatch):
    stopped_at(monkeypatch, "subjects")
    with pytest.raises(Killed):
        run(warehouse)
    monkeypatch.undo()
    assert Journal(spark, warehouse.root, "night").finished() == ["departments", "students"]
    before = files(warehouse, "Departments")
    asked = []
    whole = jobs.parse_pages
    monkeypatch.setattr(jobs, "parse_pages", lambda found, e: asked.append(e.name) or whole(found, e))
    log = run(warehouse)
    assert asked == ["subjects", "groups"] and files(warehouse, "Departments") == before
    assert stored(warehouse, "Groups", "GroupId") == [("A2021-1",)]
    # Every request is logged once, those done before the stop as well, failures included.
    assert sorted((r.EndPoint.rsplit("/", 1)[-1], r.Exception) for r in log.collect()) == [
        ("departments", None), ("groups", None), ("students", "bad date"), ("subjects", None),
    ]
    assert warehouse.read("SyncResults").count() == 4
    fs, where = file_system(spark, f"{warehouse.root}/_runs/night")
    assert not fs.exists(where)


def test_a_run_that_ended_is_made_anew(warehouse, monkeypatch):
    run(warehouse)
    asked = []
    whole = jobs.parse_pages
    monkeypatch.setattr(jobs, "parse_pages", lambda found, e: asked.append(e.name) or whole(found, e))
    run(warehouse)
    assert asked == ORDER and warehouse.read("SyncResults").count() == 4


def test_another_run_does_not_go_on_with_it(warehouse, monkeypatch):
    stopped_at(monkeypatch, "groups")
    with pytest.raises(Killed):
        run(warehouse)
    monkeypatch.undo()
    run(warehouse, "other")
    assert warehouse.read("SyncResults").count() == 4
    run(warehouse)
    assert warehouse.read("SyncResults").count() == 8

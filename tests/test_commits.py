"""Jobs that die half-way, and which stored folders a replacement reads."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from rollbook.plans import jobs
from rollbook.session import remove, scratch_path
from rollbook.sources import commits
from rollbook.sources.warehouse import Warehouse
from rollbook.streaming.rolling import requests_of
from tests.landed import page, pages
from tests.test_jobs import D8, D9, events, stored, subjects, sync

D7 = date(2024, 1, 7)


class Killed(BaseException):
    """Not an error that a job may log: the process is gone."""


@pytest.fixture
def warehouse(spark, interpreted):
    return Warehouse(spark, scratch_path(spark, "warehouse"))


def files(warehouse, table):
    return sorted(f"{at}/{name}" for at, _, names in os.walk(warehouse.path(table)) for name in names if name.endswith(".parquet"))


def agree(warehouse):
    """Every event of these tests has students, and no student row is without its event."""
    return set(stored(warehouse, "BehEvents", "BehEventId")) == set(stored(warehouse, "BehEventStudents", "BehEventId"))


def test_a_job_killed_between_its_tables_is_finished_by_the_next(warehouse, monkeypatch):
    sync(warehouse, page("beh_events", events(D8, 1, 2), day=D8), page("beh_events", events(D9, 3), day=D9))
    put = commits._put

    def dying(spark, source, target):
        if "/BehEventStudents/" in target:
            raise Killed
        put(spark, source, target)

    monkeypatch.setattr(commits, "_put", dying)
    with pytest.raises(Killed):
        sync(warehouse, page("beh_events", events(D8, 4), day=D8), page("beh_events", events(D9), day=D9))
    monkeypatch.undo()
    assert not agree(warehouse)
    sync(warehouse, page("subjects", subjects(1)))
    assert stored(warehouse, "BehEvents", "BehEventId") == stored(warehouse, "BehEventStudents", "BehEventId") == [(4,)]
    assert warehouse.recover() == [] and not os.listdir(f"{warehouse.root}/{commits.FOLDER}")


def test_recovery_that_is_killed_goes_on(warehouse, monkeypatch):
    days = [date(2024, 1, d) for d in range(1, 7)]
    sync(warehouse, *[page("beh_events", events(d, k), day=d) for k, d in enumerate(days)])
    put, made = commits._put, []

    def dying(spark, source, target):
        made.append(target)
        if len(made) in (4, 8):
            raise Killed
        put(spark, source, target)

    monkeypatch.setattr(commits, "_RENAMES", 1)
    monkeypatch.setattr(commits, "_put", dying)
    with pytest.raises(Killed):
        sync(warehouse, *[page("beh_events", events(d, 10 + k), day=d) for k, d in enumerate(days)])
    with pytest.raises(Killed):
        warehouse.recover()
    assert len(warehouse.recover()) == 1
    assert stored(warehouse, "BehEvents", "BehEventId") == stored(warehouse, "BehEventStudents", "BehEventId") == [(10 + k,) for k in range(6)]


def test_a_job_killed_before_its_record_has_changed_nothing(warehouse, monkeypatch):
    sync(warehouse, page("beh_events", events(D8, 1, 2), day=D8))
    before = files(warehouse, "BehEvents"), files(warehouse, "BehEventStudents")

    def dying(spark, path, text):
        raise Killed

    monkeypatch.setattr(commits, "_write", dying)
    with pytest.raises(Killed):
        sync(warehouse, page("beh_events", events(D8, 3), day=D8))
    monkeypatch.undo()
    assert warehouse.recover() == []
    assert before == (files(warehouse, "BehEvents"), files(warehouse, "BehEventStudents"))
    assert agree(warehouse) and not os.listdir(f"{warehouse.root}/{commits.FOLDER}")


def test_replacements_of_a_failing_body_are_undone(warehouse):
    sync(warehouse, page("subjects", subjects(1, 2)))
    old = warehouse.read("Subjects")
    with pytest.raises(ValueError, match="staged already"), warehouse.commit() as made:
        made.replace_slices("Subjects", old.limit(1), old.select("Academy", "DataSet"))
        made.replace_slices("Subjects", old.limit(1), old.select("Academy", "DataSet"))
    assert len(stored(warehouse, "Subjects", "SubjectId")) == 2


def test_only_slices_that_hold_a_sent_id_are_read(warehouse):
    far = [page("beh_events", events(D7, 100 + k), f"F{k}", day=D7) for k in range(4)]
    sync(warehouse, *far, page("beh_events", events(D8, 1, 2), day=D8))
    # Whoever opened one of these would fail.
    for table in ("BehEvents", "BehEventStudents"):
        for path in files(warehouse, table):
            if "Academy=F" in path:
                with open(path, "wb") as out:
                    out.write(b"not a table")
                checksum = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
                if os.path.exists(checksum):
                    os.remove(checksum)
    log = sync(warehouse, page("beh_events", events(D9, 2, 3), day=D9))
    assert log == {("A", None, D9): (True, None)}
    kept = warehouse.read_slices("BehEvents", warehouse.spark.createDataFrame([("A", "2021", d) for d in (D8, D9)], "Academy string, DataSet string, EventDay date").collect())
    assert sorted((r.BehEventId, r.EventDay) for r in kept.collect()) == [(1, D8), (2, D9), (3, D9)]


def test_a_warehouse_without_an_index_gets_one(warehouse):
    sync(warehouse, page("beh_events", events(D8, 1, 2), day=D8))
    remove(warehouse.spark, f"{warehouse.root}/_ids")
    sync(warehouse, page("beh_events", events(D9, 2, -5, 1 << 40), day=D9))
    assert stored(warehouse, "BehEvents", "BehEventId", "EventDay") == [(-5, D9), (1, D8), (2, D9), (1 << 40, D9)]
    spans = {r["span"] for r in warehouse.ids("BehEvents").read().select("span").distinct().collect()}
    assert spans == {-1, 0, 1 << 20}


def test_the_index_is_compacted_to_what_is_stored(warehouse):
    for day in (D7, D8, D9, D8):
        sync(warehouse, page("beh_events", events(day, 1, 7), day=day))
    index = warehouse.ids("BehEvents")
    assert len(stored_entries(index)) == 6
    assert index.compact(warehouse.read("BehEvents"), most_files=100) == 0
    assert index.compact(warehouse.read("BehEvents"), most_files=1) == 1
    assert stored_entries(index) == [(1, "A", "2021", D8), (7, "A", "2021", D8)]
    sync(warehouse, page("beh_events", events(D8), day=D8))
    index.add(warehouse.read("BehEvents"))
    remove(warehouse.spark, warehouse.path("BehEvents"))
    assert index.compact(warehouse.read("BehEvents"), most_files=0) == 1 and stored_entries(index) == []


def stored_entries(index):
    return sorted(tuple(r) for r in index.read().drop("span").collect())


def test_ids_of_many_ranges_are_looked_up_by_first_and_last(warehouse, monkeypatch):
    from rollbook.sources import idindex

    sync(warehouse, page("beh_events", events(D8, *[k << 20 for k in range(5)]), day=D8))
    monkeypatch.setattr(idindex, "MAX_NAMED", 2)
    ids = warehouse.spark.range(5).select(F.shiftleft("id", 20).alias("BehEventId")).where("BehEventId > 0")
    assert warehouse.ids("BehEvents").slices_of(ids).count() == 4


def test_a_run_goes_on_after_a_killed_one(spark, warehouse, monkeypatch):
    """The whole job again: the same pages end in the same tables."""
    landed = pages(spark, page("subjects", subjects(1)), page("beh_events", events(D8, 1), day=D8))
    put = commits._put

    def dying(spark, source, target):
        raise Killed

    monkeypatch.setattr(commits, "_put", dying)
    with pytest.raises(Killed):
        jobs.sync_requests(warehouse, landed, requests_of(landed), ["subjects", "beh_events"], run="r")
    monkeypatch.setattr(commits, "_put", put)
    jobs.sync_requests(warehouse, landed, requests_of(landed), ["subjects", "beh_events"], run="r")
    assert agree(warehouse) and stored(warehouse, "Subjects", "SubjectId") == [("A2021-1",)]
    assert warehouse.read("SyncResults").count() == 2

"""Deletes that run down the foreign keys of a stored warehouse."""

import os

import pytest
from pyspark.sql import functions as F

from rollbook.operators.replace import cascade_delete
from rollbook.plans import cascades, jobs
from rollbook.schemas.tables import TABLES
from rollbook.session import scratch_path
from rollbook.sources import commits
from rollbook.sources.warehouse import Warehouse
from rollbook.streaming.rolling import requests_of
from standins.relations import RELATIONS
from standins.stored import store
from tests.landed import page, pages
from tests.test_commits import Killed, files
from tests.test_jobs import stored, subjects

BELOW = [n for n in ("Students", *[t for t in RELATIONS if t in TABLES and t != "Students"]) if n == "Students" or any(p.table in ("Students", "EducationDetails") for p in TABLES[n].parents)]


@pytest.fixture
def warehouse(spark, interpreted):
    return Warehouse(spark, scratch_path(spark, "warehouse"))


def rows(df):
    return sorted(map(str, df.collect()))


def test_the_stored_cascade_is_the_cascade(warehouse, standins):
    store(warehouse, standins, BELOW)
    before = {name: warehouse.read(name) for name in BELOW}
    gone = before["Students"].where("Academy='A1' and DataSet='2020' and Sex='F'").select("StudentId")
    expected = {name: rows(df) for name, df in cascade_delete(before, "Students", gone).items()}
    held = {name: {f: os.stat(f).st_mtime_ns for f in files(warehouse, name)} for name in BELOW}
    gone = warehouse.spark.createDataFrame(gone.collect(), gone.schema)
    written = cascades.delete_stored(warehouse, "Students", gone)
    assert written["Students"] == 1 and len(written) > 4
    for name in BELOW:
        assert rows(warehouse.read(name)) == expected[name], name
        # Folders without doomed rows keep their files.
        kept = [f for f in files(warehouse, name) if f in held[name]]
        assert all(os.stat(f).st_mtime_ns == held[name][f] for f in kept)
        changed = {os.path.dirname(f) for f in held[name]} - {os.path.dirname(f) for f in kept}
        assert len(changed) == written.get(name, 0)


def test_deeper_levels_and_keys_of_one_place(warehouse, standins):
    names = ["Departments", "Subjects", "Groups", "Marksheets", "Markslots", "MarkslotMarks", "GroupTeachers"]
    store(warehouse, standins, names)
    gone = warehouse.spark.createDataFrame(warehouse.read("Departments").where("Academy='A2'").select("DepartmentId").limit(7).collect(), "DepartmentId string")
    expected = {n: rows(df) for n, df in cascade_delete({n: warehouse.read(n) for n in names}, "Departments", gone).items()}
    assert cascades.delete_stored(warehouse, "Departments", gone, same_slice=True)["MarkslotMarks"] > 0
    assert {n: rows(warehouse.read(n)) for n in names} == expected


def test_a_killed_cascade_is_finished(warehouse, standins, monkeypatch):
    store(warehouse, standins, ["Departments", "Subjects", "Marksheets"])
    gone = warehouse.spark.createDataFrame(warehouse.read("Departments").select("DepartmentId").limit(9).collect(), "DepartmentId string")
    put = commits._put

    def dying(spark, source, target):
        if "/Marksheets/" in target:
            raise Killed
        put(spark, source, target)

    monkeypatch.setattr(commits, "_put", dying)
    with pytest.raises(Killed):
        cascades.delete_stored(warehouse, "Departments", gone)
    monkeypatch.undo()
    warehouse.recover()
    subjects_left = warehouse.read("Subjects").select("SubjectId")
    assert warehouse.read("Subjects").join(gone, "DepartmentId", "left_semi").isEmpty()
    assert warehouse.read("Marksheets").join(subjects_left, "SubjectId", "left_anti").isEmpty()


def test_nothing_to_delete(warehouse, standins):
    assert cascades.delete_stored(warehouse, "Students", warehouse.spark.createDataFrame([], "StudentId string")) == {}


def test_a_sync_takes_along_what_hangs_on_rows_that_do_not_come_back(spark, warehouse):
    sheets = {"markbooks": [{"id": s, "marksheets": [{"id": s, "name": "m", "markslots": [{"id": s, "name": "l", "max": 3}]}]} for s in (1, 2)], "has_more": False}
    groups = {"groups": [{"id": 10 + s, "name": "g", "code": "c", "subject_id": s} for s in (1, 2)], "has_more": False}
    first = pages(spark, page("subjects", subjects(1, 2)), page("groups", groups), page("markbooks", sheets), page("subjects", subjects(1), "B"))
    jobs.sync_requests(warehouse, first, requests_of(first), ["subjects", "groups", "markbooks"])
    assert len(stored(warehouse, "Markslots", "MarkslotId")) == 2
    again = pages(spark, page("subjects", subjects(2, 3)))
    jobs.sync_requests(warehouse, again, requests_of(again), ["subjects"], cascade=True)
    assert stored(warehouse, "Subjects", "SubjectId") == [("A2021-2",), ("A2021-3",), ("B2021-1",)]
    for table, key in (("Groups", "SubjectId"), ("Marksheets", "SubjectId")):
        assert stored(warehouse, table, key) == [("A2021-2",)]
    assert stored(warehouse, "Markslots", "MarkslotId") == [("A2021-2",)]
    assert warehouse.read("Subjects").where(F.col("Academy") == "B").count() == 1

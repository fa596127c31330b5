"""Slices that share folders, since there are too many for one each: the same jobs store the same rows."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from rollbook.schemas.tables import TABLES
from rollbook.session import scratch_path
from rollbook.sources import commits, layout
from rollbook.sources.warehouse import Warehouse
from tests import test_cascades, test_commits, test_jobs, test_lookups
from tests.landed import page
from tests.test_commits import Killed
from tests.test_jobs import D8, D9, events, stored, subjects, sync

DAYS = [date(2024, m, d) for m in (1, 2) for d in range(1, 9)]


@pytest.fixture
def warehouse(spark, interpreted):
    return Warehouse(spark, scratch_path(spark, "warehouse"))


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(layout, "MAX_FOLDERS", 4)


@pytest.fixture
def none(monkeypatch):
    monkeypatch.setattr(layout, "MAX_FOLDERS", 0)


def folders(warehouse, table):
    return sorted({os.path.relpath(os.path.dirname(f), warehouse.path(table)) for f in test_commits.files(warehouse, table)})


@pytest.mark.parametrize("scenario", [
    test_jobs.test_slices_are_replaced_and_others_stay, test_jobs.test_an_empty_answer_empties_the_slice,
    test_jobs.test_slice_names_with_special_characters, test_jobs.test_an_event_sent_again_leaves_its_old_place,
    test_commits.test_a_warehouse_without_an_index_gets_one,
], ids=lambda f: f.__name__)
def test_jobs_on_shared_folders(warehouse, none, scenario):
    scenario(warehouse)


def test_cascades_on_shared_folders(warehouse, standins, none):
    test_cascades.test_deeper_levels_and_keys_of_one_place(warehouse, standins)
    assert warehouse.shared("MarkslotMarks")


def test_look_ups_on_shared_folders(spark, warehouse, none):
    test_lookups.test_kept_look_ups_follow_replaced_and_emptied_slices(spark, warehouse)
    assert layout.shared(spark, f"{warehouse.root}/_lookups/AttributeValues")


def test_look_ups_move_with_their_values(spark, warehouse, few):
    first = test_lookups.random_values(spark, 1, ["A"])
    types = first.select("AttributeTypeId", *test_lookups.SLICE).distinct().withColumns(
        {"AttributeName": F.lit("n"), "SourceAttributeId": F.lit(1).cast("long"), "Code": F.lit("c"), "IsSystem": F.lit(False)})
    warehouse.replace_slices("AttributeTypes", types, types)
    warehouse.replace_slices("AttributeValues", first, first)
    test_lookups.agree(warehouse)
    more = test_lookups.random_values(spark, 2, ["B", "C"])
    warehouse.replace_slices("AttributeValues", more, more)
    assert layout.shared(spark, f"{warehouse.root}/_lookups/AttributeValues")
    test_lookups.agree(warehouse)


def test_many_slices_share_few_folders_and_few_keep_their_own(warehouse, few):
    sync(warehouse, *[page("subjects", subjects(k), f"A{k}") for k in range(4)])
    assert len(folders(warehouse, "Subjects")) == 4 and not warehouse.shared("Subjects")
    sync(warehouse, *[page("beh_events", events(d, 10 * k), day=d) for k, d in enumerate(DAYS)])
    assert [f.split("/")[1:] for f in folders(warehouse, "BehEvents")] == [["DataSet=2021", "month=2024-01"], ["DataSet=2021", "month=2024-02"]]
    at = {f: os.stat(f).st_mtime_ns for f in test_commits.files(warehouse, "BehEvents")}
    sync(warehouse, page("beh_events", events(DAYS[0], 7), day=DAYS[0]), page("beh_events", events(DAYS[1]), day=DAYS[1]))
    left = sorted([(7, DAYS[0])] + [(10 * k, d) for k, d in enumerate(DAYS) if k > 1])
    assert stored(warehouse, "BehEvents", "BehEventId", "EventDay") == left
    assert stored(warehouse, "BehEventStudents", "BehEventId", "EventDay") == left
    # The other month's folder is as it was.
    assert sum(os.path.exists(f) and os.stat(f).st_mtime_ns == t for f, t in at.items()) == 1
    sync(warehouse, *[page("beh_events", events(d), day=d) for d in DAYS])
    assert stored(warehouse, "BehEvents", "BehEventId") == [] and folders(warehouse, "BehEvents") == []


def test_a_table_that_outgrows_its_folders_moves_and_a_killed_move_is_finished(warehouse, few, monkeypatch):
    sync(warehouse, *[page("subjects", subjects(k), f"A{k}") for k in range(4)])
    put = commits._put

    def dying(spark, source, target):
        if "/Subjects/" in target:
            raise Killed
        put(spark, source, target)

    monkeypatch.setattr(commits, "_put", dying)
    with pytest.raises(Killed):
        sync(warehouse, page("subjects", subjects(7), "B"), page("subjects", subjects(8), "A1"), page("subjects", subjects(), "A2"))
    monkeypatch.setattr(commits, "_put", put)
    warehouse.recover()
    assert warehouse.shared("Subjects")
    assert stored(warehouse, "Subjects", "SubjectId") == [("A02021-0",), ("A12021-8",), ("A32021-3",), ("B2021-7",)]
    assert all(f.startswith("part=") for f in folders(warehouse, "Subjects"))
    rows = warehouse.read_slices("Subjects", warehouse.spark.createDataFrame([("A1", "2021"), ("x", "2021")], "Academy string, DataSet string").collect())
    assert [r.SubjectId for r in rows.collect()] == ["A12021-8"]


def test_slices_without_a_stored_row_are_not_removed_one_by_one(warehouse, monkeypatch):
    """A first run of many empty answers has nothing to remove."""
    removed = []
    monkeypatch.setattr(commits, "remove", lambda spark, path: removed.append(path))
    sync(warehouse, *[page("subjects", subjects(), f"A{k}") for k in range(5)])
    assert not [p for p in removed if "/Subjects/" in p]


def test_null_slices_share_a_folder_too(spark, warehouse, none):
    schema = TABLES["GradeNames"].storage_schema
    rows = spark.createDataFrame([tuple({"Academy": a, "DataSet": "2021", "NCYear": y, "Name": n}.get(f.name) for f in schema) for a, y, n in (("A", None, "x"), ("A", 1, "y"))], schema)
    warehouse.replace_slices("GradeNames", rows, rows)
    again = rows.where("NCYear is null").withColumn("Name", F.lit("z"))
    warehouse.replace_slices("GradeNames", again, again)
    assert sorted(r.Name for r in warehouse.read("GradeNames").collect()) == ["y", "z"]


def test_days_of_one_month_and_academies_of_one_number_share(spark):
    rows = spark.createDataFrame([("A", "2021", D8), ("A", "2021", D9)], "Academy string, DataSet string, EventDay date")
    slice = TABLES["BehEvents"].slice
    assert layout.placed(rows, slice).select(*layout.folder_columns(slice)).distinct().count() == 1

"""Whole sync runs on hand-written pages: what is stored, what is kept, what is logged."""

from datetime import date, datetime

import pytest

from rollbook.plans import jobs, reports
from rollbook.plans.requests import plan_endpoints
from rollbook.schemas.endpoints import ENDPOINTS
from rollbook.session import file_system, scratch_path
from rollbook.sources.landing import land
from rollbook.sources.warehouse import Warehouse
from rollbook.streaming.rolling import requests_of, rolling_sync
from standins.pages import RECORDS, pages as standin_pages
from tests.landed import config, page, pages

D8, D9 = date(2024, 1, 8), date(2024, 1, 9)


@pytest.fixture
def warehouse(spark, interpreted):
    return Warehouse(spark, scratch_path(spark, "warehouse"))


def sync(warehouse, *landed, endpoints=None):
    """Sync exactly the requests that the pages answer."""
    found = pages(warehouse.spark, *landed)
    names = endpoints or sorted({row[-1] for row in landed})
    log = jobs.sync_requests(warehouse, found, requests_of(found), names)
    return {(r.AcademyCode, r.YearGroup, r.Date): (r.Result, r.Exception) for r in log.collect()}


def stored(warehouse, table, *columns):
    return sorted(tuple(r) for r in warehouse.read(table).select(*columns).collect())


def subjects(*ids, name="n"):
    return {"subjects": [{"id": i, "name": f"{name}{i}"} for i in ids], "has_more": False}


def test_slices_are_replaced_and_others_stay(warehouse):
    sync(warehouse, page("subjects", subjects(1, 2), "A"), page("subjects", subjects(3), "B"),
         page("subjects", subjects(1), "A", "2020"))
    twice = [sync(warehouse, page("subjects", subjects(2, 4, name="new"), "A")) for _ in range(2)]
    assert twice[0] == twice[1] == {("A", None, None): (True, None)}
    assert stored(warehouse, "Subjects", "SubjectId", "Name") == [
        ("A2020-1", "n1"), ("A2021-2", "new2"), ("A2021-4", "new4"), ("B2021-3", "n3"),
    ]


def test_an_empty_answer_empties_the_slice(warehouse):
    sync(warehouse, page("subjects", subjects(1), "A"), page("subjects", subjects(1), "B"))
    sync(warehouse, page("subjects", subjects(), "A"))
    assert stored(warehouse, "Subjects", "SubjectId") == [("B2021-1",)]


def test_slice_names_with_special_characters(warehouse):
    sync(warehouse, page("subjects", subjects(1), "A/B=1 %"))
    assert stored(warehouse, "Subjects", "Academy") == [("A/B=1 %",)]
    sync(warehouse, page("subjects", subjects(), "A/B=1 %"))
    assert stored(warehouse, "Subjects", "Academy") == []


BAD = {
    "bad date": {"students": [{"id": 1, "date_of_birth": "x"}]},
    "text too long": {"students": [{"id": 1, "date_of_birth": "2010-01-01T00:00:00Z", "sex": "FF"}]},
    "duplicate key": {"students": [{"id": 1, "date_of_birth": "2010-01-01T00:00:00Z"}] * 2},
    "unreadable page": {"has_more": False},
    "broken page chain": {"students": [], "has_more": True, "cursor": 4},
}


def test_a_bad_request_keeps_its_old_slice_and_stops_no_other(warehouse):
    good = {"students": [{"id": 7, "date_of_birth": "2011-02-03T00:00:00Z", "sex": "F"}]}
    sync(warehouse, page("students", good, "Good"), *[page("students", good, f"A{i}") for i in range(len(BAD))])
    better = {"students": [{"id": 8, "date_of_birth": "2011-02-03T00:00:00Z", "sex": "F"}]}
    log = sync(
        warehouse, page("students", better, "Good"),
        *[page("students", body, f"A{i}") for i, body in enumerate(BAD.values())],
    )
    assert log.pop(("Good", None, None)) == (True, None)
    assert log == {(f"A{i}", None, None): (False, problem) for i, problem in enumerate(BAD)}
    assert stored(warehouse, "Students", "StudentId") == [
        *[(f"A{i}2021-7",) for i in range(len(BAD))], ("Good2021-8",),
    ]


def test_a_failed_year_group_stops_the_later_ones(warehouse):
    def grades(*types):
        return {"GradesTypes": [{"id": t, "name": "g"} for t in types]}

    log = sync(
        warehouse, page("grade_names", grades(1), "A", year=0), page("grade_names", "junk", "A", year=9),
        page("grade_names", grades(1), "A", year=10), page("grade_names", grades(2), "B", year=10),
    )
    assert log == {
        ("A", 0, None): (True, None), ("A", 9, None): (False, "unreadable page"), ("B", 10, None): (True, None),
    }
    assert stored(warehouse, "GradeNames", "GradeNameId") == [("A2021-Reception-1",), ("B2021-10-2",)]


def marks(day, *students, session="AM"):
    return {"StudentSessionMarks": [
        {"student_id": s, "date": f"{day}T00:00:00", "session": session, "session_mark_id": 1} for s in students
    ]}


def test_days_are_replaced_one_by_one(warehouse):
    sync(warehouse, page("session_marks", marks(D8, 1, 2), day=D8), page("session_marks", marks(D9, 1), day=D9))
    sync(warehouse, page("session_marks", marks(D8, 3), day=D8))
    assert stored(warehouse, "StudentSessionMarks", "Date", "StudentId") == [(D8, "A2021-3"), (D9, "A2021-1")]
    log = sync(warehouse, page("session_marks", marks(D9, 5), day=D8))
    assert log == {("A", None, D8): (False, "row of another day")}
    assert len(stored(warehouse, "StudentSessionMarks", "Date")) == 2


def events(day, *ids, students=(1,)):
    return {"behaviour_events": [
        {"id": i, "event_date": f"{day}T11:00:00Z", "student_ids": students and list(students)} for i in ids
    ]}


def test_an_event_sent_again_leaves_its_old_place(warehouse):
    sync(warehouse, page("beh_events", events(D8, 1, 2, 3), day=D8), page("beh_events", events(D8, 9), "B", day=D8))
    # Event 2 has moved to the next day, event 9 to another academy; event 3 comes without a student list.
    sync(warehouse, page("beh_events", events(D9, 2, 9, students=(4, 5)), day=D9))
    assert stored(warehouse, "BehEvents", "BehEventId", "Academy", "EventDay") == [
        (1, "A", D8), (2, "A", D9), (3, "A", D8), (9, "A", D9),
    ]
    assert stored(warehouse, "BehEventStudents", "BehEventId", "StudentId") == [
        (1, "A2021-1"), (2, "A2021-4"), (2, "A2021-5"), (3, "A2021-1"), (9, "A2021-4"), (9, "A2021-5"),
    ]
    sync(warehouse, page("beh_events", events(D9, 3, students=None), day=D9))
    assert stored(warehouse, "BehEvents", "BehEventId") == [(1,)]
    assert stored(warehouse, "BehEventStudents", "BehEventId") == [(1,)]


def test_staff_who_left_stay_and_the_last_academy_wins(warehouse):
    def staff(title, *ids):
        return {"staff": [{"id": i, "title": title} for i in ids]}

    sync(warehouse, page("staff", staff("old", 1, 2), "A"), page("staff", staff("old", 3), "B"))
    sync(warehouse, page("staff", staff("a", 1, 3, 4), "A"), page("staff", staff("b", 4), "B"))
    assert stored(warehouse, "Staff", "StaffId", "Academy", "Title") == [
        (1, "A", "a"), (2, "A", "old"), (3, "A", "a"), (4, "B", "b"),
    ]


def test_plain_keys_of_another_slice_are_refused(warehouse):
    body = {"classification": [{"id": 1, "name": "x"}]}
    sync(warehouse, page("beh_classifications", body, "A"))
    log = sync(warehouse, page("beh_classifications", body, "B"))
    assert log == {("B", None, None): (False, "key held by another slice")}
    assert stored(warehouse, "BehClassifications", "Academy") == [("A",)]


def classifications(*ids):
    return {"classification": [{"id": i, "name": "x"} for i in ids]}


def test_a_failed_request_keeps_its_keys(warehouse):
    sync(warehouse, page("beh_classifications", classifications(1), "A"))
    log = sync(
        warehouse, page("beh_classifications", "junk", "A"), page("beh_classifications", classifications(1, 2), "B"),
        page("beh_classifications", classifications(3), "C"),
    )
    assert log == {
        ("A", None, None): (False, "unreadable page"), ("B", None, None): (False, "key held by another slice"),
        ("C", None, None): (True, None),
    }
    assert stored(warehouse, "BehClassifications", "Academy", "BehClassificationId") == [("A", 1), ("C", 3)]


def test_a_rejected_request_brings_its_old_slice_back(warehouse):
    sync(warehouse, *[page("beh_classifications", classifications(i), a) for i, a in ((1, "A"), (2, "B"), (3, "C"))])
    # C takes B's key, B takes A's, and A's new page can't be read: A keeps 1, so B keeps 2, so C keeps 3.
    log = sync(
        warehouse, page("beh_classifications", "junk", "A"), page("beh_classifications", classifications(1), "B"),
        page("beh_classifications", classifications(2), "C"),
    )
    assert [ok for ok, _ in log.values()] == [False, False, False]
    assert stored(warehouse, "BehClassifications", "Academy", "BehClassificationId") == [("A", 1), ("B", 2), ("C", 3)]


def test_a_request_that_fails_by_itself_holds_no_key(warehouse):
    log = sync(
        warehouse, page("beh_classifications", classifications(5, 5), "A"),
        page("beh_classifications", classifications(5), "B"),
    )
    assert log == {("A", None, None): (False, "duplicate key"), ("B", None, None): (True, None)}
    assert stored(warehouse, "BehClassifications", "Academy") == [("B",)]


def test_keys_may_move_between_replaced_slices(warehouse):
    sync(warehouse, page("beh_classifications", classifications(1), "A"), page("beh_classifications", classifications(2), "B"))
    log = sync(warehouse, page("beh_classifications", classifications(2), "A"), page("beh_classifications", classifications(1), "B"))
    assert all(ok for ok, _ in log.values())
    assert stored(warehouse, "BehClassifications", "Academy", "BehClassificationId") == [("A", 2), ("B", 1)]


def test_an_endpoint_that_breaks_off_stops_no_other(spark, warehouse, monkeypatch):
    whole = jobs.parse_pages

    def breaking(landed, endpoint):
        if endpoint.name == "departments":
            raise RuntimeError("x" * 6000)
        return whole(landed, endpoint)

    monkeypatch.setattr(jobs, "parse_pages", breaking)
    used = []
    monkeypatch.setattr(jobs, "scratch_path", lambda s, name: used.append(scratch_path(s, name)) or used[-1])
    log = sync(warehouse, page("departments", {"departments": [{"id": 1}]}), page("subjects", subjects(1), "B"))
    assert log == {("A", None, None): (False, "endpoint failed"), ("B", None, None): (True, None)}
    # The whole text of the error is logged, and nothing stays staged.
    inner = [r.InnerException for r in warehouse.read("SyncResults").filter("not Result").collect()]
    assert inner == ["RuntimeError: " + "x" * 6000]
    fs, where = file_system(spark, used[0])
    assert not fs.exists(where)


def test_a_run_made_again_replaces_its_log(spark, warehouse):
    found = pages(spark, page("subjects", subjects(1)))
    for _ in range(2):
        jobs.sync_requests(warehouse, found, requests_of(found), ["subjects"], run="one")
    jobs.sync_requests(warehouse, found, requests_of(found), ["subjects"], run="two")
    assert warehouse.read("SyncResults").count() == 2


def test_attribute_groups_share_a_table(warehouse):
    def types(name):
        return {"students_and_attributes": [{"id": 1, "name": name, "students_and_attribute_values": [
            {"student_id": 2, "value": name}]}]}

    sync(warehouse, page("general_attributes", types("g")), page("send_attributes", types("s")))
    sync(warehouse, page("send_attributes", types("t")))
    assert stored(warehouse, "AttributeTypes", "AttributeTypeId", "AttributeName") == [
        ("A2021-General-1", "g"), ("A2021-Send-1", "t"),
    ]
    assert stored(warehouse, "AttributeValues", "Value") == [("g",), ("t",)]


def test_the_newest_landing_counts(warehouse):
    old = page("subjects", subjects(1, 2), fetched=datetime(2024, 5, 1))
    new = page("subjects", subjects(3), fetched=datetime(2024, 5, 2))
    sync(warehouse, new, old)
    assert stored(warehouse, "Subjects", "SubjectId") == [("A2021-3",)]


def test_pages_may_come_in_several_batches(spark, warehouse):
    folder, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    first = page("subjects", {**subjects(1), "has_more": True, "cursor": 5})
    second = page("subjects", subjects(2), page_no=2, cursor=5)
    for part in (first, second):
        land(pages(spark, part), folder)
        rolling_sync(warehouse, folder, checkpoint, ["subjects"]).awaitTermination()
    assert stored(warehouse, "Subjects", "SubjectId") == [("A2021-1",), ("A2021-2",)]
    log = [r.Result for r in warehouse.read("SyncResults").orderBy("LoggedAt").collect()]
    assert log == [False, True]


def test_modes_and_plan(spark, warehouse):
    academies = config(spark, "A")
    landed = pages(
        spark, page("attendance_codes", {"AttendanceCodes": [{"id": 1}]}),
        page("session_marks", marks(D8, 1), day=D8), page("session_marks", marks(D9, 1), day=D9),
        page("beh_events", events(D9, 1), day=D9),
    )
    log = jobs.attendance_sync(warehouse, landed, academies, date(2024, 1, 20))
    results = {(r.EndPoint.rsplit("academic-years/{academicYear}/")[-1], r.Date): r.Exception for r in log.collect()}
    assert results == {
        ("attendance/student-session-summary", None): "no page landed",
        ("attendance/codes", None): None,
        ("attendance/student-lesson-marks/date/{date}", D8): "no page landed",
        ("attendance/student-lesson-marks/date/{date}", D9): "no page landed",
        ("attendance/student-session-marks/date/{date}", D8): None,
        ("attendance/student-session-marks/date/{date}", D9): None,
    }
    assert stored(warehouse, "BehEvents", "BehEventId") == []
    jobs.behaviour_sync(warehouse, landed, academies, date(2024, 1, 20))
    assert stored(warehouse, "BehEvents", "BehEventId") == [(1,)]


def test_back_fill_touches_one_year(spark, warehouse):
    landed = pages(spark, page("departments", {"departments": [{"id": 1}]}, dataset="2019"),
                   page("departments", {"departments": [{"id": 1}]}))
    jobs.run_sync(warehouse, landed, config(spark, "A"), D8, ("teaching",), dataset="2019")
    assert stored(warehouse, "Departments", "DataSet") == [("2019",)]


def test_reversed_windows_and_inactive_academies_ask_for_nothing(spark):
    window = config(spark, "A", AttendanceFrom=D9, AttendanceTo=D8, LowestYear=3, HighestYear=2)
    cut = [ENDPOINTS["session_marks"], ENDPOINTS["grades"]]
    assert plan_endpoints(window, D8, cut).count() == 0
    assert plan_endpoints(config(spark, "A", Active=False), D8, ENDPOINTS.values()).count() == 0


def test_full_sync_of_every_endpoint(spark, warehouse, standins):
    """All endpoints from the test tables; slices that the made-up pages cannot fill are reported, none is lost."""
    landed = None
    for name in RECORDS:
        made = standin_pages(standins, name).filter("Academy='A1' and DataSet='2021'")
        landed = made if landed is None else landed.unionByName(made)
    # One record per page: number the pages of a request and link them, as the source would.
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    order = Window.partitionBy("request_id").orderBy("body")
    last = F.row_number().over(order) == F.count("*").over(Window.partitionBy("request_id"))
    linked = landed.withColumns({
        "page_no": F.row_number().over(order),
        "has_next": ~last,
        "fetched_at": F.lit("2024-06-01 02:00:00").cast("timestamp_ntz"),
    }).withColumns({
        "cursor_in": F.when(F.col("page_no") > 1, F.col("page_no").cast("long")),
        "body": F.when(
            F.col("has_next"),
            F.replace("body", F.lit('"has_more":false'),
                      F.concat(F.lit('"has_more":true,"cursor":'), (F.col("page_no") + 1).cast("string"))),
        ).otherwise(F.col("body")),
    }).drop("has_next")
    folder = scratch_path(spark, "landing")
    linked.write.partitionBy("endpoint").parquet(folder)
    from rollbook.sources.landing import read_landing

    landed = read_landing(spark, folder)
    log = jobs.sync_requests(warehouse, landed, requests_of(landed), list(RECORDS))
    problems = {(r.EndPoint.rsplit("/", 1)[-1], r.Exception) for r in log.filter("not Result").collect()}
    # The made-up pages repeat some keys.
    assert {p for _, p in problems} <= {"duplicate key"}
    assert log.count() == requests_of(landed).count() - log_skipped(log, landed)
    expected = standins["Students"].filter("Academy='A1' and DataSet='2021'").count()
    assert warehouse.read("Students").count() == expected > 0
    for table in ("EducationDetails", "AttributeValues", "Subjects", "Markslots", "ExamResults", "Calendar",
                  "StudentLessonMarks", "Periods", "BehEvents", "BehEventStudents", "AttendanceAliasCodes"):
        assert warehouse.read(table).count() > 0, table

    stored_tables = warehouse.tables()
    for report in (reports.session_attendance, reports.behaviour, reports.student_context, reports.subject_grades,
                   reports.forecast_grades, reports.markslot_marks):
        assert report(stored_tables).columns
    # Stored tables keep a student's rows in the student's year: every fact is read from that year's folders only.
    for report in (reports.subject_grades, reports.forecast_grades, reports.markslot_marks):
        scans = [part for part in planned(report(stored_tables, same_slice=True)).split("(unknown)") if "Batched" in part]
        filters = [line for line in "".join(scans).splitlines() if "PartitionFilters" in line]
        assert len(filters) >= 4 and all("DataSet" in line for line in filters)
        assert report(stored_tables, same_slice=True).exceptAll(report(stored_tables)).isEmpty()
    events = warehouse.read("BehEvents").count()
    assert reports.behaviour(stored_tables).select("BehEventId").distinct().count() == events
    reports.register_views(stored_tables)
    assert spark.table("v_SessionAttendance").count() == warehouse.read("StudentSessionMarks").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = executed(reports.behaviour(stored_tables))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan  # the events are shuffled once, for those with students and those without


def planned(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def log_skipped(log, landed):
    """Requests of later year groups than a failed one."""
    failed = log.filter("not Result and YearGroup is not null")
    first = {r.EndPoint: r.YearGroup for r in failed.groupBy("EndPoint").agg({"YearGroup": "min"})
             .withColumnRenamed("min(YearGroup)", "YearGroup").collect()}
    return sum(1 for r in requests_of(landed).collect() if r.path in first and r.NCYear > first[r.path])

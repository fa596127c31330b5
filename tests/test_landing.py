"""Page shapes, page chains and the rules for single values."""

from datetime import date, datetime

import pytest

from rollbook.operators.flatten import flatten
from rollbook.schemas.endpoints import ENDPOINTS
from rollbook.sources.landing import chain_status, parse_pages, records_of
from tests.landed import page, pages


def parsed(spark, endpoint, *bodies):
    rows = [page(endpoint, b, academy=f"A{i}") for i, b in enumerate(bodies)]
    return parse_pages(pages(spark, *rows), ENDPOINTS[endpoint])


def rows(spark, endpoint, table, body, **request):
    found = parse_pages(pages(spark, page(endpoint, body, **request)), ENDPOINTS[endpoint])
    return flatten(records_of(found.filter("page_ok")), endpoint)[table].collect()


@pytest.mark.parametrize(
    ("body", "ok", "count"),
    [
        ('{"departments":[{"id":1},{"id":2}],"has_more":false}', True, 2),
        ('[{"id":1},{"id":2}]', True, 2),
        ('  [{"id":1}]', True, 1),
        ('{"id":7,"name":"Art"}', True, 1),
        ('{"departments":[],"has_more":false}', True, 0),
        ('{"has_more":false}', False, None),
        ('{"departments":null,"has_more":false}', False, None),
        ('{"departments":[{"name":"no id"}]}', False, None),
        ('{"departments":[{"id":"x"}]}', False, None),
        ('{"departments":[{"id":1}', False, None),
        ("<html>busy</html>", False, None),
        (None, False, None),
    ],
)
def test_page_shapes(spark, body, ok, count):
    row = parse_pages(pages(spark, page("departments", body)), ENDPOINTS["departments"]).first()
    assert row.page_ok is ok
    if ok:
        assert len(row.records) == count


def chain(spark, *parts):
    made = []
    for page_no, cursor_in, has_more, cursor in parts:
        body = {"departments": [{"id": page_no}], "has_more": has_more, "cursor": cursor}
        made.append(page("departments", body, page_no=page_no, cursor=cursor_in))
    return chain_status(parse_pages(pages(spark, *made), ENDPOINTS["departments"])).first()


@pytest.mark.parametrize(
    ("parts", "problem"),
    [
        ([(1, None, False, None)], None),
        ([(1, None, True, 5), (2, 5, True, 9), (3, 9, False, None)], None),
        ([(3, 9, False, None), (1, None, True, 5), (2, 5, True, 9)], None),
        ([(1, None, True, 5)], "broken page chain"),
        ([(2, 5, False, None)], "broken page chain"),
        ([(1, None, True, 5), (3, 9, False, None)], "broken page chain"),
        ([(1, None, True, 5), (2, 6, False, None)], "broken page chain"),
        ([(1, None, False, None), (2, 5, False, None)], "broken page chain"),
        ([(1, None, True, 5), (2, 5, False, None), (2, 5, False, None)], "broken page chain"),
        # A loop that hangs on nothing.
        ([(1, None, False, None), (7, 9, True, 9)], "broken page chain"),
        ([(1, None, True, None), (2, None, False, None)], "broken page chain"),
    ],
)
def test_chains(spark, parts, problem):
    assert chain(spark, *parts).problem == problem


def test_text_dates_must_have_the_exact_form(spark):
    body = {"students_and_education_details": [
        {"student_id": 1, "admission_date": "2021-09-01T00:00:00Z", "leaving_date": "01/07/2021"},
        {"student_id": 2, "admission_date": "2021-09-01", "leaving_date": None},
    ]}
    first, second = sorted(rows(spark, "education_details", "EducationDetails", body), key=lambda r: r.StudentId)
    assert (first.AdmissionDate, first.LeavingDate) == (date(2021, 9, 1), None)
    assert (second.AdmissionDate, second.LeavingDate) == (None, None)
    assert first.RemovedFromSource is False


def test_native_dates_keep_the_utc_day_in_any_session_zone(spark):
    body = {"StudentLessonMarks": [{"student_id": 1, "class_id": 2, "date": "2024-01-08T23:30:00Z"}]}
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = rows(spark, "lesson_marks", "StudentLessonMarks", body)[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.Date == date(2024, 1, 8)


def test_null_ids(spark):
    body = {"StudentLessonMarks": [{"student_id": 1, "class_id": 2, "date": "2024-01-08T00:00:00"}]}
    row = rows(spark, "lesson_marks", "StudentLessonMarks", body)[0]
    assert (row.LessonMarkId, row.LessonAliasId, row.LessonMinutesLate) == ("A2021-", None, None)
    exam = rows(spark, "exam_results", "ExamResults", {"ExamResults": [{"student_id": 4}]}, year=11)[0]
    assert (exam.SubjectId, exam.ExamDate, exam.NCYear) == (None, None, 11)


def test_reception_and_grade_type_six(spark):
    name = rows(spark, "grade_names", "GradeNames", {"GradesTypes": [{"id": 3}]}, year=0)[0]
    assert (name.GradeNameId, name.NCYear, name.PreferredTargetGrade) == ("A2021-Reception-3", 0, False)
    kept = rows(
        spark, "grades", "Grades",
        {"grades": [{"grade_type_id": 6, "student_id": "1", "subject_id": "2"},
                    {"grade_type_id": 5, "student_id": "1", "subject_id": "2"}]}, year=7,
    )
    assert [r.GradeTypeId for r in kept] == [5]


def test_events_need_a_student_list(spark):
    body = {"behaviour_events": [
        {"id": 1, "event_date": "2024-01-08T10:15:00Z", "student_ids": None},
        {"id": 2, "event_date": "2024-01-08T10:15:00Z", "student_ids": []},
        {"id": 3, "event_date": "2024-01-08T10:15:00Z", "student_ids": [8, 9]},
    ]}
    events = rows(spark, "beh_events", "BehEvents", body)
    assert sorted(e.BehEventId for e in events) == [2, 3]
    assert events[0].EventDate == datetime(2024, 1, 8, 10, 15)
    involved = rows(spark, "beh_events", "BehEventStudents", body)
    assert sorted((r.BehEventId, r.StudentId) for r in involved) == [(3, "A2021-8"), (3, "A2021-9")]


def test_parents_without_children_stay(spark):
    sheets = {"markbooks": [{"id": 5, "marksheets": [{"id": 1, "markslots": None}, {"id": 2, "markslots": []}]},
                            {"id": 6, "marksheets": None}]}
    assert len(rows(spark, "markbooks", "Marksheets", sheets)) == 2
    assert rows(spark, "markbooks", "Markslots", sheets) == []
    types = {"students_and_attributes": [{"id": 9, "name": "FSM"}]}
    assert rows(spark, "send_attributes", "AttributeTypes", types)[0].AttributeTypeId == "A2021-Send-9"


def test_protection_flags_come_from_their_own_fields(spark):
    body = {"AttendanceCodes": [{"id": 1, "protect_if_entered_by_school_manager": True}]}
    code = rows(spark, "attendance_codes", "AttendanceCodes", body)[0]
    assert (code.ProtectSM, code.ProtectBM) == (True, False)


def test_periods_keep_the_time_of_day(spark):
    body = {"Timetables": [{"id": 1, "periods": [{"id": 2, "start": "2021-09-01T08:50:00"}]}]}
    period = rows(spark, "periods", "Periods", body)[0]
    assert (period.Start, period.StartsAt) == (date(2021, 9, 1), datetime(2021, 9, 1, 8, 50))


def test_parsed_once(spark):
    """The JSON text is parsed by one expression, however many filters and columns follow."""
    found = parsed(spark, "departments", "[]").filter("page_ok and has_more")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2  # as a page, and as a bare object where it is not one

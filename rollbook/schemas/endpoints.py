"""Source endpoints: where the rows sit in a page, what one record holds, how requests are cut."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Endpoint:
    """One JSON endpoint.

    ``record`` is the DDL of one element of the page's ``key`` array. ``must_have`` lists the fields
    without which a record is not one of this endpoint's. ``scope`` says how requests are cut: one per
    academic ``year``, per ``year_group`` or per ``day``. ``enabled_by`` is the config flag that turns the
    endpoint on; ``window`` gives the config columns of the date range and the default days before today.
    """

    name: str
    area: str
    path: str
    key: str
    record: str
    must_have: tuple[str, ...]
    tables: tuple[str, ...]
    scope: str = "year"
    enabled_by: str | None = None
    window: tuple[str, str, int, int] | None = None

    @property
    def page_ddl(self) -> str:
        return f"`{self.key}` ARRAY<STRUCT<{self.record}>>, has_more BOOLEAN, cursor BIGINT, _corrupt_record STRING"


_ROOT = "/customer/v1/academic-years/{academicYear}"
_ATTRIBUTE = (
    "id: BIGINT, code: STRING, name: STRING, is_system: BOOLEAN, students_and_attribute_values: "
    "ARRAY<STRUCT<student_id: BIGINT, value: STRING, academic_year: STRING, date: STRING>>"
)


def _attributes(name: str, path: str) -> Endpoint:
    return Endpoint(
        name, "students", _ROOT + path, "students_and_attributes", _ATTRIBUTE, ("id",),
        ("AttributeTypes", "AttributeValues"),
    )


# Endpoint paths, envelope keys, record fields, and the default days of the date windows, in
# the order in which a full sync asks for them. Native dates are read as text and converted afterwards.
_DECLARED = [
    Endpoint(
        "students", "students", _ROOT + "/students", "students",
        "id: BIGINT, date_of_birth: STRING, sex: STRING, legal_first_name: STRING, legal_last_name: STRING, "
        "preferred_first_name: STRING, preferred_last_name: STRING, middle_names: STRING",
        ("id",), ("Students",),
    ),
    Endpoint(
        "education_details", "students", _ROOT + "/students/education-details", "students_and_education_details",
        "student_id: BIGINT, upn: STRING, former_upn: STRING, national_curriculum_year: STRING, "
        "registration_group: STRING, house: STRING, admission_date: STRING, leaving_date: STRING, "
        "deleted_from_source: BOOLEAN, student_education_attributes: ARRAY<STRUCT<attribute_id: BIGINT, "
        "code: STRING, name: STRING, is_system: BOOLEAN, attribute_values: ARRAY<STRUCT<value: STRING, "
        "academic_year: STRING, date: STRING>>>>",
        ("student_id",), ("EducationDetails", "StudentAttributes", "StudentAttributeValues"),
    ),
    _attributes("general_attributes", "/students/attributes"),
    _attributes("demographic_attributes", "/students/attributes/demographic"),
    _attributes("send_attributes", "/students/attributes/send"),
    _attributes("sensitive_attributes", "/students/attributes/sensitive"),
    Endpoint(
        "departments", "teaching", _ROOT + "/teaching/departments", "departments",
        "id: BIGINT, name: STRING", ("id",), ("Departments",),
    ),
    Endpoint(
        "subjects", "teaching", _ROOT + "/teaching/subjects", "subjects",
        "id: BIGINT, name: STRING, code: STRING, year_group: STRING, department_id: BIGINT, qan: STRING, "
        "qualification_title: STRING, qualification_scheme_name: STRING, include_in_stats: BOOLEAN",
        ("id",), ("Subjects",),
    ),
    Endpoint(
        "groups", "teaching", _ROOT + "/teaching/groups", "groups",
        "id: BIGINT, name: STRING, code: STRING, subject_id: BIGINT", ("id",), ("Groups",),
    ),
    Endpoint(
        "group_students", "teaching", _ROOT + "/teaching/groups/students", "groups_students",
        "group_id: BIGINT, student_ids: ARRAY<BIGINT>", ("group_id",), ("GroupStudents",),
    ),
    Endpoint(
        "teachers", "teaching", _ROOT + "/teaching/teachers", "teacher",
        "id: BIGINT, title: STRING, first_name: STRING, last_name: STRING, preferred_first_name: STRING, "
        "preferred_last_name: STRING, initials: STRING, code: STRING",
        ("id",), ("Teachers",),
    ),
    Endpoint(
        "group_teachers", "teaching", _ROOT + "/teaching/groups/teachers", "group_teachers",
        "group_id: BIGINT, teacher_ids: ARRAY<BIGINT>", ("group_id",), ("GroupTeachers",),
    ),
    Endpoint(
        "markbooks", "assessment", _ROOT + "/assessment/markbooks", "markbooks",
        "id: BIGINT, marksheets: ARRAY<STRUCT<id: BIGINT, name: STRING, "
        "markslots: ARRAY<STRUCT<id: BIGINT, name: STRING, max: INT>>>>",
        ("id",), ("Marksheets", "Markslots"),
    ),
    Endpoint(
        "marksheet_grades", "assessment", _ROOT + "/assessment/marksheet-grades", "marksheets",
        "id: BIGINT, grades: ARRAY<STRUCT<student_id: BIGINT, grade: STRING, alias: STRING>>",
        ("id",), ("MarksheetGrades",),
    ),
    Endpoint(
        "markslot_marks", "assessment", _ROOT + "/assessment/marks", "markslots",
        "id: BIGINT, marks: ARRAY<STRUCT<student_id: BIGINT, grade: STRING, alias: STRING, mark: FLOAT>>",
        ("id",), ("MarkslotMarks",),
    ),
    Endpoint(
        "prior_attainment", "attainment", _ROOT + "/attainment/prior-attainment", "prior_attainment",
        "code: STRING, name: STRING, values: ARRAY<STRUCT<student_id: BIGINT, value: STRING, "
        "academic_year: STRING, date: STRING>>",
        ("code",), ("PriorAttainment",),
    ),
    Endpoint(
        "grade_names", "attainment", _ROOT + "/attainment/grade-types/year-group/{yearGroup}", "GradesTypes",
        "id: BIGINT, name: STRING, short_name: STRING, description: STRING, "
        "is_preferred_progress_grade: BOOLEAN, is_preferred_target_grade: BOOLEAN",
        ("id",), ("GradeNames",), scope="year_group",
    ),
    Endpoint(
        "grades", "attainment", _ROOT + "/attainment/grades/year-group/{yearGroup}", "grades",
        "grade_type_id: BIGINT, subject_id: STRING, student_id: STRING, name: STRING, alias: STRING",
        ("grade_type_id",), ("Grades",), scope="year_group",
    ),
    Endpoint(
        "exam_results", "attainment", _ROOT + "/attainment/exam-results/year-group/{yearGroup}", "ExamResults",
        "student_id: BIGINT, exam_academic_year: STRING, qan: STRING, qualification_title: STRING, "
        "exam_date: STRING, grade: STRING, ks123literal: STRING, subject_id: STRING",
        ("student_id",), ("ExamResults",), scope="year_group",
    ),
    Endpoint(
        "session_summaries", "attendance", _ROOT + "/attendance/student-session-summary", "session_summary",
        "student_id: BIGINT, possible_sessions: INT, present: INT, approved_educational_activity: INT, "
        "authorised_absence: INT, unauthorised_absence: INT, attendance_not_required: INT, "
        "missing_mark: INT, late: INT",
        ("student_id",), ("StudentSessionSummaries",),
    ),
    Endpoint(
        "attendance_codes", "attendance", _ROOT + "/attendance/codes", "AttendanceCodes",
        "id: BIGINT, code: STRING, label: STRING, attendance_officer_only: BOOLEAN, "
        "protect_if_entered_by_attendance_officer: BOOLEAN, protect_if_entered_by_school_manager: BOOLEAN, "
        "protect_if_entered_by_behaviour_manager: BOOLEAN, aliases: ARRAY<STRUCT<alias_id: BIGINT, "
        "alias_code: STRING, alias_label: STRING>>",
        ("id",), ("AttendanceCodes", "AttendanceAliasCodes"),
    ),
    Endpoint(
        "lesson_marks", "attendance", _ROOT + "/attendance/student-lesson-marks/date/{date}", "StudentLessonMarks",
        "date: STRING, student_id: BIGINT, class_id: BIGINT, lesson_mark_id: BIGINT, lesson_alias_id: BIGINT, "
        "lesson_minutes_late: INT, lesson_notes: STRING",
        ("student_id", "date"), ("StudentLessonMarks",), scope="day",
        enabled_by="GetLessonAttendance", window=("AttendanceFrom", "AttendanceTo", 1, 1),
    ),
    Endpoint(
        "session_marks", "attendance", _ROOT + "/attendance/student-session-marks/date/{date}",
        "StudentSessionMarks",
        "date: STRING, session: STRING, student_id: BIGINT, class_id: BIGINT, session_mark_id: BIGINT, "
        "session_alias_id: BIGINT, session_minutes_late: INT, session_notes: STRING",
        ("student_id", "date"), ("StudentSessionMarks",), scope="day",
        enabled_by="GetSessionAttendance", window=("AttendanceFrom", "AttendanceTo", 7, 0),
    ),
    Endpoint(
        "periods", "timetables", _ROOT + "/timetables", "Timetables",
        "id: BIGINT, periods: ARRAY<STRUCT<id: BIGINT, name: STRING, display_name: STRING, week: INT, "
        "day_of_week: STRING, start: STRING, end: STRING>>",
        ("id",), ("Periods",),
    ),
    Endpoint(
        "tt_classes", "timetables", _ROOT + "/timetables/classes", "classes",
        "id: BIGINT, year_group: STRING, subject_code: STRING, group_code: STRING, period_id: BIGINT",
        ("id",), ("TTClasses",),
    ),
    Endpoint(
        "calendar", "timetables", _ROOT + "/timetables/calendar", "calendar",
        "timetable_id: BIGINT, week: INT, date: STRING, day_type_code: STRING",
        ("date",), ("Calendar",),
    ),
    Endpoint(
        "beh_classifications", "behaviour", _ROOT + "/behaviour/classification", "classification",
        "id: BIGINT, name: STRING, score: INT", ("id",), ("BehClassifications",), enabled_by="GetBehaviour",
    ),
    Endpoint(
        "beh_event_types", "behaviour", _ROOT + "/behaviour/event-types", "eventtypes",
        "id: BIGINT, event_classification_id: BIGINT, code: STRING, name: STRING, alias: STRING, "
        "significance: STRING, prioritise: BOOLEAN",
        ("id",), ("BehEventTypes",), enabled_by="GetBehaviour",
    ),
    Endpoint(
        "beh_events", "behaviour", _ROOT + "/behaviour/events/date/{date}", "behaviour_events",
        "id: BIGINT, event_type_id: BIGINT, event_date: STRING, closed: BOOLEAN, cancelled: BOOLEAN, "
        "room_name: STRING, group_name: STRING, subject_code: STRING, year_group: STRING, "
        "home_notes: STRING, school_notes: STRING, created_timestamp: STRING, created_by: BIGINT, "
        "modified_timestamp: STRING, modified_by: BIGINT, student_ids: ARRAY<BIGINT>",
        ("id", "event_date"), ("BehEvents", "BehEventStudents"), scope="day",
        enabled_by="GetBehaviour", window=("BehaviourFrom", "BehaviourTo", 14, 0),
    ),
    Endpoint(
        "staff", "users", "/customer/v1/users/staff", "staff",
        "id: BIGINT, email_address: STRING, first_name: STRING, last_name: STRING, display_name: STRING, "
        "title: STRING",
        ("id",), ("Staff",),
    ),
]

ENDPOINTS: dict[str, Endpoint] = {endpoint.name: endpoint for endpoint in _DECLARED}

AREAS = ("students", "teaching", "assessment", "attainment", "attendance", "timetables", "behaviour", "users")

# One landed page: the request it answers, its place in the request's chain and the response text.
# ``fetched_at`` is when the request was made, the same for all of its pages.
PAGE_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("Academy", T.StringType()),
        T.StructField("DataSet", T.StringType()),
        T.StructField("NCYear", T.IntegerType()),
        T.StructField("Date", T.DateType()),
        T.StructField("fetched_at", T.TimestampNTZType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("cursor_in", T.LongType()),
        T.StructField("body", T.StringType()),
        T.StructField("endpoint", T.StringType()),
    ]
)

"""The two views and four reports, over warehouse tables given by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.columns import converted_text, grade_text, same_year
from rollbook.operators import attributes
from rollbook.operators.attributes import CONTEXT_COLUMNS, PivotColumn, attach_pivot, pivot_attributes
from rollbook.operators.joins import expand, look_up

Tables = Mapping[str, DataFrame]

# The filters of the reports as they are shipped.
REPORT_YEAR = 2021
UPPER_YEARS = ("10", "11")
PRIMARY_YEARS = ("1", "2", "3", "4", "5", "6")
FORECAST_SUFFIX = "Forecast"
TEST_SHEETS = ("NFER", "NFER GP")
KEY_STAGE_2 = "Prior Attainment (KS2)"


def session_attendance(t: Tables) -> DataFrame:
    """Session marks with student, code and alias. Academy and year are those of the education record."""
    marks = t["StudentSessionMarks"].select(
        F.col("StudentId").alias("MarkStudentId"), "Date", "Session", "SessionMarkId", "SessionAliasId",
        F.col("SessionMinutesLate").alias("session_minutes_late"), F.col("SessionNotes").alias("session_notes"),
    )
    rows = look_up(marks, _student_details(t), {"MarkStudentId": "StudentId"}, {
        "StudentId": "StudentId", "DataSet": "DataSet", "Academy": "Academy", "UPN": "UPN",
    })
    rows = look_up(rows, t["AttendanceCodes"], {"SessionMarkId": "AttendanceCodeId"}, {
        "Code": "attendance_code", "AttendanceLabel": "attendance_code_label",
    })
    rows = look_up(rows, t["AttendanceAliasCodes"], {"SessionAliasId": "AttendanceAliasCodeId"}, {
        "AliasCode": "attendance_alias_code", "Label": "attendance_alias_code_label",
    })
    return rows.select(
        "DataSet", "Academy", "StudentId", "UPN", "Date", "Session", "attendance_code", "attendance_code_label",
        "attendance_alias_code", "attendance_alias_code_label", "session_minutes_late", "session_notes",
    )


def behaviour(t: Tables) -> DataFrame:
    """Behaviour events, one row per student involved, with type, class, author, student and subject."""
    # In the order of the stored columns, so that both branches of the expansion read and shuffle the same frame.
    events = t["BehEvents"].select(
        "BehEventId", "BehEventTypeId", "EventDate", "Closed", "Cancelled", "GroupName", "SubjectCode", "YearGroup",
        "SchoolNotes", "CreatedByStaffId", "Academy", "DataSet",
    )
    # Students are found before the expansion and classes with their types: events without students, and types without
    # a class, would all have the key NULL afterwards and meet in one task.
    involved = t["BehEventStudents"].select("BehEventId", F.col("StudentId").alias("InvolvedId"))
    involved = look_up(involved, _student_details(t), {"InvolvedId": "StudentId"}, {
        "StudentId": "StudentId", "UPN": "UPN", "PreferredFirstName": "student_first_name",
        "PreferredLastName": "student_last_name",
    })
    rows = expand(events, involved.drop("InvolvedId"), ["BehEventId"])
    types = look_up(t["BehEventTypes"], t["BehClassifications"], {"BehClassificationId": "BehClassificationId"}, {
        "Name": "behaviour_class", "Score": "Score",
    })
    rows = look_up(rows, types, {"BehEventTypeId": "BehEventTypeId"}, {
        "Code": "event_code", "Name": "event_type", "Significance": "Significance", "behaviour_class": "behaviour_class",
        "Score": "Score",
    })
    rows = look_up(rows, t["Staff"], {"CreatedByStaffId": "StaffId"}, {
        "FirstName": "created_by_first_name", "LastName": "created_by_last_name",
        "EmailAddress": "created_by_email",
    })
    subjects = t["Subjects"].select("Academy", "DataSet", "YearGroup", F.col("Code").alias("SubjectCode"),
                                    F.col("Name").alias("Subject"))
    rows = rows.join(subjects, ["Academy", "SubjectCode", "YearGroup", "DataSet"], "left")
    return rows.select(
        "BehEventId", "Academy", "DataSet", "StudentId", "UPN", "student_first_name", "student_last_name",
        "behaviour_class", "Score", "event_code", "event_type", "SubjectCode", "Subject", "YearGroup", "GroupName",
        "Significance", F.col("EventDate").alias("event_date"), "created_by_first_name", "created_by_last_name",
        "created_by_email", "SchoolNotes", "Cancelled", "Closed",
    )


def student_context(t: Tables, columns: Sequence[PivotColumn] = CONTEXT_COLUMNS) -> DataFrame:
    """Students with their education record, attribute columns and key stage 2 result.

    The attributes are reduced to one row per student before any join; only that row is joined. A student with
    several different key stage 2 results has one row for each.
    """
    students = t["Students"].select(
        "Academy", "DataSet", "StudentId", F.col("PreferredFirstName").alias("FirstName"),
        F.col("PreferredLastName").alias("LastName"), "Sex", "DateOfBirth",
    )
    rows = look_up(students, t["EducationDetails"], {"StudentId": "StudentId"}, {
        "UPN": "UPN", "NCYear": "NCYear", "RegistrationGroup": "RegGroup", "AdmissionDate": "AdmissionDate",
        "LeavingDate": "LeavingDate",
    })
    rows = attach_pivot(rows, pivot_attributes(t["AttributeTypes"], t["AttributeValues"], columns), columns)
    results = t["PriorAttainment"].filter(F.col("Name") == KEY_STAGE_2)
    results = results.select("StudentId", F.col("Value").alias("KS2PA")).distinct()
    rows = rows.join(results, "StudentId", "left")
    return rows.select(
        "Academy", "DataSet", "StudentId", "UPN", "FirstName", "LastName", "Sex", "DateOfBirth", "NCYear",
        "RegGroup", "AdmissionDate", "LeavingDate", *[c.name for c in columns], "KS2PA",
    )


def subject_grades(
    t: Tables, years: Sequence[str] = UPPER_YEARS, dataset: int = REPORT_YEAR, same_academy: bool = False,
    prefer_alias: bool = False, same_slice: bool = False,
) -> DataFrame:
    """Distinct grades per subject of the students in the given year groups.

    ``same_slice`` (in all three reports) relies on what holds for tables that the sync job stored: a student's
    grades, sheets and subjects are stored under the student's academic year. Only that year's folders are then read.

    Grade names are matched by type, data set and year but not by academy, as shipped, so a grade shows under
    every academy's name for it; ``same_academy`` matches the academy too. Equal names are merged before the
    join, and the result is distinct.
    """
    t = _of_year(t, dataset, same_slice)
    students = _enrolled(t, years, dataset)
    grades = t["Grades"].select(
        "StudentId", "GradeTypeId", "SubjectId", F.col("DataSet").alias("GradeDataSet"),
        F.col("Academy").alias("GradeAcademy"), F.col("NCYear").alias("GradeYear"),
        grade_text("Name", "Alias", prefer_alias).alias("Grade"),
    )
    rows = students.join(grades, "StudentId").join(_named_subjects(t), "SubjectId")
    types = t["GradeTypes"].select(F.col("GradeTypeId").alias("KnownType"))
    rows = rows.join(types, F.col("GradeTypeId") == F.col("KnownType"), "left")
    on = {"KnownType": "GradeTypeId", "GradeDataSet": "DataSet", "GradeYear": "NCYear"}
    if same_academy:
        on["GradeAcademy"] = "Academy"
    names = t["GradeNames"].select(*on.values(), F.col("Name").alias("GradeName")).distinct()
    shown = (
        "Academy", "UPN", "NCYear", "PreferredFirstName", "PreferredLastName", "RegGroup", "SubjectName",
        "QualificationTitle",
    )
    rows = look_up(rows, names, on, {"GradeName": "GradeName"})
    return rows.select(*shown, "GradeName", "Grade").distinct()


def forecast_grades(
    t: Tables, years: Sequence[str] = PRIMARY_YEARS, dataset: int = REPORT_YEAR, suffix: str = FORECAST_SUFFIX,
    prefer_alias: bool = False, same_slice: bool = False,
) -> DataFrame:
    """Marksheet grades of the sheets whose name ends in the suffix."""
    t = _of_year(t, dataset, same_slice)
    sheets = t["Marksheets"].filter(F.col("Name").endswith(suffix)).select("MarksheetId", "SubjectId")
    sheets = sheets.join(_named_subjects(t), "SubjectId").select("MarksheetId", "SubjectName")
    grades = t["MarksheetGrades"].select(
        "StudentId", "MarksheetId", grade_text("Grade", "Alias", prefer_alias).alias("Grade")
    )
    rows = _enrolled(t, years, dataset).join(grades.join(sheets, "MarksheetId"), "StudentId")
    return rows.select(
        "StudentId", "Academy", "DataSet", "UPN", "NCYear", "PreferredFirstName", "PreferredLastName", "RegGroup",
        "SubjectName", F.lit(suffix).alias("GradeName"), "Grade", converted_text("NCYear").alias("SlotYear"),
        F.lit(None).cast("string").alias("SlotTerm"),
    )


def markslot_marks(
    t: Tables, years: Sequence[str] = PRIMARY_YEARS, dataset: int = REPORT_YEAR, sheets: Sequence[str] = TEST_SHEETS,
    same_slice: bool = False,
) -> DataFrame:
    """Marks in every slot of the chosen marksheets."""
    t = _of_year(t, dataset, same_slice)
    chosen = t["Marksheets"].filter(F.col("Name").isin(*sheets))
    chosen = chosen.select("MarksheetId", "SubjectId", F.col("Name").alias("MarksheetName"))
    chosen = chosen.join(_named_subjects(t), "SubjectId").select("MarksheetId", "MarksheetName")
    slots = t["Markslots"].select("MarkslotId", "MarksheetId", F.col("Name").alias("MarkslotName"))
    slots = slots.join(chosen, "MarksheetId").drop("MarksheetId")
    marks = t["MarkslotMarks"].select(
        "StudentId", "MarkslotId", F.col("Grade").alias("MarkslotGrade"), F.col("Mark").alias("MarkslotMark"),
        F.col("Alias").alias("MarkslotAlias"),
    )
    rows = _enrolled(t, years, dataset).join(marks.join(slots, "MarkslotId"), "StudentId")
    return rows.select(
        "StudentId", "Academy", "DataSet", "UPN", converted_text("NCYear").alias("NCYear"), "PreferredFirstName",
        "PreferredLastName", "RegGroup", "MarksheetName", "MarkslotName", "MarkslotGrade", "MarkslotMark",
        "MarkslotAlias",
    )


def register_views(t: Tables) -> None:
    """The two shipped views by name, for users who write SQL, and the four attribute look-ups as relations to join:
    one row per owner (StudentId, Academy, DataSet, AttributeName), and per academic year where the look-up takes one."""
    session_attendance(t).createOrReplaceTempView("v_SessionAttendance")
    behaviour(t).createOrReplaceTempView("v_Behaviour")
    for name, found in attribute_look_ups(t).items():
        found.createOrReplaceTempView(name)


def attribute_look_ups(t: Tables) -> dict[str, DataFrame]:
    named = attributes.named_values(t["AttributeTypes"], t["AttributeValues"])
    return {
        "v_AttributeValueLatest": attributes.latest_value(named),
        "v_AttributeValueEarliest": attributes.earliest_value(named),
        "v_AttributeValueAcademicYear": attributes.values_by_year(named),
        "v_AttributeValueNoTimeStamp": attributes.value_without_timestamp(named),
    }


def _student_details(t: Tables) -> DataFrame:
    """Students with their education record; both have one row per student, so one joined look-up serves."""
    names = t["Students"].select("StudentId", "PreferredFirstName", "PreferredLastName")
    return look_up(names, t["EducationDetails"], {"StudentId": "StudentId"}, {
        "UPN": "UPN", "Academy": "Academy", "DataSet": "DataSet",
    })


def _of_year(t: Tables, dataset: int, same_slice: bool) -> Tables:
    """With ``same_slice`` all tables that name an academic year, cut to that year: a filter on their folders."""
    if not same_slice:
        return t
    return {
        name: t[name].filter(same_year("DataSet", dataset)) if "DataSet" in t[name].columns else t[name]
        for name in (
            "Students", "EducationDetails", "Grades", "GradeTypes", "GradeNames", "Subjects", "Marksheets", "Markslots",
            "MarksheetGrades", "MarkslotMarks",
        )
        if name in t
    }


def _enrolled(t: Tables, years: Sequence[str], dataset: int) -> DataFrame:
    """Students of one year in the given year groups. Asking for the year group needs the education record, so
    the join is inner; both filters reach the scans. Year groups are text because of Reception."""
    students = t["Students"].filter(same_year("DataSet", dataset)).select(
        "StudentId", "Academy", "DataSet", "PreferredFirstName", "PreferredLastName"
    )
    details = t["EducationDetails"].filter(F.col("NCYear").isin(*years)).select(
        "StudentId", "UPN", "NCYear", F.col("RegistrationGroup").alias("RegGroup")
    )
    return students.join(details, "StudentId")


def _named_subjects(t: Tables) -> DataFrame:
    named = t["Subjects"].filter(F.col("Name").isNotNull())
    return named.select("SubjectId", F.col("Name").alias("SubjectName"), "QualificationTitle")

"""Endpoint records -> warehouse rows.

Every function takes the records of one endpoint (one per row, in column ``row``, with the request they came
from) and returns the rows of each table it feeds. Parents come straight from the records and children from an
``explode``, so a parent without children stays and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.columns import (
    flag_or_false,
    number_or_zero,
    optional_key,
    surrogate_key,
    text_date,
    text_moment,
    year_group_label,
)
from rollbook.operators.project import project

Tables = dict[str, DataFrame]
REQUEST = ("request_id", "AskedDay")
ORIGIN = (*REQUEST, "Academy", "DataSet")


def flatten(records: DataFrame, endpoint: str) -> Tables:
    """All tables of one endpoint: the columns they store, and the request each row came from."""
    return {name: project(df, name, keep=REQUEST) for name, df in _FLATTEN[endpoint](records).items()}


def _number(name: str) -> Column:
    return number_or_zero(f"row.{name}")


def _flag(name: str) -> Column:
    return flag_or_false(f"row.{name}")


def _key(name: str) -> Column:
    return surrogate_key(_number(name))


def _rows(records: DataFrame, *extra: str, **columns: Column | str) -> DataFrame:
    """Origin columns, then each target column from a Column or from the named record field."""
    made = [(F.col(f"row.{c}") if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    return records.select(*ORIGIN, *extra, *made)


def _each(records: DataFrame, array: str, *carry: str) -> DataFrame:
    """One row per element of ``row.<array>`` in column ``item``; NULL and empty arrays give none."""
    return records.select(*ORIGIN, *carry, "row", F.explode(f"row.{array}").alias("item"))


# --- students -------------------------------------------------------------------------------------------------


def students(records: DataFrame) -> Tables:
    rows = _rows(
        records,
        StudentId=_key("id"), SourceStudentId=_number("id"), DateOfBirth=text_date("row.date_of_birth"), Sex="sex",
        LegalFirstName="legal_first_name", LegalLastName="legal_last_name",
        PreferredFirstName="preferred_first_name", PreferredLastName="preferred_last_name",
        MiddleNames="middle_names",
    )
    return {"Students": rows}


def education_details(records: DataFrame) -> Tables:
    details = _rows(
        records,
        StudentId=_key("student_id"), SourceStudentId=_number("student_id"), UPN="upn", FormerUPN="former_upn",
        NCYear="national_curriculum_year", RegistrationGroup="registration_group", House="house",
        AdmissionDate=text_date("row.admission_date"), LeavingDate=text_date("row.leaving_date"),
        RemovedFromSource=_flag("deleted_from_source"),
    )
    each = _each(records, "student_education_attributes")
    attribute_id = number_or_zero("item.attribute_id")
    attributes = _rows(
        each,
        StudentAttributeId=surrogate_key(_number("student_id"), attribute_id), StudentId=_key("student_id"),
        SourceStudentId=_number("student_id"), AttributeId=attribute_id, Code=F.col("item.code"),
        Name=F.col("item.name"), IsSystem=flag_or_false("item.is_system"),
    )
    values = each.select(
        *ORIGIN,
        surrogate_key(_number("student_id"), attribute_id).alias("StudentAttributeId"),
        F.explode("item.attribute_values").alias("value"),
    ).select(
        *ORIGIN, "StudentAttributeId", F.col("value.value").alias("Value"),
        F.col("value.academic_year").alias("AcademicYear"), text_date("value.date").alias("Date"),
    )
    return {"EducationDetails": details, "StudentAttributes": attributes, "StudentAttributeValues": values}


def _attribute_group(group: str) -> Callable[[DataFrame], Tables]:
    def attributes(records: DataFrame) -> Tables:
        type_id = F.concat(
            F.col("Academy"), F.col("DataSet"), F.lit(f"-{group}-"), _number("id").cast("string")
        )
        types = _rows(
            records,
            AttributeTypeId=type_id, SourceAttributeId=_number("id"), AttributeGroup=F.lit(group), Code="code",
            AttributeName="name", IsSystem=_flag("is_system"),
        )
        values = _rows(
            _each(records, "students_and_attribute_values"),
            AttributeTypeId=type_id, AttributeGroup=F.lit(group),
            StudentId=surrogate_key(number_or_zero("item.student_id")), Value=F.col("item.value"),
            AcademicYear=F.col("item.academic_year"), Date=text_date("item.date"),
        )
        return {"AttributeTypes": types, "AttributeValues": values}

    return attributes


# --- teaching -------------------------------------------------------------------------------------------------


def departments(records: DataFrame) -> Tables:
    return {
        "Departments": _rows(records, DepartmentId=_key("id"), SourceDepartmentId=_number("id"), Name="name")
    }


def subjects(records: DataFrame) -> Tables:
    rows = _rows(
        records,
        SubjectId=_key("id"), SourceSubjectId=_number("id"), Name="name", Code="code", YearGroup="year_group",
        DepartmentId=_key("department_id"), QAN="qan", QualificationTitle="qualification_title",
        QualificationSchemeName="qualification_scheme_name", IncludeInStats=_flag("include_in_stats"),
    )
    return {"Subjects": rows}


def groups(records: DataFrame) -> Tables:
    return {"Groups": _rows(records, GroupId=_key("id"), Name="name", Code="code", SubjectId=_key("subject_id"))}


def group_students(records: DataFrame) -> Tables:
    each = _each(records, "student_ids")
    return {"GroupStudents": _rows(each, GroupId=_key("group_id"), StudentId=surrogate_key("item"))}


def teachers(records: DataFrame) -> Tables:
    rows = _rows(
        records,
        TeacherId=_key("id"), SourceTeacherId=_number("id"), Title="title", FirstName="first_name",
        LastName="last_name", PreferredFirstName="preferred_first_name",
        PreferredLastName="preferred_last_name", Initials="initials", Code="code",
    )
    return {"Teachers": rows}


def group_teachers(records: DataFrame) -> Tables:
    each = _each(records, "teacher_ids")
    return {"GroupTeachers": _rows(each, GroupId=_key("group_id"), TeacherId=surrogate_key("item"))}


# --- assessment -----------------------------------------------------------------------------------------------


def markbooks(records: DataFrame) -> Tables:
    each = _each(records, "marksheets")
    sheet_id = surrogate_key(number_or_zero("item.id"))
    sheets = _rows(each, MarksheetId=sheet_id, SubjectId=_key("id"), Name=F.col("item.name"))
    slots = each.select(
        *ORIGIN, sheet_id.alias("MarksheetId"), F.explode("item.markslots").alias("slot")
    ).select(
        *ORIGIN, "MarksheetId", surrogate_key(number_or_zero("slot.id")).alias("MarkslotId"),
        F.col("slot.name").alias("Name"), number_or_zero("slot.max").alias("MaxMarks"),
    )
    return {"Marksheets": sheets, "Markslots": slots}


def marksheet_grades(records: DataFrame) -> Tables:
    rows = _rows(
        _each(records, "grades"),
        MarksheetId=_key("id"), StudentId=surrogate_key(number_or_zero("item.student_id")),
        Grade=F.col("item.grade"), Alias=F.col("item.alias"),
    )
    return {"MarksheetGrades": rows}


def markslot_marks(records: DataFrame) -> Tables:
    rows = _rows(
        _each(records, "marks"),
        MarkslotId=_key("id"), StudentId=surrogate_key(number_or_zero("item.student_id")),
        Grade=F.col("item.grade"), Alias=F.col("item.alias"), Mark=F.col("item.mark"),
    )
    return {"MarkslotMarks": rows}


# --- attainment -----------------------------------------------------------------------------------------------


def prior_attainment(records: DataFrame) -> Tables:
    rows = _rows(
        _each(records, "values"),
        StudentId=surrogate_key(number_or_zero("item.student_id")), Code="code", Name="name",
        Value=F.col("item.value"), ValueAcademicYear=F.col("item.academic_year"),
        ValueDate=text_date("item.date"),
    )
    return {"PriorAttainment": rows}


def grade_names(records: DataFrame) -> Tables:
    rows = _rows(
        records, "NCYear",
        GradeNameId=surrogate_key(year_group_label("NCYear"), _number("id")), GradeTypeId=_number("id"),
        Name="name", ShortName="short_name", Description="description",
        PreferredProgressGrade=_flag("is_preferred_progress_grade"),
        PreferredTargetGrade=_flag("is_preferred_target_grade"),
    )
    return {"GradeNames": rows}


# Fixed value: the grade type whose rows have no linked subject and are left out.
ACTUAL_GRADE = 6


def grades(records: DataFrame) -> Tables:
    rows = _rows(
        records.filter(_number("grade_type_id") != ACTUAL_GRADE), "NCYear",
        GradeTypeId=_number("grade_type_id"), SubjectId=surrogate_key("row.subject_id"),
        StudentId=surrogate_key("row.student_id"), Name="name", Alias="alias",
    )
    return {"Grades": rows}


def exam_results(records: DataFrame) -> Tables:
    rows = _rows(
        records, "NCYear",
        StudentId=_key("student_id"), ExamAcademicYear="exam_academic_year", QAN="qan",
        QualificationTitle="qualification_title", ExamDate=F.to_date(text_moment("row.exam_date")),
        Grade="grade", KS123Literal="ks123literal", SubjectId=optional_key("row.subject_id"),
    )
    return {"ExamResults": rows}


# --- attendance -----------------------------------------------------------------------------------------------


def session_summaries(records: DataFrame) -> Tables:
    rows = _rows(
        records,
        StudentId=_key("student_id"), SourceStudentId=_number("student_id"),
        PossibleSessions=_number("possible_sessions"), Present=_number("present"),
        ApprovedEducationalActivity=_number("approved_educational_activity"),
        AuthorisedAbsence=_number("authorised_absence"), UnauthorisedAbsence=_number("unauthorised_absence"),
        AttendanceNotRequired=_number("attendance_not_required"), MissingMark=_number("missing_mark"),
        Late=_number("late"),
    )
    return {"StudentSessionSummaries": rows}


def attendance_codes(records: DataFrame) -> Tables:
    codes = _rows(
        records,
        AttendanceCodeId=_key("id"), Code="code", AttendanceLabel="label",
        AttendanceOfficerOnly=_flag("attendance_officer_only"),
        ProtectAO=_flag("protect_if_entered_by_attendance_officer"),
        ProtectSM=_flag("protect_if_entered_by_school_manager"),
        ProtectBM=_flag("protect_if_entered_by_behaviour_manager"),
    )
    aliases = _rows(
        _each(records, "aliases"),
        AttendanceAliasCodeId=surrogate_key(number_or_zero("item.alias_id")), AttendanceCodeId=_key("id"),
        AliasCode=F.col("item.alias_code"), Label=F.col("item.alias_label"),
    )
    return {"AttendanceCodes": codes, "AttendanceAliasCodes": aliases}


def lesson_marks(records: DataFrame) -> Tables:
    rows = _rows(
        records,
        StudentId=_key("student_id"), Date=F.to_date(text_moment("row.date")), ClassId=_key("class_id"),
        LessonMarkId=surrogate_key("row.lesson_mark_id"), LessonAliasId=optional_key("row.lesson_alias_id"),
        LessonMinutesLate="lesson_minutes_late", LessonNotes="lesson_notes",
    )
    return {"StudentLessonMarks": rows}


def session_marks(records: DataFrame) -> Tables:
    rows = _rows(
        records,
        StudentId=_key("student_id"), Date=F.to_date(text_moment("row.date")), Session="session",
        SessionMarkId=surrogate_key("row.session_mark_id"), SessionAliasId=optional_key("row.session_alias_id"),
        SessionMinutesLate="session_minutes_late", SessionNotes="session_notes",
    )
    return {"StudentSessionMarks": rows}


# --- timetables -----------------------------------------------------------------------------------------------


def periods(records: DataFrame) -> Tables:
    starts, ends = text_moment("item.start"), text_moment("item.end")
    rows = _rows(
        _each(records, "periods"),
        PeriodId=surrogate_key(number_or_zero("item.id")), TimetableId=_key("id"), PeriodName=F.col("item.name"),
        DisplayName=F.col("item.display_name"), WeekNumber=number_or_zero("item.week"),
        DayOfWeek=F.col("item.day_of_week"), Start=F.to_date(starts), End=F.to_date(ends), StartsAt=starts,
        EndsAt=ends,
    )
    return {"Periods": rows}


def tt_classes(records: DataFrame) -> Tables:
    rows = _rows(
        records,
        ClassId=_key("id"), YearGroup="year_group", SubjectCode="subject_code", GroupCode="group_code",
        PeriodId=_key("period_id"),
    )
    return {"TTClasses": rows}


def calendar(records: DataFrame) -> Tables:
    rows = _rows(
        records,
        TimetableId="timetable_id", Week="week", Date=F.to_date(text_moment("row.date")),
        DayTypeCode="day_type_code",
    )
    return {"Calendar": rows}


# --- behaviour ------------------------------------------------------------------------------------------------


def beh_classifications(records: DataFrame) -> Tables:
    rows = _rows(records, BehClassificationId=_number("id"), Name="name", Score=_number("score"))
    return {"BehClassifications": rows}


def beh_event_types(records: DataFrame) -> Tables:
    rows = _rows(
        records,
        BehEventTypeId=_number("id"), BehClassificationId=_number("event_classification_id"), Code="code",
        Name="name", Alias="alias", Significance="significance", Prioritise=_flag("prioritise"),
    )
    return {"BehEventTypes": rows}


def beh_events(records: DataFrame) -> Tables:
    """Events count only when the source names their students, be it none."""
    event_date = text_moment("row.event_date")
    events = _rows(
        records.filter(F.col("row.student_ids").isNotNull()),
        BehEventId=_number("id"), BehEventTypeId=_number("event_type_id"), EventDate=event_date,
        EventDay=F.to_date(event_date), Closed=_flag("closed"), Cancelled=_flag("cancelled"), RoomName="room_name",
        GroupName="group_name", SubjectCode="subject_code", YearGroup="year_group", HomeNotes="home_notes",
        SchoolNotes="school_notes", CreatedTimeStamp=text_moment("row.created_timestamp"),
        CreatedByStaffId=_number("created_by"), ModifiedTimeStamp=text_moment("row.modified_timestamp"),
        ModifiedByStaffId=_number("modified_by"),
    )
    involved = _rows(
        _each(records, "student_ids"),
        BehEventId=_number("id"), SourceStudentId=F.col("item"), StudentId=surrogate_key("item"),
        EventDay=F.to_date(event_date),
    )
    return {"BehEvents": events, "BehEventStudents": involved}


# --- users ----------------------------------------------------------------------------------------------------


def staff(records: DataFrame) -> Tables:
    rows = _rows(
        records,
        StaffId=_number("id"), EmailAddress="email_address", FirstName="first_name", LastName="last_name",
        DisplayName="display_name", Title="title",
    )
    return {"Staff": rows}


_FLATTEN: dict[str, Callable[[DataFrame], Tables]] = {
    "students": students,
    "education_details": education_details,
    "general_attributes": _attribute_group("General"),
    "demographic_attributes": _attribute_group("Demographic"),
    "send_attributes": _attribute_group("Send"),
    "sensitive_attributes": _attribute_group("Sensitive"),
    "departments": departments,
    "subjects": subjects,
    "groups": groups,
    "group_students": group_students,
    "teachers": teachers,
    "group_teachers": group_teachers,
    "markbooks": markbooks,
    "marksheet_grades": marksheet_grades,
    "markslot_marks": markslot_marks,
    "prior_attainment": prior_attainment,
    "grade_names": grade_names,
    "grades": grades,
    "exam_results": exam_results,
    "session_summaries": session_summaries,
    "attendance_codes": attendance_codes,
    "lesson_marks": lesson_marks,
    "session_marks": session_marks,
    "periods": periods,
    "tt_classes": tt_classes,
    "calendar": calendar,
    "beh_classifications": beh_classifications,
    "beh_event_types": beh_event_types,
    "beh_events": beh_events,
    "staff": staff,
}

# Dates without which a request fails as a whole.
STRICT_DATES = {
    "Students": "DateOfBirth",
    "StudentLessonMarks": "Date",
    "StudentSessionMarks": "Date",
    "Calendar": "Date",
    "BehEvents": "EventDate",
}

"""The two views and four reports, each with SQL of its own making: look-up relations first, facts reduced next."""

from pyspark.sql import functions as F

from rollbook.operators.attributes import CONTEXT_COLUMNS
from rollbook.plans import reports
from standins.catalogue import register

# One row per student, with what the education record adds.
_PERSON = """
    person as (
      select StudentId person_id, PreferredFirstName given, PreferredLastName family, UPN, home.Academy, home.DataSet
      from {Students} left join (select StudentId record_of, UPN, Academy, DataSet from {EducationDetails}) home
        on record_of=StudentId)"""


def _enrolled(years: str) -> str:
    """Students of 2021 in some year groups: both conditions before the join."""
    return f"""
    enrolled as (
      select StudentId, Academy, DataSet, UPN, NCYear, PreferredFirstName, PreferredLastName, RegGroup
      from (select * from {{Students}} where try_cast(DataSet as int)=2021)
      join (select StudentId, UPN, NCYear, RegistrationGroup RegGroup from {{EducationDetails}} where NCYear in ({years}))
      using (StudentId)),
    subject as (select SubjectId, Name SubjectName, QualificationTitle from {{Subjects}} where Name is not null)"""


_UPPER, _PRIMARY = "'10','11'", ",".join(f"'{n}'" for n in range(1, 7))

register(
    "session_attendance_view",
    reports.session_attendance,
    f"""
    with {_PERSON},
    code as (select AttendanceCodeId SessionMarkId, Code attendance_code, AttendanceLabel attendance_code_label
      from {{AttendanceCodes}}),
    other as (select AttendanceAliasCodeId SessionAliasId, AliasCode attendance_alias_code,
      Label attendance_alias_code_label from {{AttendanceAliasCodes}}),
    coded as (select * from {{StudentSessionMarks}} left join other using (SessionAliasId)
      left join code using (SessionMarkId))
    select person.DataSet, person.Academy, person_id StudentId, UPN, Date, Session, attendance_code,
      attendance_code_label, attendance_alias_code, attendance_alias_code_label,
      SessionMinutesLate session_minutes_late, SessionNotes session_notes
    from coded left join person on person_id=coded.StudentId
    """,
)
register(
    "behaviour_view",
    reports.behaviour,
    f"""
    with {_PERSON},
    kind as (
      select BehEventTypeId, Code event_code, Name event_type, Significance, class.behaviour_class, class.Score
      from {{BehEventTypes}} left join (select BehClassificationId, Name behaviour_class, Score
        from {{BehClassifications}}) class using (BehClassificationId)),
    author as (select StaffId CreatedByStaffId, FirstName created_by_first_name, LastName created_by_last_name,
      EmailAddress created_by_email from {{Staff}}),
    taught as (select Academy, DataSet, YearGroup, Code SubjectCode, Name Subject from {{Subjects}}),
    involved as (select BehEventId, person_id, UPN, given, family
      from {{BehEventStudents}} i left join person on person_id=i.StudentId),
    described as (select * from {{BehEvents}} left join taught using (Academy, DataSet, YearGroup, SubjectCode)
      left join kind using (BehEventTypeId) left join author using (CreatedByStaffId))
    select BehEventId, Academy, DataSet, person_id StudentId, UPN, given student_first_name,
      family student_last_name, behaviour_class, Score, event_code, event_type, SubjectCode, Subject, YearGroup,
      GroupName, Significance, EventDate event_date, created_by_first_name, created_by_last_name, created_by_email,
      SchoolNotes, Cancelled, Closed
    from described left join involved using (BehEventId)
    """,
)


def _reduced(name: str, attribute: str, default: str, as_yes_no: bool) -> str:
    """The greatest of the attribute's values and, if the student has other rows, of the default."""
    value = "replace(replace(Value,'True','Yes'),'False','No')" if as_yes_no else "Value"
    return (
        f"greatest(max({value}) filter (where AttributeName='{attribute}'), "
        f"case when count(*) filter (where AttributeName is distinct from '{attribute}')>0 then '{default}' end) {name}"
    )


def _or_default(name: str, default: str) -> str:
    return f"case when owner is null then '{default}' else {name} end {name}"


register(
    "student_context_pivot",
    reports.student_context,
    f"""
    with held as (
      select StudentId owner, {", ".join(_reduced(c.name, c.attribute, c.default, c.as_yes_no) for c in CONTEXT_COLUMNS)}
      from {{AttributeValues}} left join (select AttributeTypeId, AttributeName from {{AttributeTypes}})
        using (AttributeTypeId)
      group by StudentId),
    result as (select distinct StudentId tested, Value KS2PA from {{PriorAttainment}}
      where Name='Prior Attainment (KS2)'),
    record as (select StudentId recorded, UPN, NCYear, RegistrationGroup RegGroup, AdmissionDate, LeavingDate
      from {{EducationDetails}})
    select Academy, DataSet, StudentId, UPN, PreferredFirstName FirstName, PreferredLastName LastName, Sex,
      DateOfBirth, NCYear, RegGroup, AdmissionDate, LeavingDate,
      {", ".join(_or_default(c.name, c.default) for c in CONTEXT_COLUMNS)}, KS2PA
    from {{Students}} left join held on owner=StudentId left join result on tested=StudentId
      left join record on recorded=StudentId
    """,
)


def _grades_sql(shown: str, per_academy: bool) -> str:
    academy = "Academy name_academy, " if per_academy else ""
    return f"""
    with {_enrolled(_UPPER)},
    graded as (select distinct StudentId, SubjectId, GradeTypeId graded_type, DataSet graded_set, NCYear graded_year,
      Academy graded_academy, {shown} Grade from {{Grades}}),
    named as (select distinct {academy}GradeTypeId, DataSet name_set, NCYear name_year, Name GradeName
      from {{GradeNames}} where GradeTypeId in (select GradeTypeId from {{GradeTypes}}))
    select distinct enrolled.Academy, UPN, NCYear, PreferredFirstName, PreferredLastName, RegGroup, SubjectName,
      QualificationTitle, GradeName, Grade
    from graded join subject using (SubjectId) join enrolled using (StudentId)
      left join named on (graded_type, graded_set, graded_year)=(GradeTypeId, name_set, name_year)
        {"and graded_academy=name_academy" if per_academy else ""}
    """


register("subject_grades_distinct", reports.subject_grades, _grades_sql("Name", False))
register(
    "subject_grades_same_academy",
    lambda t: reports.subject_grades(t, same_academy=True, prefer_alias=True),
    _grades_sql("coalesce(Alias,Name)", True),
)
register(
    "forecast_marksheet_grades",
    reports.forecast_grades,
    f"""
    with {_enrolled(_PRIMARY)},
    sheet as (select MarksheetId, SubjectName from (select * from {{Marksheets}} where right(Name,8)='Forecast')
      join subject using (SubjectId))
    select StudentId, enrolled.Academy, enrolled.DataSet, UPN, NCYear, PreferredFirstName, PreferredLastName, RegGroup,
      SubjectName, 'Forecast' GradeName, Grade, left(NCYear,30) SlotYear, cast(null as string) SlotTerm
    from (select MarksheetId, StudentId, Grade from {{MarksheetGrades}}) join sheet using (MarksheetId)
      join enrolled using (StudentId)
    """,
)
register(
    "markslot_marks_report",
    lambda t: reports.markslot_marks(t).withColumn("MarkslotMark", F.col("MarkslotMark").cast("double")),
    f"""
    with {_enrolled(_PRIMARY)},
    slot as (select MarkslotId, MarksheetName, k.Name MarkslotName
      from (select MarksheetId, Name MarksheetName from {{Marksheets}} where Name in ('NFER','NFER GP')
          and SubjectId in (select SubjectId from subject))
      join {{Markslots}} k using (MarksheetId))
    select StudentId, enrolled.Academy, enrolled.DataSet, UPN, left(NCYear,30) NCYear, PreferredFirstName,
      PreferredLastName, RegGroup, MarksheetName, MarkslotName, Grade MarkslotGrade,
      cast(Mark as double) MarkslotMark, Alias MarkslotAlias
    from (select MarkslotId, StudentId, Grade, Alias, Mark from {{MarkslotMarks}}) join slot using (MarkslotId)
      join enrolled using (StudentId)
    """,
)

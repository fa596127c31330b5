"""Warehouse tables: columns with their length limits, keys, slices and parents.

A *slice* is what one request replaces; its columns are the table's storage partitions, so that replacing
a slice touches no other files (of very many slices, several share a folder: ``sources.layout``). Child tables whose own columns do not name their slice carry the slice
columns in storage as well.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def text(name: str, limit: int | None = None) -> T.StructField:
    """A string column; ``limit`` is the longest text it accepts."""
    return T.StructField(name, T.StringType(), True, {"limit": limit} if limit else None)


def number(name: str) -> T.StructField:
    return T.StructField(name, T.IntegerType())


def ident(name: str) -> T.StructField:
    """A numeric id; wide enough for a source of any size."""
    return T.StructField(name, T.LongType())


def real(name: str) -> T.StructField:
    return T.StructField(name, T.FloatType())


def flag(name: str) -> T.StructField:
    return T.StructField(name, T.BooleanType())


def day(name: str) -> T.StructField:
    return T.StructField(name, T.DateType())


def moment(name: str) -> T.StructField:
    return T.StructField(name, T.TimestampNTZType())


@dataclass(frozen=True)
class Parent:
    """A foreign key: rows go when the parent row with the same key goes."""

    table: str
    column: str


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[T.StructField, ...]
    key: tuple[str, ...]
    slice: tuple[str, ...] = ("Academy", "DataSet")
    parents: tuple[Parent, ...] = ()
    slice_fields: tuple[T.StructField, ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        return T.StructType(list(self.columns))

    @property
    def storage_schema(self) -> T.StructType:
        """Declared columns first, then the slice columns (Spark reads partition columns last)."""
        known = {f.name: f for f in (*self.columns, *self.slice_fields)}
        body = [f for f in self.columns if f.name not in self.slice]
        return T.StructType(body + [known[name] for name in self.slice])

    @property
    def limits(self) -> dict[str, int]:
        return {f.name: f.metadata["limit"] for f in self.columns if f.metadata.get("limit")}


CHILD_SLICE = (text("Academy", 10), text("DataSet", 4))
BY_GROUP = ("Academy", "DataSet", "AttributeGroup")
BY_YEAR = ("Academy", "DataSet", "NCYear")
BY_DAY = ("Academy", "DataSet", "Date")
BY_EVENT_DAY = ("Academy", "DataSet", "EventDay")

# Table and column names, text limits, keys and cascade parents of the warehouse. The numeric
# ids of the source system are named Source<thing>Id.
_DECLARED = [
    # Students
    Table(
        "Students",
        (
            text("StudentId", 100), ident("SourceStudentId"), text("DataSet", 4), text("Academy", 10),
            day("DateOfBirth"), text("Sex", 1), text("LegalFirstName", 200), text("LegalLastName", 200),
            text("PreferredFirstName", 200), text("PreferredLastName", 200), text("MiddleNames", 200),
        ),
        key=("StudentId",),
    ),
    Table(
        "EducationDetails",
        (
            text("StudentId", 100), ident("SourceStudentId"), text("DataSet", 4), text("Academy", 10),
            text("UPN", 13), text("FormerUPN", 13), text("NCYear", 20), text("RegistrationGroup", 100),
            text("House", 500), day("AdmissionDate"), day("LeavingDate"), flag("RemovedFromSource"),
        ),
        key=("StudentId",),
        parents=(Parent("Students", "StudentId"),),
    ),
    Table(
        "StudentAttributes",
        (
            text("StudentAttributeId", 100), text("StudentId", 100), ident("SourceStudentId"),
            ident("AttributeId"), text("Code", 100), text("Name", 500), flag("IsSystem"),
        ),
        key=("StudentAttributeId",),
        parents=(Parent("EducationDetails", "StudentId"),),
        slice_fields=CHILD_SLICE,
    ),
    Table(
        "StudentAttributeValues",
        (text("StudentAttributeId", 100), text("Value", 1000), text("AcademicYear", 4), day("Date")),
        key=("StudentAttributeId",),
        parents=(Parent("StudentAttributes", "StudentAttributeId"),),
        slice_fields=CHILD_SLICE,
    ),
    Table(
        "AttributeTypes",
        (
            text("AttributeTypeId", 100), ident("SourceAttributeId"), text("DataSet", 4), text("Academy", 10),
            text("AttributeGroup", 50), text("Code", 100), text("AttributeName", 500), flag("IsSystem"),
        ),
        key=("AttributeTypeId",),
        slice=BY_GROUP,
    ),
    Table(
        "AttributeValues",
        (
            text("AttributeTypeId", 100), text("StudentId", 100), text("Value", 1000), text("AcademicYear", 4),
            day("Date"),
        ),
        key=(),
        slice=BY_GROUP,
        parents=(Parent("AttributeTypes", "AttributeTypeId"), Parent("Students", "StudentId")),
        slice_fields=(*CHILD_SLICE, text("AttributeGroup", 50)),
    ),
    # Teaching
    Table(
        "Departments",
        (
            text("DepartmentId", 100), text("DataSet", 4), text("Academy", 10), ident("SourceDepartmentId"),
            text("Name", 200),
        ),
        key=("DepartmentId",),
    ),
    Table(
        "Subjects",
        (
            text("SubjectId", 100), ident("SourceSubjectId"), text("DataSet", 4), text("Academy", 10),
            text("Name", 200), text("Code", 50), text("YearGroup", 50), text("DepartmentId", 100),
            text("QAN", 50), text("QualificationTitle", 300), text("QualificationSchemeName", 300),
            flag("IncludeInStats"),
        ),
        key=("SubjectId",),
        parents=(Parent("Departments", "DepartmentId"),),
    ),
    Table(
        "Groups",
        (
            text("GroupId", 100), text("DataSet", 4), text("Academy", 10), text("Name", 1000),
            text("Code", 1000), text("SubjectId", 100),
        ),
        key=("GroupId",),
        parents=(Parent("Subjects", "SubjectId"),),
    ),
    Table(
        "GroupStudents",
        (text("GroupId", 100), text("StudentId", 100)),
        key=("StudentId", "GroupId"),
        parents=(Parent("Groups", "GroupId"), Parent("Students", "StudentId")),
        slice_fields=CHILD_SLICE,
    ),
    Table(
        "Teachers",
        (
            text("TeacherId", 100), ident("SourceTeacherId"), text("DataSet", 4), text("Academy", 10),
            text("Title", 10), text("FirstName", 100), text("LastName", 100), text("PreferredFirstName", 100),
            text("PreferredLastName", 100), text("Initials", 100), text("Code", 100),
        ),
        key=("TeacherId",),
    ),
    Table(
        "GroupTeachers",
        (text("GroupId", 100), text("TeacherId", 100)),
        key=("TeacherId", "GroupId"),
        parents=(Parent("Groups", "GroupId"), Parent("Teachers", "TeacherId")),
        slice_fields=CHILD_SLICE,
    ),
    # Assessment
    Table(
        "Marksheets",
        (
            text("MarksheetId", 100), text("SubjectId", 100), text("DataSet", 4), text("Academy", 10),
            text("Name", 200),
        ),
        key=("MarksheetId",),
        parents=(Parent("Subjects", "SubjectId"),),
    ),
    Table(
        "Markslots",
        (text("MarkslotId", 100), text("MarksheetId", 100), text("Name", 500), number("MaxMarks")),
        key=("MarkslotId",),
        parents=(Parent("Marksheets", "MarksheetId"),),
        slice_fields=CHILD_SLICE,
    ),
    Table(
        "MarksheetGrades",
        (text("MarksheetId"), text("StudentId"), text("Grade"), text("Alias")),
        key=("StudentId", "MarksheetId"),
        parents=(Parent("Marksheets", "MarksheetId"), Parent("Students", "StudentId")),
        slice_fields=CHILD_SLICE,
    ),
    Table(
        "MarkslotMarks",
        (
            text("MarkslotId", 100), text("StudentId", 100), text("Grade", 250), text("Alias", 250),
            real("Mark"),
        ),
        key=("StudentId", "MarkslotId"),
        parents=(Parent("Students", "StudentId"), Parent("Markslots", "MarkslotId")),
        slice_fields=CHILD_SLICE,
    ),
    # Attainment
    Table(
        "PriorAttainment",
        (
            text("StudentId", 100), text("DataSet", 100), text("Academy", 100), text("Code", 100),
            text("Name", 500), text("Value", 100), text("ValueAcademicYear", 100), day("ValueDate"),
        ),
        key=("StudentId", "Code"),
        parents=(Parent("Students", "StudentId"),),
    ),
    Table("GradeTypes", (ident("GradeTypeId"), text("Name")), key=("GradeTypeId",), slice=()),
    Table(
        "GradeNames",
        (
            text("GradeNameId", 100), ident("GradeTypeId"), text("DataSet", 100), text("Academy", 100),
            number("NCYear"), text("Name", 100), text("ShortName", 50), text("Description", 500),
            flag("PreferredProgressGrade"), flag("PreferredTargetGrade"),
        ),
        key=("GradeNameId",),
        slice=BY_YEAR,
        parents=(Parent("GradeTypes", "GradeTypeId"),),
    ),
    Table(
        "Grades",
        (
            ident("GradeTypeId"), text("SubjectId", 100), text("StudentId", 100), text("DataSet", 4),
            text("Academy", 10), number("NCYear"), text("Name", 50), text("Alias", 50),
        ),
        key=("StudentId", "GradeTypeId", "SubjectId"),
        slice=BY_YEAR,
        parents=(
            Parent("Students", "StudentId"), Parent("GradeTypes", "GradeTypeId"), Parent("Subjects", "SubjectId"),
        ),
    ),
    Table(
        "ExamResults",
        (
            text("StudentId", 100), text("DataSet", 10), text("Academy", 10), number("NCYear"),
            text("ExamAcademicYear", 10), text("QAN", 100), text("QualificationTitle", 500), day("ExamDate"),
            text("Grade", 100), text("KS123Literal", 500), text("SubjectId", 100),
        ),
        key=(),
        slice=BY_YEAR,
        parents=(Parent("Students", "StudentId"), Parent("Subjects", "SubjectId")),
    ),
    # Attendance
    Table(
        "StudentSessionSummaries",
        (
            text("StudentId", 100), ident("SourceStudentId"), text("DataSet", 4), text("Academy", 10),
            number("PossibleSessions"), number("Present"), number("ApprovedEducationalActivity"),
            number("AuthorisedAbsence"), number("UnauthorisedAbsence"), number("AttendanceNotRequired"),
            number("MissingMark"), number("Late"),
        ),
        key=("StudentId",),
        parents=(Parent("Students", "StudentId"),),
    ),
    Table(
        "AttendanceCodes",
        (
            text("DataSet", 4), text("Academy", 10), text("AttendanceCodeId", 100), text("Code", 10),
            text("AttendanceLabel", 250), flag("AttendanceOfficerOnly"), flag("ProtectAO"), flag("ProtectSM"),
            flag("ProtectBM"),
        ),
        key=("AttendanceCodeId",),
    ),
    Table(
        "AttendanceAliasCodes",
        (text("AttendanceAliasCodeId", 100), text("AttendanceCodeId"), text("AliasCode", 10), text("Label", 250)),
        key=("AttendanceAliasCodeId",),
        parents=(Parent("AttendanceCodes", "AttendanceCodeId"),),
        slice_fields=CHILD_SLICE,
    ),
    Table(
        "StudentLessonMarks",
        (
            text("DataSet", 4), text("Academy", 10), text("StudentId", 100), day("Date"), text("ClassId", 100),
            text("LessonMarkId", 100), text("LessonAliasId", 100), number("LessonMinutesLate"),
            text("LessonNotes", 250),
        ),
        key=("StudentId", "Date", "ClassId"),
        slice=BY_DAY,
    ),
    Table(
        "StudentSessionMarks",
        (
            text("DataSet", 4), text("Academy", 10), text("StudentId", 100), day("Date"), text("Session", 2),
            text("SessionMarkId", 100), text("SessionAliasId", 100), number("SessionMinutesLate"),
            text("SessionNotes"),
        ),
        key=("StudentId", "Date", "Session"),
        slice=BY_DAY,
    ),
    # Timetables
    Table(
        "Periods",
        (
            text("DataSet", 4), text("Academy", 10), text("PeriodId", 100), text("TimetableId", 100),
            text("PeriodName", 50), text("DisplayName", 50), number("WeekNumber"), text("DayOfWeek", 100),
            day("Start"), day("End"), moment("StartsAt"), moment("EndsAt"),
        ),
        key=("PeriodId",),
    ),
    Table(
        "TTClasses",
        (
            text("DataSet", 4), text("Academy", 10), text("ClassId", 100), text("YearGroup", 50),
            text("SubjectCode", 50), text("GroupCode", 100), text("PeriodId", 100),
        ),
        key=("ClassId",),
    ),
    Table(
        "Calendar",
        (
            text("DataSet", 4), text("Academy", 10), ident("TimetableId"), number("Week"), day("Date"),
            text("DayTypeCode", 50),
        ),
        key=("Academy", "DataSet", "Date"),
    ),
    # Behaviour
    Table(
        "BehClassifications",
        (
            ident("BehClassificationId"), text("DataSet", 4), text("Academy", 10), text("Name", 200),
            number("Score"),
        ),
        key=("BehClassificationId",),
    ),
    Table(
        "BehEventTypes",
        (
            ident("BehEventTypeId"), text("DataSet", 4), text("Academy", 10), ident("BehClassificationId"),
            text("Code", 50), text("Name", 250), text("Alias", 100), text("Significance", 100),
            flag("Prioritise"),
        ),
        key=("BehEventTypeId",),
        parents=(Parent("BehClassifications", "BehClassificationId"),),
    ),
    Table(
        "BehEvents",
        (
            ident("BehEventId"), text("DataSet", 4), text("Academy", 10), ident("BehEventTypeId"),
            moment("EventDate"), flag("Closed"), flag("Cancelled"), text("RoomName", 200),
            text("GroupName", 1000), text("SubjectCode", 50), text("YearGroup", 10), text("HomeNotes"),
            text("SchoolNotes"), moment("CreatedTimeStamp"), ident("CreatedByStaffId"),
            moment("ModifiedTimeStamp"), ident("ModifiedByStaffId"),
        ),
        key=("BehEventId",),
        slice=BY_EVENT_DAY,
        slice_fields=(day("EventDay"),),
    ),
    Table(
        "BehEventStudents",
        (ident("BehEventId"), ident("SourceStudentId"), text("StudentId", 100)),
        key=("BehEventId", "StudentId"),
        slice=BY_EVENT_DAY,
        parents=(Parent("BehEvents", "BehEventId"),),
        slice_fields=(*CHILD_SLICE, day("EventDay")),
    ),
    # Users
    Table(
        "Staff",
        (
            ident("StaffId"), text("Academy", 10), text("EmailAddress", 200), text("FirstName", 50),
            text("LastName", 50), text("DisplayName", 110), text("Title", 10),
        ),
        key=("StaffId",),
        slice=("Academy",),
    ),
    # Bookkeeping
    Table(
        "AcademySecurity",
        (
            text("AcademyCode"), text("Name", 100), text("CurrentAcademicYear", 4), flag("Active"),
            number("LowestYear"), number("HighestYear"), flag("GetLessonAttendance"),
            flag("GetSessionAttendance"), day("AttendanceFrom"), day("AttendanceTo"), flag("GetBehaviour"),
            day("BehaviourFrom"), day("BehaviourTo"),
        ),
        key=("AcademyCode",),
        slice=(),
    ),
    Table(
        "SyncResults",
        (
            T.StructField("LoggedAt", T.TimestampType()), text("AcademyCode", 10), text("EndPoint", 500),
            text("DataSet", 4), number("YearGroup"), day("Date"), flag("Result"), text("Exception", 5000),
            text("InnerException", 5000),
        ),
        key=(),
        slice=(),
    ),
]

TABLES: dict[str, Table] = {table.name: table for table in _DECLARED}

# The ten grade types every warehouse starts with.
GRADE_TYPES = [
    (1, "External target"),
    (2, "Teacher target"),
    (3, "Combined target"),
    (4, "Current"),
    (5, "Project"),
    (6, "Actual"),
    (7, "Honest"),
    (8, "Aspirational"),
    (9, "Additional target"),
    (10, "Baseline grade"),
]


def children_of(name: str) -> list[tuple[Table, str]]:
    """Tables that hang on ``name``, each with the column that holds its key."""
    return [(t, p.column) for t in TABLES.values() for p in t.parents if p.table == name]

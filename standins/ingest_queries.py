"""One query per endpoint and table: JSON pages in, warehouse rows out, checked against flat SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.schemas.tables import TABLES
from standins.catalogue import register
from standins.pages import bare_array, bare_object, ingest
from standins.relations import RECORD_NO, RELATIONS, academy, dataset, key, stamped


def _columns(table: str) -> str:
    return ", ".join(f.name for f in TABLES[table].storage_schema.fields)


def _same(table: str, where: str = "") -> str:
    """The rows of a stand-in table, in its declared columns."""
    return f"select {_columns(table)} from {{{table}}} {where}"


def _attribute_types(group: str) -> str:
    return f"""
        select concat({academy('p_partkey')},{dataset('p_partkey')},'-{group}-',cast(p_partkey as string)) AttributeTypeId,
          p_partkey SourceAttributeId, {stamped('p_partkey')}, '{group}' AttributeGroup, p_brand Code,
          p_type AttributeName, p_size>25 IsSystem from part"""


def _attribute_values(group: str) -> str:
    return f"""
        select concat({academy('p_partkey')},{dataset('p_partkey')},'-{group}-',cast(p_partkey as string)) AttributeTypeId,
          {key('p_partkey', 'p_partkey*50+i')} StudentId, case when i%2=0 then 'True' else 'False' end Value,
          case when i%3=0 then null else cast(2018+i%4 as string) end AcademicYear,
          case when i%4 in (0,1) then null else DATE '2020-01-01'+cast(i as int) end Date, {stamped('p_partkey')},
          '{group}' AttributeGroup
        from part, unnest(range(1,p_size+1)) as r(i) where p_size>=5"""


_GROUPS = ("General", "Demographic", "Send", "Sensitive")
_SHEETS = "part, unnest(range(1,5)) as r(i) where i<=p_size%5"

EXPECTED: dict[tuple[str, str], str] = {
    ("students", "Students"): _same("Students"),
    ("education_details", "EducationDetails"): _same("EducationDetails"),
    ("education_details", "StudentAttributes"): f"""
        select {key('c_custkey', RECORD_NO, 'a')} StudentAttributeId, {key('c_custkey', RECORD_NO)} StudentId,
          {RECORD_NO} SourceStudentId, a AttributeId, case a when 1 then 'SEG' else 'NAT' end Code,
          case a when 1 then 'Segment' else 'Nation' end as Name, a=1 IsSystem, {stamped('c_custkey')}
        from customer, unnest([1,2]) as r(a) where c_nationkey<>9""",
    ("education_details", "StudentAttributeValues"): f"""
        select {key('c_custkey', RECORD_NO, 'a')} StudentAttributeId,
          case a when 1 then c_mktsegment else cast(c_nationkey as string) end as Value,
          case a when 1 then '2021' end AcademicYear, case a when 1 then DATE '2021-07-01' end Date,
          {stamped('c_custkey')}
        from customer, unnest([1,2]) as r(a)
        where c_nationkey<>9 and (a=1 or c_nationkey<>8)""",
    **{(f"{g.lower()}_attributes", "AttributeTypes"): _attribute_types(g) for g in _GROUPS},
    **{(f"{g.lower()}_attributes", "AttributeValues"): _attribute_values(g) for g in _GROUPS},
    ("departments", "Departments"): f"""
        select {key('p_partkey')} DepartmentId, {stamped('p_partkey')}, p_partkey SourceDepartmentId,
          concat('Dept ',cast(p_size as string)) Name from part""",
    ("subjects", "Subjects"): _same("Subjects"),
    ("groups", "Groups"): _same("Groups"),
    ("group_students", "GroupStudents"): f"""
        select {key('o_orderkey')} GroupId, {key('o_orderkey', 'o_custkey+i')} StudentId, {stamped('o_orderkey')}
        from orders, unnest([0,1]) as r(i) where o_orderstatus<>'P'""",
    ("teachers", "Teachers"): _same("Teachers"),
    ("group_teachers", "GroupTeachers"): f"""
        select {key('p_partkey')} GroupId, {key('p_partkey', 'i')} TeacherId, {stamped('p_partkey')}
        from part, unnest(range(1,p_size+1)) as r(i)""",
    ("markbooks", "Marksheets"): f"""
        select {key('p_partkey', 'p_partkey*8+i')} MarksheetId, {key('p_partkey')} SubjectId, {stamped('p_partkey')},
          case when i%2=0 then concat(p_name,' Forecast') else 'NFER' end as Name from {_SHEETS}""",
    ("markbooks", "Markslots"): f"""
        select {key('p_partkey', '(p_partkey*8+i)*8+j')} MarkslotId, {key('p_partkey', 'p_partkey*8+i')} MarksheetId,
          concat('Slot ',cast(j as string)) as Name, cast(case when j<3 then j*10 else 0 end as int) MaxMarks,
          {stamped('p_partkey')}
        from part, unnest(range(1,5)) as r(i), unnest(range(1,4)) as q(j)
        where i<=p_size%5 and j<=p_size%4 and p_size<45""",
    ("marksheet_grades", "MarksheetGrades"): f"""
        select {key('o_orderkey')} MarksheetId, {key('o_orderkey', 'o_custkey+i')} StudentId,
          case i when 0 then o_orderstatus else o_orderpriority end Grade, case i when 1 then 'again' end Alias,
          {stamped('o_orderkey')} from orders, unnest([0,1]) as r(i)""",
    ("markslot_marks", "MarkslotMarks"): f"""
        select {key('l_orderkey', 'l_orderkey*8+l_linenumber')} MarkslotId, {key('l_orderkey', 'l_suppkey')} StudentId,
          l_returnflag Grade, l_linestatus Alias,
          case when l_linenumber=7 then null else cast(l_quantity as double) end Mark, {stamped('l_orderkey')}
        from lineitem""",
    ("prior_attainment", "PriorAttainment"): _same("PriorAttainment"),
    ("grade_names", "GradeNames"): _same("GradeNames"),
    ("grades", "Grades"): f"""
        select GradeTypeId, {key('stu', 'l_partkey')} SubjectId, StudentId, Name, Alias, Academy, DataSet, NCYear
        from (select *, cast(floor(l_orderkey/10) as bigint) stu from lineitem)
          join (select distinct StudentId, Academy, DataSet, SourceStudentId from {{Students}}) on SourceStudentId=stu
          cross join lateral (select cast(l_linenumber as bigint) GradeTypeId, cast(stu%14 as int) NCYear,
            l_returnflag as Name, case when l_linestatus='O' then null else concat('A',l_returnflag) end as Alias)
        where GradeTypeId<>6""",
    ("exam_results", "ExamResults"): _same("ExamResults"),
    ("session_summaries", "StudentSessionSummaries"): _same("StudentSessionSummaries"),
    ("attendance_codes", "AttendanceCodes"): _same("AttendanceCodes"),
    ("attendance_codes", "AttendanceAliasCodes"): _same("AttendanceAliasCodes"),
    ("lesson_marks", "StudentLessonMarks"): _same("StudentLessonMarks"),
    ("session_marks", "StudentSessionMarks"): _same("StudentSessionMarks"),
    ("periods", "Periods"): f"""
        select PeriodId, TimetableId, PeriodName, DisplayName, WeekNumber, DayOfWeek, DATE '2021-09-01' as Start,
          DATE '2021-09-01' as End, TIMESTAMP '2021-09-01 08:00:00'+to_minutes(p_size) StartsAt,
          TIMESTAMP '2021-09-01 09:00:00'+to_minutes(p_size) EndsAt, Academy, DataSet
        from {{Periods}} join part on PeriodId={key('p_partkey')} where p_size>=10""",
    ("tt_classes", "TTClasses"): _same("TTClasses"),
    ("calendar", "Calendar"): _same("Calendar"),
    ("beh_classifications", "BehClassifications"): _same("BehClassifications"),
    ("beh_event_types", "BehEventTypes"): _same("BehEventTypes"),
    ("beh_events", "BehEvents"): _same("BehEvents", "where GroupName<>'5-LOW'"),
    ("beh_events", "BehEventStudents"): f"""
        select BehEventId, stu SourceStudentId, concat(Academy,DataSet,'-',cast(stu as string)) StudentId, Academy,
          DataSet, EventDay
        from (select e.*, unnest(case o_orderstatus when 'O' then [o_custkey] when 'F' then [o_custkey,o_custkey+1]
            else [] end) stu
          from {{BehEvents}} e join orders on o_orderkey=BehEventId where o_orderpriority<>'5-LOW')""",
    ("staff", "Staff"): _same("Staff"),
}

def _ingest(t, endpoint: str, table: str) -> DataFrame:
    rows = ingest(t, endpoint, table)
    return rows.withColumn("Mark", F.col("Mark").cast("double")) if "Mark" in rows.columns else rows


_PER_ENDPOINT = {e: [t for x, t in EXPECTED if x == e] for e, _ in EXPECTED}
for (endpoint, table), sql in EXPECTED.items():
    name = f"ingest_{endpoint}" if len(_PER_ENDPOINT[endpoint]) == 1 else f"ingest_{endpoint}__{table}"
    register(name, lambda t, e=endpoint, n=table: _ingest(t, e, n), sql)

register("ingest_bare_array", lambda t: ingest(t, "subjects", "Subjects", bare_array), _same("Subjects"))
register("ingest_single_object", lambda t: ingest(t, "students", "Students", bare_object), _same("Students"))


def _all_groups(t) -> DataFrame:
    return reduce(DataFrame.unionByName, [ingest(t, f"{g.lower()}_attributes", "AttributeTypes") for g in _GROUPS])


register("union_attribute_groups", _all_groups, " union all ".join(_attribute_types(g) for g in _GROUPS))

assert set(RELATIONS) <= set(TABLES)

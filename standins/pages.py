"""Landed pages made from the test tables: the source's JSON, written from flat rows.

``RECORDS`` gives, per endpoint, the records as Spark SQL: the number the academy and year follow from, the year
group or day of the request, and the record itself. Child arrays are built from the row's own columns, so nothing
is gathered and the pages cost one pass over the table, whose narrow rows are dealt out to the tasks first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.operators.flatten import REQUEST, flatten
from rollbook.plans.requests import request_id
from rollbook.schemas.endpoints import ENDPOINTS
from rollbook.sources.landing import parse_pages, records_of
from standins.relations import ALIAS_NO, CLASS_NO, EVENT_AUTHOR, EVENT_SUBJECT, LINE_STUDENT, MARK_NO, RECORD_NO, Standins

NOT_A_DATE = "01/07/2021"


def _text_date(day: str) -> str:
    return f"date_format({day}, \"yyyy-MM-dd'T'00:00:00'Z'\")"


def _text_moment(at: str) -> str:
    return f"date_format({at}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"


ATTRIBUTE_RECORD = f"""
    select p_partkey n, struct(p_partkey id, p_brand code, p_type name, p_size>25 is_system,
      case when p_size>=5 then transform(sequence(1, p_size), i -> struct(
        p_partkey*50+i as student_id, case when i%2=0 then 'True' else 'False' end as value,
        case when i%3=0 then null else cast(2018+i%4 as string) end as academic_year,
        case when i%4=0 then null when i%4=1 then '{NOT_A_DATE}'
          else {_text_date("date_add(DATE '2020-01-01', i)")} end as date)) end
      as students_and_attribute_values) record
    from {{part}}"""

RECORDS: dict[str, str] = {
    "students": f"""
        select c_custkey n, struct(c_custkey id, {_text_date("DATE '2004-09-01'+cast(c_custkey%4000 as int)")} date_of_birth,
          case when c_nationkey%2=0 then 'F' else 'M' end sex, concat('L',c_mktsegment) legal_first_name,
          concat('L',c_name) legal_last_name, c_mktsegment preferred_first_name, c_name preferred_last_name,
          case when c_acctbal<0 then null else 'Mid' end middle_names) record
        from {{customer}}""",
    "education_details": f"""
        select c_custkey n, struct({RECORD_NO} student_id, concat('U',cast(c_custkey as string)) upn,
          cast(null as string) former_upn,
          case when c_custkey%14=0 then 'Reception' else cast(c_custkey%14 as string) end national_curriculum_year,
          c_mktsegment registration_group, concat('H',cast(c_nationkey as string)) house,
          {_text_date("DATE '2015-09-01'+cast(c_custkey%900 as int)")} admission_date,
          case when c_nationkey=6 then '2020-07-01T00:00:00Z' when c_nationkey=5 then '{NOT_A_DATE}' end leaving_date,
          case when c_nationkey=7 then true end deleted_from_source,
          case when c_nationkey<>9 then array(
            struct(1 as attribute_id, 'SEG' as code, 'Segment' as name, true as is_system,
              array(struct(c_mktsegment as value, '2021' as academic_year, '2021-07-01T00:00:00Z' as date))
              as attribute_values),
            struct(2 as attribute_id, 'NAT' as code, 'Nation' as name, cast(null as boolean) as is_system,
              case when c_nationkey<>8 then array(struct(cast(c_nationkey as string) as value,
                cast(null as string) as academic_year, '{NOT_A_DATE}' as date)) end as attribute_values)) end
          student_education_attributes) record
        from {{customer}}""",
    "general_attributes": ATTRIBUTE_RECORD,
    "demographic_attributes": ATTRIBUTE_RECORD,
    "send_attributes": ATTRIBUTE_RECORD,
    "sensitive_attributes": ATTRIBUTE_RECORD,
    "departments": """
        select p_partkey n, struct(p_partkey id, concat('Dept ',cast(p_size as string)) name) record from {part}""",
    "subjects": """
        select p_partkey n, struct(p_partkey id, case when p_size=1 then null else p_name end name,
          concat('S',cast(p_partkey as string)) code, cast(p_partkey%14 as string) year_group, p_size department_id,
          p_brand qan, p_type qualification_title, cast(null as string) qualification_scheme_name,
          p_size>25 include_in_stats) record
        from {part}""",
    "groups": """
        select s_suppkey n, struct(s_suppkey id, s_name name, concat('G',s_name) code, s_suppkey subject_id) record
        from {supplier}""",
    "group_students": """
        select o_orderkey n, struct(o_orderkey group_id,
          case when o_orderstatus='P' then null else array(o_custkey, o_custkey+1) end student_ids) record
        from {orders}""",
    "teachers": """
        select s_suppkey n, struct(s_suppkey id, 'Dr' title, concat('F',s_name) first_name, s_name last_name,
          cast(null as string) preferred_first_name, s_name preferred_last_name, 'X' initials,
          cast(s_suppkey as string) code) record
        from {supplier}""",
    "group_teachers": """
        select p_partkey n, struct(p_partkey group_id, sequence(1, p_size) teacher_ids) record from {part}""",
    "markbooks": """
        select p_partkey n, struct(p_partkey id,
          transform(filter(sequence(1,4), i -> i<=p_size%5), i -> struct(
            p_partkey*8+i as id, case when i%2=0 then concat(p_name,' Forecast') else 'NFER' end as name,
            case when p_size<45 then transform(filter(sequence(1,3), j -> j<=p_size%4), j -> struct(
              (p_partkey*8+i)*8+j as id, concat('Slot ',cast(j as string)) as name,
              case when j<3 then j*10 end as max)) end as markslots)) marksheets) record
        from {part}""",
    "marksheet_grades": """
        select o_orderkey n, struct(o_orderkey id, array(
          struct(o_custkey as student_id, o_orderstatus as grade, cast(null as string) as alias),
          struct(o_custkey+1 as student_id, o_orderpriority as grade, 'again' as alias)) grades) record
        from {orders}""",
    "markslot_marks": """
        select l_orderkey n, struct(l_orderkey*8+l_linenumber id, array(struct(l_suppkey as student_id,
          l_returnflag as grade, l_linestatus as alias,
          case when l_linenumber=7 then null else cast(l_quantity as float) end as mark)) marks) record
        from {lineitem}""",
    "prior_attainment": f"""
        select c_custkey n, struct(case when c_nationkey%2=0 then 'KS2' else 'KS1' end code,
          case when c_nationkey%2=0 then 'Prior Attainment (KS2)' else 'Prior Attainment (KS1)' end name,
          array(struct(c_custkey as student_id, cast(80+c_custkey%40 as string) as value, '2018' as academic_year,
            case when c_acctbal<0 then '{NOT_A_DATE}' else '2018-07-01T00:00:00Z' end as date)) values) record
        from {{customer}}""",
    "grade_names": """
        select cast(substring(Academy,2) as bigint) academy_no, cast(DataSet as bigint)-2019 year_no, NCYear,
          struct(GradeTypeId id, Name name, ShortName short_name, cast(null as string) description,
            PreferredProgressGrade is_preferred_progress_grade,
            case when PreferredTargetGrade then true end is_preferred_target_grade) record
        from {GradeNames}""",
    "grades": f"""
        select {LINE_STUDENT} n, cast({LINE_STUDENT}%14 as int) NCYear, struct(l_linenumber grade_type_id,
          cast(l_partkey as string) subject_id, cast({LINE_STUDENT} as string) student_id, l_returnflag name,
          case when l_linestatus='O' then null else concat('A',l_returnflag) end alias) record
        from {{lineitem}}""",
    "exam_results": f"""
        select o_custkey n, cast(o_custkey%14 as int) NCYear, struct(o_custkey student_id, '2000' exam_academic_year,
          concat('Q',o_orderstatus) qan, o_orderpriority qualification_title, {_text_moment("o_orderdate")} exam_date,
          o_orderstatus grade, cast(null as string) ks123literal,
          case when o_orderstatus='P' then null else cast({EVENT_SUBJECT} as string) end subject_id) record
        from {{orders}}""",
    "session_summaries": """
        select SourceStudentId n, struct(SourceStudentId student_id, PossibleSessions possible_sessions,
          Present present, ApprovedEducationalActivity approved_educational_activity,
          UnauthorisedAbsence unauthorised_absence, Late late) record
        from {StudentSessionSummaries}""",
    "attendance_codes": """
        select cast(substring(Academy,2) as bigint) academy_no, cast(DataSet as bigint)-2019 year_no,
          struct(ascii(AttendanceLabel) id, Code code, AttendanceLabel label,
            AttendanceOfficerOnly attendance_officer_only, ProtectAO protect_if_entered_by_attendance_officer,
            ProtectSM protect_if_entered_by_school_manager, ProtectBM protect_if_entered_by_behaviour_manager,
            array(struct(ascii(AttendanceLabel)*10+9 as alias_id, concat(Code,'x') as alias_code,
              concat(AttendanceLabel,' alias') as alias_label)) aliases) record
        from {AttendanceCodes}""",
    "lesson_marks": f"""
        select user_id n, cast(ts as date) Date, struct({_text_moment("ts")} date, user_id student_id,
          event_id class_id, ascii(event_type) lesson_mark_id,
          case when value<5 then ascii(event_type) end lesson_alias_id,
          case when event_type='error' then cast(floor(value) as int) end lesson_minutes_late,
          props lesson_notes) record
        from {{events}}""",
    "session_marks": f"""
        select user_id n, cast(ts as date) Date, struct({_text_moment("ts")} date,
          case when hour(ts)<12 then 'AM' else 'PM' end session, user_id student_id, event_id class_id,
          {MARK_NO} session_mark_id, case when value<5 then {ALIAS_NO} end session_alias_id,
          case when event_type='error' then cast(floor(value) as int) end session_minutes_late,
          props session_notes) record
        from {{events}}""",
    "periods": """
        select p_partkey n, struct(p_size id, case when p_size>=10 then array(struct(p_partkey as id,
          concat('P',cast(p_size%6 as string)) as name, p_name as display_name, p_size%2 as week,
          case when p_size>25 then 'Monday' else 'Friday' end as day_of_week,
          concat('2021-09-01T08:',cast(p_size as string),':00') as start,
          concat('2021-09-01T09:',cast(p_size as string),':00Z') as end)) end periods) record
        from {part}""",
    "tt_classes": """
        select p_partkey n, struct(p_partkey id, cast(p_partkey%14 as string) year_group,
          concat('S',cast(p_partkey as string)) subject_code, p_brand group_code, p_partkey period_id) record
        from {part}""",
    "calendar": f"""
        select cast(substring(Academy,2) as bigint) academy_no, cast(DataSet as bigint)-2019 year_no,
          struct(TimetableId timetable_id, Week week, {_text_date("Date")} date, DayTypeCode day_type_code) record
        from {{Calendar}}""",
    "beh_classifications": """
        select s_suppkey n, struct(s_suppkey id, concat('Class ',s_name) name, s_nationkey-12 score) record
        from {supplier}""",
    "beh_event_types": f"""
        select p_partkey n, struct(p_partkey id, {CLASS_NO} event_classification_id, p_brand code, p_name name,
          case when p_size<9 then p_type end alias,
          case when p_size>25 then 'Positive' else 'Negative' end significance, p_size=50 prioritise) record
        from {{part}}""",
    "beh_events": f"""
        select o_custkey academy_no, {EVENT_SUBJECT} year_no, cast(o_orderdate as date) Date, struct(o_orderkey id,
          {EVENT_SUBJECT} event_type_id, {_text_moment("o_orderdate")} event_date,
          case when o_orderstatus='F' then true end closed, o_orderstatus='P' cancelled,
          cast(null as string) room_name, o_orderpriority group_name,
          concat('S',cast({EVENT_SUBJECT} as string)) subject_code, cast({EVENT_SUBJECT}%14 as string) year_group,
          concat('note ',o_orderstatus) school_notes, {_text_moment("o_orderdate")} created_timestamp,
          {EVENT_AUTHOR} created_by, {_text_moment("o_orderdate")} modified_timestamp, {EVENT_AUTHOR} modified_by,
          case when o_orderpriority='5-LOW' then null
            else case o_orderstatus when 'P' then cast(array() as array<bigint>) when 'O' then array(o_custkey)
              else array(o_custkey, o_custkey+1) end end student_ids) record
        from {{orders}}""",
    "staff": """
        select s_suppkey n, struct(s_suppkey id, concat(s_name,'@example.org') email_address,
          concat('F',s_name) first_name, s_name last_name, concat('Dr ',s_name) display_name, 'Dr' title) record
        from {supplier}""",
}

def records(standins: Standins, endpoint: str) -> DataFrame:
    """Academy, DataSet, NCYear, Date and record of every source row of an endpoint."""
    found = standins.sql(RECORDS[endpoint], spread=True)
    academy_no = F.col("academy_no") if "academy_no" in found.columns else F.col("n")
    year_no = F.col("year_no") if "year_no" in found.columns else F.col("n")

    def given(name: str, kind: str) -> Column:
        return F.col(name) if name in found.columns else F.lit(None).cast(kind)

    return found.select(
        F.concat(F.lit("A"), (academy_no % 5).cast("string")).alias("Academy"),
        (2019 + year_no % 3).cast("string").alias("DataSet"),
        given("NCYear", "int").alias("NCYear"),
        given("Date", "date").alias("Date"),
        F.lit(endpoint).alias("endpoint"),
        "record",
    )


def envelope(endpoint: str) -> Column:
    """A page with one record and nothing more to come."""
    return F.to_json(
        F.struct(F.array("record").alias(ENDPOINTS[endpoint].key), F.lit(False).alias("has_more"))
    )


def bare_array(_: str) -> Column:
    return F.to_json(F.array("record"))


def bare_object(_: str) -> Column:
    return F.to_json("record")


def pages(standins: Standins, endpoint: str, shape: Callable[[str], Column] = envelope) -> DataFrame:
    """Every record as a page of its own."""
    return records(standins, endpoint).select(
        request_id().alias("request_id"), "Academy", "DataSet", "NCYear", "Date",
        F.lit(None).cast("timestamp_ntz").alias("fetched_at"), F.lit(1).alias("page_no"),
        F.lit(None).cast("long").alias("cursor_in"), shape(endpoint).alias("body"), "endpoint",
    )


def ingest(
    standins: Standins, endpoint: str, table: str, shape: Callable[[str], Column] = envelope
) -> DataFrame:
    """Source rows -> JSON pages -> parsed records -> the rows of one table."""
    parsed = parse_pages(pages(standins, endpoint, shape), ENDPOINTS[endpoint])
    return flatten(records_of(parsed.filter("page_ok")), endpoint)[table].drop(*REQUEST)


# --- landings of many pages per request ---------------------------------------------------------------------------

BLOCK = 1000
PAGE_SIZE = 50


def landing(
    standins: Standins, endpoint: str, table: str, number: str, record: str, fetched_at: str
) -> DataFrame:
    """Requests of many pages: ``BLOCK`` consecutive rows of ``table`` are one day's request of one academy.

    The rows are numbered without gaps by ``number``, so a request holds at most ``BLOCK`` and a page at most
    ``PAGE_SIZE`` records whatever the table holds. ``record`` may use ``asked``, the request's day.
    """
    block = f"cast(floor({number}/{BLOCK}) as int)"
    place = f"cast(floor(({number}-{block}*{BLOCK})/{PAGE_SIZE}) as int)"
    rows = standins.sql(f"""
        select concat('A',cast(block%5 as string)) Academy, '2021' DataSet, cast(null as int) NCYear, asked Date,
          '{endpoint}' endpoint, place+1 page_no, {record} record
        from (select *, date_add(DATE '2024-01-01', block) asked
          from (select *, {block} block, {place} place from {{{table}}}))""")
    request = ("Academy", "DataSet", "NCYear", "Date", "endpoint")
    paged = rows.groupBy(*request, "page_no").agg(F.collect_list("record").alias("records"))
    last = paged.groupBy("Academy", "Date").agg(F.max("page_no").alias("last"))
    paged = paged.join(last, ["Academy", "Date"])
    more = F.col("page_no") < F.col("last")
    cursor = F.when(more, F.col("page_no") * 7)
    body = F.to_json(
        F.struct(F.col("records").alias(ENDPOINTS[endpoint].key), more.alias("has_more"), cursor.alias("cursor"))
    )
    return paged.select(
        request_id().alias("request_id"), "Academy", "DataSet", "NCYear", "Date",
        F.lit(fetched_at).cast("timestamp_ntz").alias("fetched_at"), "page_no",
        F.when(F.col("page_no") > 1, (F.col("page_no") - 1) * 7).cast("long").alias("cursor_in"),
        body.alias("body"), "endpoint",
    )

"""Request plans, page chains, slice replacement, checks, the sync log, and whole jobs."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.operators import checks, replace, synclog
from rollbook.operators.joins import look_up
from rollbook.plans import cascades
from rollbook.plans.jobs import sync_requests
from rollbook.plans.requests import plan_endpoints
from rollbook.schemas.endpoints import ENDPOINTS
from rollbook.schemas.tables import TABLES
from rollbook.session import scratch_path
from rollbook.sources.chains import numbered_chains
from rollbook.sources.landing import chain_status, land, parse_pages, read_landing
from rollbook.sources.warehouse import Warehouse, grade_types
from rollbook.streaming.rolling import requests_of, rolling_sync
from standins.catalogue import register
from standins.pages import BLOCK, PAGE_SIZE, landing
from standins.relations import RELATIONS, Standins
from standins.stored import store



# --- page chains ------------------------------------------------------------------------------------------------

# Eight consecutive events are one request of eight pages. Some pages hand on a wrong cursor, end the chain early
# or cannot be read.
_CHAIN = """
    select floor(event_id/8) request_no, cast(event_id%8+1 as int) page_no,
      case when event_id%8>0 then event_id end cursor_in, event_type='signup' and value<5 unreadable,
      event_id%8<7 and not (event_type='purchase' and value<2) has_more,
      case when event_type='error' and value<3 then event_id+1000000 else event_id+1 end cursor_out, event_id
    from {events}
    """


def _chain(t: Standins) -> DataFrame:
    page = F.struct(
        F.array(F.struct(F.col("event_id").alias("id"))).alias("departments"), "has_more",
        F.col("cursor_out").alias("cursor"),
    )
    pages = t.sql(_CHAIN).select(
        F.concat(F.lit("r"), F.col("request_no").cast("string")).alias("request_id"),
        F.lit("A0").alias("Academy"), F.lit("2021").alias("DataSet"), F.lit(None).cast("int").alias("NCYear"),
        F.lit(None).cast("date").alias("Date"), "page_no", F.col("cursor_in").cast("long").alias("cursor_in"),
        F.when(F.col("unreadable"), F.lit('{"has_more":false}')).otherwise(F.to_json(page)).alias("body"),
    )
    return chain_status(parse_pages(pages, ENDPOINTS["departments"]))


# Orders as pages that only know cursors: those of one priority are one request of very many pages, those of one
# customer with a second one short requests. The lineitems' first shipping decides what is wrong with a request: of the
# short ones some have lost their first page, hand on one cursor twice, or run in a circle.
_CURSORS = """
    select request_id, n, place, case when place>1 then lag(own) over (partition by request_id order by place) end cursor_in,
      own cursor_out, place<pages has_more, pages, fault
    from (select *, row_number() over (partition by request_id order by n) place,
        count(*) over (partition by request_id) pages, n*7+3 own
      from (select concat('long ',o_orderpriority) request_id, o_orderkey n, 'none' fault from {orders}
        union all select concat('short ',cast(o_custkey as string)), o_orderkey,
          case o_custkey%7 when 1 then 'gap' when 2 then 'fork' when 3 then 'circle' else 'none' end from {orders}))
    """
_FAULTY_CURSORS = f"""
    select request_id, n, place, fault, pages,
      case when fault='circle' and place=1 then pages_end else cursor_in end cursor_in,
      case when fault='fork' and place=pages and pages>1 then first_out else cursor_out end cursor_out,
      case when fault='fork' and place=pages and pages>1 then true when fault='circle' then true else has_more end has_more
    from (select *, max(cursor_out) over (partition by request_id) pages_end,
        min(cursor_out) over (partition by request_id) first_out from ({_CURSORS}))
    where not (fault='gap' and place=1)
    """


def _cursor_chains(t: Standins) -> DataFrame:
    pages = t.sql(_FAULTY_CURSORS).select("request_id", "n", "cursor_in", "cursor_out", "has_more")
    return numbered_chains(pages).select("request_id", "n", "page_no", "chain_problem")


register(
    "page_chain_cursors",
    _cursor_chains,
    f"""
    select request_id, n, case when fault='none' or (fault='fork' and pages=1) then cast(place as int) end page_no,
      case when fault in ('gap','circle') then 'circle or gap' when fault='fork' and pages>1 then 'fork' end chain_problem
    from ({_FAULTY_CURSORS})
    """,
)

register(
    "page_chain_status",
    _chain,
    f"""
    with p as ({_CHAIN}),
    q as (select request_no, page_no, cursor_in, unreadable, has_more and not unreadable has_more,
      case when not unreadable then cursor_out end cursor_out from p),
    links as (
      select coalesce(a.request_no,d.request_no) request_no,
        case when a.page_no is null or d.page_no is null or a.cursor_in is distinct from d.cursor_out then 1
          else 0 end broken
      from (select * from q where page_no>1) a
      full join (select * from q where has_more) d on d.request_no=a.request_no and d.page_no+1=a.page_no),
    broken as (select request_no, cast(sum(broken) as bigint) n from links group by request_no),
    counted as (select request_no, count(*) pages,
      cast(sum(case when unreadable then 1 else 0 end) as bigint) unreadable,
      sum(case when page_no=1 and cursor_in is null then 1 else 0 end) first_pages,
      sum(case when not has_more then 1 else 0 end) last_pages from q group by request_no)
    select concat('r',cast(cast(c.request_no as bigint) as string)) request_id, c.pages, c.unreadable,
      coalesce(b.n,0) broken_links,
      case when c.unreadable>0 then 'unreadable page'
        when first_pages<>1 or last_pages<>1 or coalesce(b.n,0)>0 then 'broken page chain' end problem
    from counted c left join broken b on b.request_no=c.request_no
    """,
)

# --- request plans ----------------------------------------------------------------------------------------------

AS_OF = date(2024, 1, 10)
_SHOWN = ("endpoint", "Academy", "DataSet", "NCYear", "YearGroup", "Date", "DateText")


def _plan(t: Standins, scope: str) -> DataFrame:
    wanted = [e for e in ENDPOINTS.values() if e.scope == scope]
    return plan_endpoints(t["AcademySecurity"], AS_OF, wanted).select(*_SHOWN)


def _listed(scope: str, *more: str) -> str:
    rows = []
    for e in (e for e in ENDPOINTS.values() if e.scope == scope):
        flag = {"GetLessonAttendance": 1, "GetSessionAttendance": 2, "GetBehaviour": 3}.get(e.enabled_by, 0)
        rows.append(f"('{e.name}',{flag}{''.join(',' + m for m in more)})")
    return ", ".join(rows)


_ENABLED = (
    "case flag when 1 then GetLessonAttendance when 2 then GetSessionAttendance when 3 then GetBehaviour "
    "else true end"
)
register(
    "plan_plain",
    lambda t: _plan(t, "year"),
    f"""
    select endpoint, AcademyCode Academy, CurrentAcademicYear DataSet, cast(null as int) NCYear,
      cast(null as string) YearGroup, cast(null as date) as Date, cast(null as string) DateText
    from {{AcademySecurity}}, (values {_listed("year")}) as e(endpoint, flag) where Active and {_ENABLED}
    """,
)
register(
    "plan_year_groups",
    lambda t: _plan(t, "year_group"),
    f"""
    select endpoint, AcademyCode Academy, CurrentAcademicYear DataSet, cast(y as int) NCYear,
      case when y=0 then 'Reception' else cast(y as string) end YearGroup, cast(null as date) as Date,
      cast(null as string) DateText
    from {{AcademySecurity}}, (values {_listed("year_group")}) as e(endpoint, flag),
      unnest(range(LowestYear, HighestYear+1)) as r(y)
    where Active
    """,
)
register(
    "plan_date_window",
    lambda t: _plan(t, "day"),
    f"""
    select endpoint, AcademyCode Academy, CurrentAcademicYear DataSet, cast(null as int) NCYear,
      cast(null as string) YearGroup, cast(d as date) as Date, strftime(d,'%Y-%m-%d') DateText
    from (select *, case flag when 3 then coalesce(BehaviourFrom, DATE '2023-12-27')
          when 2 then coalesce(AttendanceFrom, DATE '2024-01-03')
          else coalesce(AttendanceFrom, DATE '2024-01-09') end f,
        case flag when 3 then coalesce(BehaviourTo, DATE '2024-01-10')
          when 2 then coalesce(AttendanceTo, DATE '2024-01-10')
          else coalesce(AttendanceTo, DATE '2024-01-09') end l
      from {{AcademySecurity}}, (values {_listed("day")}) as e(endpoint, flag) where Active and {_ENABLED}),
      unnest(generate_series(cast(f as timestamp), cast(l as timestamp), interval 1 day)) as r(d)
    """,
)

# --- replacing slices -------------------------------------------------------------------------------------------


def _replace(
    table: str, condition: str, incoming: str, changed: dict[str, str]
) -> tuple:
    """A replacement of the slices of ``table`` that meet ``condition`` by their changed rows, and its SQL."""
    on = TABLES[table].slice
    names = [f.name for f in TABLES[table].storage_schema.fields]

    def build(t: Standins) -> DataFrame:
        existing = t[table].select(*names)
        asked = existing.filter(condition)
        rows = asked.filter(incoming).withColumns({c: F.expr(e) for c, e in changed.items()})
        return replace.replace_slices(existing, rows, asked.select(*on), on)

    new = ", ".join(f"{changed[n]} as {n}" if n in changed else n for n in names)
    kept = ", ".join(names)
    sql = (
        f"select {kept} from {{{table}}} where not ({condition}) "
        f"union all select {new} from {{{table}}} where ({condition}) and ({incoming})"
    )
    return build, sql


_IN_SLICE = "Academy='A1' and DataSet='2020'"
register("replace_slice", *_replace("Subjects", _IN_SLICE, "IncludeInStats", {"Name": "upper(Name)"}))
register(
    "replace_slice_group",
    *_replace("AttributeValues", _IN_SLICE + " and AttributeGroup='Send'", "Value is not null", {"Value": "'new'"}),
)
register(
    "replace_slice_year",
    *_replace("Grades", _IN_SLICE + " and NCYear between 1 and 6", "GradeTypeId<>6", {"Name": "lower(Name)"}),
)
register(
    "replace_slice_date",
    *_replace(
        "StudentSessionMarks", _IN_SLICE + " and Date between DATE '2024-01-10' and DATE '2024-01-16'",
        "Session='PM'", {"SessionNotes": "'late'"},
    ),
)
register("replace_slice_empty", *_replace("Subjects", _IN_SLICE, "false", {}))


_NEW_EVENTS = """
    select {columns} from {{BehEvents}}
    where Closed and EventDay between DATE '1998-02-01' and DATE '1998-02-28'
    """
_MONTH = "EventDay between DATE '1998-01-01' and DATE '1998-01-31'"


def _replaced_events(t: Standins, by: str) -> tuple[DataFrame, DataFrame]:
    """January is asked for again; it brings February's closed events under their old ids, a month earlier.

    Open events happen at nine, so that a day and its midnight differ.
    """
    at = F.when(F.col("Closed"), F.col("EventDate")).otherwise(F.expr("EventDate + interval 9 hours"))
    events = t["BehEvents"].select("BehEventId", "Academy", "DataSet", at.alias("EventDate"), "EventDay", "Closed")
    sent = t.sql(_NEW_EVENTS.format(columns="*"))
    new_events = sent.select(
        "BehEventId", "Academy", "DataSet", F.expr("EventDate - interval 31 days").alias("EventDate"),
        F.expr("EventDay - 31").alias("EventDay"), "Closed",
    )
    new_involved = sent.select("BehEventId", F.lit("X").alias("StudentId"))
    days = events.filter(_MONTH).select("Academy", "DataSet", F.col("EventDay").alias("Date"))
    involved = t["BehEventStudents"].select("BehEventId", "StudentId")
    return replace.replace_events(events, involved, new_events, new_involved, days, by)


def _kept_events(by: str) -> str:
    gone = _MONTH if by == "day" else f"({_MONTH} and Closed)"
    new = _NEW_EVENTS.format(columns="BehEventId")
    return f"select * from {{BehEvents}} where not ({gone}) and BehEventId not in ({new})"


for _by, _name in (("day", "replace_events_collision"), ("exact", "replace_events_exact")):
    register(
        _name,
        lambda t, by=_by: _replaced_events(t, by)[0],
        f"""
        select BehEventId, Academy, DataSet,
          case when Closed then EventDate else EventDate + interval 9 hours end EventDate, EventDay, Closed
        from ({_kept_events(_by)})
        union all
        {_NEW_EVENTS.format(columns="BehEventId, Academy, DataSet, EventDate - interval 31 days, "
                                    "cast(EventDay - 31 as date), Closed")}
        """,
    )
register(
    "replace_events_collision__students",
    lambda t: _replaced_events(t, "day")[1],
    f"""
    select BehEventId, StudentId from {{BehEventStudents}}
    where BehEventId in (select BehEventId from ({_kept_events("day")}))
    union all {_NEW_EVENTS.format(columns="BehEventId, 'X'")}
    """,
)

_NEW_STAFF = """
    select c_custkey StaffId, concat('A',cast(c_nationkey%5 as string)) Academy, 'new' EmailAddress,
      cast(null as string) FirstName, c_name LastName, cast(null as string) DisplayName, 'Prof' Title
    from {customer} where c_mktsegment='BUILDING'
    """
register(
    "upsert_staff",
    lambda t: replace.upsert_by_id(t["Staff"], t.sql(_NEW_STAFF), "StaffId"),
    f"""
    select * from {{Staff}} where StaffId not in (select StaffId from ({_NEW_STAFF})) union all
    select StaffId, Academy, EmailAddress, FirstName, LastName, DisplayName, Title from ({_NEW_STAFF})
    """,
)

_SHEETS_GONE = f"select MarksheetId from {{Marksheets}} where {_IN_SLICE}"


def _children(t: Standins) -> DataFrame:
    grades, sheets = t["MarksheetGrades"], t["Marksheets"]
    asked = sheets.filter(_IN_SLICE)
    incoming = grades.join(asked.select("MarksheetId"), "MarksheetId", "left_semi").filter("Grade<>'N'")
    incoming = incoming.withColumn("Alias", F.lit("again"))
    return replace.replace_children(grades, incoming, sheets, "MarksheetId", asked, ("Academy", "DataSet"))


register(
    "append_children_of_replaced_parent",
    _children,
    f"""
    select MarksheetId, StudentId, Grade, Alias, DataSet, Academy from {{MarksheetGrades}}
    where MarksheetId not in ({_SHEETS_GONE}) union all
    select MarksheetId, StudentId, Grade, 'again', DataSet, Academy from {{MarksheetGrades}}
    where MarksheetId in ({_SHEETS_GONE}) and Grade<>'N'
    """,
)

# --- cascades ---------------------------------------------------------------------------------------------------

_GONE_SUBJECTS = "select SubjectId from {Subjects} where QAN='Brand#13'"
_BELOW_SUBJECTS = {
    "Subjects": "SubjectId not in (select SubjectId from s)",
    "Groups": "SubjectId not in (select SubjectId from s)",
    "GroupStudents": "GroupId not in (select GroupId from g)",
    "GroupTeachers": "GroupId not in (select GroupId from g)",
    "Marksheets": "SubjectId not in (select SubjectId from s)",
    "Markslots": "MarksheetId not in (select MarksheetId from m)",
    "MarksheetGrades": "MarksheetId not in (select MarksheetId from m)",
    "MarkslotMarks": "MarkslotId not in (select MarkslotId from l)",
    "Grades": "SubjectId not in (select SubjectId from s)",
    "ExamResults": "(SubjectId is null or SubjectId not in (select SubjectId from s))",
}
_GONE = f"""
    with s as ({_GONE_SUBJECTS}),
    g as (select GroupId from {{Groups}} where SubjectId in (select SubjectId from s)),
    m as (select MarksheetId from {{Marksheets}} where SubjectId in (select SubjectId from s)),
    l as (select MarkslotId from {{Markslots}} where MarksheetId in (select MarksheetId from m))
    """


def _cascade(t: Standins) -> dict[str, DataFrame]:
    tables = {name: t[name] for name in RELATIONS if name in TABLES}
    return replace.cascade_delete(tables, "Subjects", t.sql(_GONE_SUBJECTS))


def _cascade_counts(t: Standins) -> DataFrame:
    left = _cascade(t)
    counts = [
        left[name].agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name in _BELOW_SUBJECTS
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


register(
    "cascade_delete_subjects",
    _cascade_counts,
    _GONE + " union all ".join(
        f"select '{n}' table_name, count(*) as rows from {{{n}}} where {w}" for n, w in _BELOW_SUBJECTS.items()
    ),
)
register(
    "cascade_delete_subjects__MarkslotMarks",
    lambda t: _cascade(t)["MarkslotMarks"].withColumn("Mark", F.col("Mark").cast("double")),
    _GONE + f"""select MarkslotId, StudentId, Grade, Alias, cast(Mark as double) Mark, DataSet, Academy
    from {{MarkslotMarks}} where {_BELOW_SUBJECTS["MarkslotMarks"]}""",
)

# Students who leave a stored warehouse; what hangs on them goes from its slices, all others are left alone.
_GONE_STUDENTS = "select StudentId from {Students} where Academy='A1' and DataSet='2020' and MiddleNames is null"
_BELOW_STUDENTS = ("Students", *[n for n in RELATIONS if n in TABLES and any(p.table == "Students" for p in TABLES[n].parents)])


def _stored_cascade(t: Standins) -> Warehouse:
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    store(warehouse, t, _BELOW_STUDENTS)
    cascades.delete_stored(warehouse, "Students", warehouse.read("Students").where(_GONE_STUDENTS.split("where ")[1]))
    return warehouse


def _stored_counts(t: Standins) -> DataFrame:
    warehouse = _stored_cascade(t)
    counts = [
        warehouse.read(name).groupBy("Academy", "DataSet").agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(name))
        for name in _BELOW_STUDENTS
    ]
    return reduce(DataFrame.unionByName, counts)


register(
    "cascade_stored_students",
    _stored_counts,
    " union all ".join(
        f"select '{n}' table_name, Academy, DataSet, count(*) as rows from {{{n}}} "
        f"where StudentId is null or StudentId not in ({_GONE_STUDENTS}) group by Academy, DataSet"
        for n in _BELOW_STUDENTS
    ),
)
register(
    "cascade_stored_students__Grades",
    lambda t: _stored_cascade(t).read("Grades"),
    f"""select GradeTypeId, SubjectId, StudentId, Name, Alias, DataSet, Academy, NCYear from {{Grades}}
    where StudentId not in ({_GONE_STUDENTS})""",
)

# --- checks -----------------------------------------------------------------------------------------------------

for _table in ("StudentSessionMarks", "MarkslotMarks", "Grades"):
    _key = TABLES[_table].key
    register(
        "pk_violations" if _table == "StudentSessionMarks" else f"pk_violations__{_table}",
        lambda t, n=_table, k=_key: checks.key_violations(t[n], k),
        f"select {', '.join(_key)}, count(*) as rows from {{{_table}}} group by {', '.join(_key)} having count(*)>1",
    )

# Documents read as lesson notes: whole texts against the limits of the lesson mark table.
_NOTES = """
    select lang DataSet, source Academy, concat('S',cast(doc_id as string)) StudentId, DATE '2024-01-01' as Date,
      concat(source,'-',cast(doc_id as string)) ClassId, lang LessonMarkId, cast(null as string) LessonAliasId,
      text LessonNotes
    from {documents}
    """
_NOTE_LIMITS = {c: n for c, n in TABLES["StudentLessonMarks"].limits.items()}
register(
    "length_violations",
    lambda t: checks.length_violations(t.sql(_NOTES), "StudentLessonMarks"),
    " union all ".join(
        f"select '{c}' column_name, cast({n} as int) max_length, "
        f"cast(coalesce(sum(case when length({c})>{n} then 1 else 0 end),0) as bigint) as rows from ({_NOTES})"
        for c, n in _NOTE_LIMITS.items()
    ),
)

_EDGES = [
    (name, parent) for name in RELATIONS for parent in TABLES[name].parents if parent.table in RELATIONS
]
register(
    "orphan_report",
    lambda t: checks.orphan_report({name: t[name] for name in RELATIONS}),
    " union all ".join(
        f"select '{name}' child, '{p.column}' child_column, '{p.table}' parent, count(*) orphans from {{{name}}} c "
        f"where c.{p.column} is not null and not exists "
        f"(select 1 from {{{p.table}}} p where p.{TABLES[p.table].key[0]}=c.{p.column})"
        for name, p in _EDGES
    ),
)

# --- grade types -------------------------------------------------------------------------------------------------

register(
    "grade_types_seed",
    lambda t: look_up(
        t["GradeNames"].select("GradeNameId", "GradeTypeId", "Name"), grade_types(t.spark),
        {"GradeTypeId": "GradeTypeId"}, {"Name": "GradeType"},
    ),
    """
    select n.GradeNameId, n.GradeTypeId, n.Name, g.Name GradeType
    from {GradeNames} n left join {GradeTypes} g on g.GradeTypeId=n.GradeTypeId
    """,
)

# --- sync log ---------------------------------------------------------------------------------------------------

register(
    "sync_log_summary",
    lambda t: synclog.log_summary(t["SyncResults"]),
    """
    select AcademyCode, EndPoint, LoggedAt, Result LastResult, requests, failures
    from (select *, row_number() over (partition by AcademyCode, EndPoint order by LoggedAt desc, Result) rn,
        count(*) over (partition by AcademyCode, EndPoint) requests,
        cast(sum(case when Result then 0 else 1 end) over (partition by AcademyCode, EndPoint) as bigint) failures
      from {SyncResults})
    where rn=1
    """,
)
register(
    "failed_requests",
    lambda t: synclog.failed_requests(t["SyncResults"]),
    "select * from {SyncResults} where not Result",
)

# --- jobs -------------------------------------------------------------------------------------------------------

_EVENT_RECORD = """struct(o_orderkey id, o_custkey event_type_id,
    date_format(asked, "yyyy-MM-dd'T'10:30:00'Z'") event_date, o_orderstatus='F' closed,
    concat('S',cast(o_custkey as string)) subject_code, {note} school_notes, o_custkey created_by,
    array(o_custkey) student_ids)"""
_FIRST, _SECOND = "2024-06-01 06:00:00", "2024-06-02 06:00:00"


def _behaviour_job(t: Standins) -> Warehouse:
    """All days are loaded, then those of two academies again: one with changed notes, one whose first pages are
    missing, so that its old rows stay."""
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    first = landing(t, "beh_events", "orders", "o_orderkey", _EVENT_RECORD.format(note="'first'"), _FIRST)
    again = landing(t, "beh_events", "orders", "o_orderkey", _EVENT_RECORD.format(note="'again'"), _SECOND)
    again = again.filter("Academy='A1' or (Academy='A2' and page_no>1)")
    folder = scratch_path(t.spark, "landing")
    for pages, at in ((first, _FIRST), (again, _SECOND)):
        land(pages, folder)
        landed = read_landing(t.spark, folder)
        asked = requests_of(landed.filter(F.col("fetched_at") == F.lit(at).cast("timestamp_ntz")))
        sync_requests(warehouse, landed, asked, ["beh_events"])
    return warehouse


_JOB_ROWS = f"""
    select *, cast(floor(o_orderkey/{BLOCK}) as int) block,
      DATE '2024-01-01'+cast(floor(o_orderkey/{BLOCK}) as int) EventDay from orders
    """
register(
    "sync_behaviour_days",
    lambda t: _behaviour_job(t).read("BehEvents").select(
        "BehEventId", "Academy", "DataSet", "BehEventTypeId", "EventDate", "EventDay", "Closed", "Cancelled",
        "SubjectCode", "SchoolNotes", "CreatedByStaffId",
    ),
    f"""
    select o_orderkey BehEventId, concat('A',cast(block%5 as string)) Academy, '2021' DataSet,
      o_custkey BehEventTypeId, EventDay + interval 630 minutes EventDate, EventDay, o_orderstatus='F' Closed,
      false Cancelled, concat('S',cast(o_custkey as string)) SubjectCode,
      case when block%5=1 then 'again' else 'first' end SchoolNotes, o_custkey CreatedByStaffId
    from ({_JOB_ROWS})
    """,
)

register(
    "sync_behaviour_days__log",
    lambda t: _behaviour_job(t).read("SyncResults").select(
        "AcademyCode", "DataSet", "Date", "Result", "Exception", "InnerException"
    ),
    f"""
    with asked as (select block, EventDay, count(*) n from ({_JOB_ROWS}) group by block, EventDay),
    runs as (select block, EventDay, cast(null as string) problem from asked
      union all select block, EventDay, case block%5 when 2 then 'broken page chain' end from asked
      where block%5=1 or (block%5=2 and n>{PAGE_SIZE}))
    select concat('A',cast(block%5 as string)) AcademyCode, '2021' DataSet, EventDay as Date,
      problem is null as Result, problem Exception, cast(null as string) InnerException
    from runs
    """,
)

_LESSON_RECORD = """struct(date_format(asked, "yyyy-MM-dd'T'00:00:00'Z'") date, user_id student_id,
    event_id class_id, ascii(event_type) lesson_mark_id, {note} lesson_notes)"""


def _rolling_job(t: Standins) -> DataFrame:
    """A stream loads all days; one academy's days arrive again later and are replaced."""
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    folder, checkpoint = scratch_path(t.spark, "landing"), scratch_path(t.spark, "stream")
    for note, at, which in (("'first'", _FIRST, "true"), ("'again'", _SECOND, "Academy='A1'")):
        pages = landing(t, "lesson_marks", "events", "event_id", _LESSON_RECORD.format(note=note), at).filter(which)
        land(pages, folder)
        rolling_sync(warehouse, folder, checkpoint, ["lesson_marks"]).awaitTermination()
    return warehouse.read("StudentLessonMarks")


register(
    "stream_rolling_days",
    _rolling_job,
    f"""
    with e as (select *, cast(floor(event_id/{BLOCK}) as int) block from events)
    select '2021' DataSet, concat('A',cast(block%5 as string)) Academy,
      concat('A',cast(block%5 as string),'2021-',cast(user_id as string)) StudentId,
      cast(DATE '2024-01-01'+block as date) as Date,
      concat('A',cast(block%5 as string),'2021-',cast(event_id as string)) ClassId,
      concat('A',cast(block%5 as string),'2021-',cast(ascii(event_type) as string)) LessonMarkId,
      cast(null as string) LessonAliasId, cast(null as int) LessonMinutesLate,
      case when block%5=1 then 'again' else 'first' end LessonNotes
    from e
    """,
)

# Requests of 40 parts each bring classifications with globally unique numbers, first all well, then: of five requests
# in a row the first has lost its first page, the second also brings the first one's numbers, the third brings each
# number twice, the fourth new numbers, and the fifth the fourth one's.
_CLASS_BLOCK = 40
_CLASSES = f"(select *, cast(floor(p_partkey/{_CLASS_BLOCK}) as int) block from {{part}})"
_NEW = 1_000_000
_SECOND_CLASSES = f"""
    select block, p_partkey id from {_CLASSES} where block%5 in (0,1,2)
    union all select block, p_partkey from {_CLASSES} where block%5=2
    union all select block+1, p_partkey from {_CLASSES}
      where block%5=0 and block<(select max(block) from {_CLASSES})
    union all select block, p_partkey+{_NEW} from {_CLASSES} where block%5=3
    union all select block, p_partkey+{_NEW}-{_CLASS_BLOCK} from {_CLASSES} where block%5=4
    """


def _class_pages(t: Standins, rows: str, note: str, at: str, lost: str) -> DataFrame:
    endpoint = ENDPOINTS["beh_classifications"]
    requests = t.sql(rows).groupBy("block").agg(
        F.collect_list(F.struct("id", F.lit(note).alias("name"), F.lit(1).alias("score"))).alias("records")
    )
    academy_code = F.concat(F.lit("B"), F.lpad(F.col("block").cast("string"), 9, "0"))
    return requests.select(
        F.concat(F.lit("beh_classifications|"), academy_code).alias("request_id"), academy_code.alias("Academy"),
        F.lit("2021").alias("DataSet"), F.lit(None).cast("int").alias("NCYear"), F.lit(None).cast("date").alias("Date"),
        F.lit(at).cast("timestamp_ntz").alias("fetched_at"), F.when(F.expr(lost), 2).otherwise(1).alias("page_no"),
        F.lit(None).cast("long").alias("cursor_in"),
        F.to_json(F.struct(F.col("records").alias(endpoint.key), F.lit(False).alias("has_more"))).alias("body"),
        F.lit("beh_classifications").alias("endpoint"),
    )


def _key_conflicts_job(t: Standins) -> Warehouse:
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    folder = scratch_path(t.spark, "landing")
    runs = ((f"select block, p_partkey id from {_CLASSES}", "first", _FIRST, "false"), (_SECOND_CLASSES, "again", _SECOND, "block%5=0"))
    for rows, note, at, lost in runs:
        land(_class_pages(t, rows, note, at, lost), folder)
        landed = read_landing(t.spark, folder)
        sync_requests(warehouse, landed, requests_of(landed), ["beh_classifications"])
    return warehouse


_STORED_CLASSES = _CLASSES.replace("{part}", "part")
register(
    "sync_key_conflicts",
    lambda t: _key_conflicts_job(t).read("BehClassifications").select("BehClassificationId", "Academy", "DataSet", "Name", "Score"),
    f"""
    select case when block%5=3 then p_partkey+{_NEW} else p_partkey end BehClassificationId,
      concat('B',lpad(cast(block as string),9,'0')) Academy, '2021' DataSet,
      case when block%5=3 then 'again' else 'first' end as Name, cast(1 as int) Score
    from {_STORED_CLASSES}
    """,
)
register(
    "sync_key_conflicts__log",
    lambda t: _key_conflicts_job(t).read("SyncResults").select("AcademyCode", "Result", "Exception", "InnerException"),
    f"""
    select concat('B',lpad(cast(block as string),9,'0')) AcademyCode, problem is null as Result, problem Exception,
      case when block%5 in (1,2,4) and run=2 then 'BehClassifications' end InnerException
    from (select *, case when run=2 then
        case block%5 when 0 then 'broken page chain' when 1 then 'key held by another slice'
          when 2 then 'duplicate key' when 4 then 'duplicate key' end end problem
      from (select distinct block from {_STORED_CLASSES}) cross join (values (1),(2)) as r(run))
    """,
)

"""Whole jobs: every request of a run is planned, answered, stored and logged; tables and log come back as one result.

Every supplier is an academy of its own. Customers are students, orders behaviour events, events session marks; all
other endpoints answer with empty pages. Some academies answer badly, by their number s:

* students: dates that are none (s%7=1), a text that is too long (2), a page that cannot be read (3)
* grade names: the second year group cannot be read (s%5=0), so the later ones are not asked for
* behaviour events: events of another day (s%7=4)
* staff: no page at all (s%5=0)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.plans import jobs
from rollbook.plans.requests import request_plan
from rollbook.schemas.endpoints import ENDPOINTS
from rollbook.session import materialize, scratch_path
from rollbook.sources.landing import land, read_landing
from rollbook.sources.warehouse import Warehouse
from standins.catalogue import register
from standins.maintenance_queries import AS_OF
from standins.relations import Standins

_DAY = f"DATE '{AS_OF}'"
_SCHOOL = "cast({n}%(select count(*) from {{supplier}})+(select min(s_suppkey) from {{supplier}}) as bigint)"


def _school(n: str) -> str:
    return _SCHOOL.format(n=n).replace("{{", "{").replace("}}", "}")


# (s, day, id, other): what the academies hold, in both dialects.
_STUDENTS = f"select {_school('c_custkey')} s, cast(null as date) as day, c_custkey id, c_name other from {{customer}}"
_MARKS = f"select {_school('user_id')} s, cast({_DAY}-cast(event_id%8 as int) as date) as day, event_id id, event_type other from {{events}}"
_EVENTS = f"select {_school('o_custkey')} s, cast({_DAY}-cast(o_orderkey%15 as int) as date) as day, o_orderkey id, o_orderstatus other from {{orders}}"

_RECORDS = {
    "students": (_STUDENTS, """struct(id, case when s%7=1 then 'no date' else '2010-02-03T00:00:00Z' end date_of_birth,
        case when s%7=2 then 'FF' else 'F' end sex, other legal_last_name)"""),
    "session_marks": (_MARKS, """struct(date_format(day, "yyyy-MM-dd'T'00:00:00'Z'") date, 'AM' session, id student_id,
        ascii(other) session_mark_id)"""),
    "beh_events": (_EVENTS, """struct(id, date_format(date_add(day, case when s%7=4 then 1 else 0 end), "yyyy-MM-dd'T'10:30:00'Z'")
        event_date, other group_name, array(id+1) student_ids)"""),
}


def _answers(t: Standins, plan: DataFrame) -> DataFrame:
    """The landed page of every request in the plan that is answered."""
    asked = plan.withColumn("s", F.substring("Academy", 2, 19).cast("bigint"))
    answers = []
    for name, endpoint in ENDPOINTS.items():
        own = asked.where(F.col("endpoint") == name)
        records = F.array().cast(f"array<struct<{endpoint.record}>>")
        if name in _RECORDS:
            rows, record = _RECORDS[name]
            held = t.sql(rows).groupBy("s", "day").agg(F.collect_list(F.expr(record)).alias("records"))
            own = own.join(held, (own["s"] == held["s"]) & own["Date"].eqNullSafe(held["day"]), "left").drop(held["s"])
            records = F.col("records")
        if name == "grade_names":
            records = F.transform(F.array(F.lit(1), F.lit(2)), lambda n: F.struct(n.alias("id"), F.lit("grade").alias("name")))
        body = F.to_json(F.struct(F.coalesce(records, F.array()).alias(endpoint.key), F.lit(False).alias("has_more")))
        answers.append(own.select("request_id", "endpoint", "Academy", "DataSet", "NCYear", "Date", "s", body.alias("body")))
    pages = reduce(DataFrame.unionByName, answers)
    low = t["AcademySecurity"].select(F.col("AcademyCode").alias("Academy"), "LowestYear")
    unread = (F.col("endpoint") == "students") & (F.col("s") % 7 == 3)
    unread = unread | ((F.col("endpoint") == "grade_names") & (F.col("s") % 5 == 0) & (F.col("NCYear") == F.col("LowestYear") + 1))
    return pages.where("endpoint<>'staff' or s%5<>0").join(low, "Academy").select(
        "request_id", "Academy", "DataSet", "NCYear", "Date", F.lit("2024-01-10 02:00:00").cast("timestamp_ntz").alias("fetched_at"),
        F.lit(1).alias("page_no"), F.lit(None).cast("long").alias("cursor_in"), F.when(unread, "{oops").otherwise(F.col("body")).alias("body"), "endpoint",
    )


def _job(t: Standins, areas: tuple[str, ...], dataset: str | None = None) -> DataFrame:
    config = t["AcademySecurity"]
    folder = scratch_path(t.spark, "landing")
    # Written out: every endpoint's answers are made from it.
    plan = materialize(request_plan(config, AS_OF, areas, dataset), "plan")
    land(_answers(t, plan), folder)
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    log = jobs.run_sync(warehouse, read_landing(t.spark, folder), config, AS_OF, areas, dataset)
    return reduce(DataFrame.unionByName, [_shown(log), *[warehouse.read(n).selectExpr(f"'{n}' what", *e) for n, e in _TABLES.items()]])


def _shown(log: DataFrame) -> DataFrame:
    detail = F.concat_ws(" ", F.coalesce("Exception", F.lit("stored")), "InnerException")
    return log.select(
        F.lit("log").alias("what"), F.col("AcademyCode").alias("Academy"), "DataSet", F.col("YearGroup").alias("NCYear"), "Date",
        F.translate("EndPoint", "{}", "").alias("name"), detail.alias("detail"),
    )


_TABLES = {
    "Students": ("Academy", "DataSet", "cast(null as int) NCYear", "cast(null as date) Date", "StudentId name", "LegalLastName detail"),
    "GradeNames": ("Academy", "DataSet", "NCYear", "cast(null as date) Date", "GradeNameId name", "Name detail"),
    "StudentSessionMarks": ("Academy", "DataSet", "cast(null as int) NCYear", "Date", "StudentId name", "SessionMarkId detail"),
    "BehEvents": ("Academy", "DataSet", "cast(null as int) NCYear", "EventDay Date", "cast(BehEventId as string) name", "GroupName detail"),
    "BehEventStudents": ("Academy", "DataSet", "cast(null as int) NCYear", "EventDay Date", "cast(BehEventId as string) name", "StudentId detail"),
}


def _oracle(areas: tuple[str, ...], dataset: str | None = None) -> str:
    flags = {"GetLessonAttendance": 1, "GetSessionAttendance": 2, "GetBehaviour": 3}
    listed = ", ".join(
        f"('{e.name}','{e.path}','{e.scope}',{flags.get(e.enabled_by, 0)},{e.window[2] if e.window else 0},{e.window[3] if e.window else 0})"
        for area in areas for e in ENDPOINTS.values() if e.area == area
    )
    year = f"'{dataset}'" if dataset else "CurrentAcademicYear"
    key = "concat(Academy,DataSet,'-',{})"
    return f"""
    with asked as (select *, cast(substring(AcademyCode,2) as bigint) s, AcademyCode Academy, {year} DataSet,
        coalesce(case when flag=3 then BehaviourFrom else AttendanceFrom end, {_DAY}-back_from) day_from,
        coalesce(case when flag=3 then BehaviourTo else AttendanceTo end, {_DAY}-back_to) day_to
      from {{AcademySecurity}}, (values {listed}) as e(endpoint, path, scope, flag, back_from, back_to)
      where Active and case flag when 1 then GetLessonAttendance when 2 then GetSessionAttendance when 3 then GetBehaviour else true end),
    cuts as (select *, cast(null as int) NCYear, cast(null as date) as Date from asked where scope='year'
      union all select *, cast(unnest(range(LowestYear,HighestYear+1)) as int), null from asked where scope='year_group'
      union all select *, null, cast(unnest(range(cast(day_from as timestamp),cast(day_to as timestamp)+interval 1 day,interval 1 day)) as date)
        from asked where scope='day'),
    students as ({_STUDENTS}), marks as ({_MARKS}), events as ({_EVENTS}),
    judged as (select *, case
        when endpoint='students' and s%7=3 then 'unreadable page'
        when endpoint='students' and s%7=1 and s in (select s from students) then 'bad date Students'
        when endpoint='students' and s%7=2 and s in (select s from students) then 'text too long Students'
        when endpoint='grade_names' and s%5=0 and NCYear=LowestYear+1 then 'unreadable page'
        when endpoint='beh_events' and s%7=4 and (s,Date) in (select s,day from events) then 'row of another day BehEventStudents'
        when endpoint='staff' and s%5=0 then 'no page landed' else 'stored' end detail,
        endpoint='grade_names' and s%5=0 and NCYear>LowestYear+1 skipped from cuts),
    good as (select * from judged where detail='stored' and not skipped)
    select 'log' what, Academy, DataSet, NCYear, Date, path as name, detail from judged where not skipped
    union all select 'Students', Academy, DataSet, NCYear, null, {key.format("cast(id as string)")}, other
      from good join students using (s) where endpoint='students'
    union all select 'GradeNames', Academy, DataSet, NCYear, null,
      {key.format("case when NCYear=0 then 'Reception' else cast(NCYear as string) end,'-',cast(n as string)")}, 'grade'
      from good, (values (1),(2)) as g(n) where endpoint='grade_names'
    union all select 'StudentSessionMarks', Academy, DataSet, NCYear, Date, {key.format("cast(id as string)")}, {key.format("cast(ascii(other) as string)")}
      from good join marks on marks.s=good.s and marks.day=good.Date where endpoint='session_marks'
    union all select 'BehEvents', Academy, DataSet, NCYear, Date, cast(id as string), other
      from good join events on events.s=good.s and events.day=good.Date where endpoint='beh_events'
    union all select 'BehEventStudents', Academy, DataSet, NCYear, Date, cast(id as string), {key.format("cast(id+1 as string)")}
      from good join events on events.s=good.s and events.day=good.Date where endpoint='beh_events'
    """


for _name, _areas, _dataset in (
    ("sync_full", jobs.FULL, None),
    ("sync_attendance", jobs.ATTENDANCE, None),
    ("sync_behaviour", jobs.BEHAVIOUR, None),
    ("sync_back_fill", jobs.FULL, "2017"),
):
    register(_name, lambda t, a=_areas, d=_dataset: _job(t, a, d), _oracle(_areas, _dataset))

"""Attribute look-ups for every student and every attribute name."""

from functools import reduce

from pyspark.sql import functions as F

from rollbook.operators import attributes as a
from rollbook.plans.reports import attribute_look_ups
from rollbook.session import scratch_path
from rollbook.sources.warehouse import Warehouse
from standins.catalogue import register
from standins.stored import store

_NAMED = """
    select v.StudentId, t.Academy, t.DataSet, t.AttributeName, v.Value, v.AcademicYear, v.Date
    from {AttributeTypes} t join {AttributeValues} v on v.AttributeTypeId=t.AttributeTypeId
    """
_OWNER = "StudentId, Academy, DataSet, AttributeName"


def _named(t, names=None):
    return a.named_values(t["AttributeTypes"], t["AttributeValues"], names)


def _sole(where: str) -> str:
    return f"select {_OWNER}, max(Value) as Value, count(*) Matches from ({_NAMED}) where {where} group by {_OWNER}"


def _first(order: str) -> str:
    return (
        f"select {_OWNER}, Value from (select *, row_number() over (partition by {_OWNER} order by {order}) rn "
        f"from ({_NAMED})) where rn=1"
    )


_FOR_YEAR = "AcademicYear='2021' and Date is null"
register("attr_value_academic_year", lambda t: a.value_for_year(_named(t), "2021"), _sole(_FOR_YEAR))
register(
    "attr_value_no_timestamp",
    lambda t: a.value_without_timestamp(_named(t)),
    _sole("AcademicYear is null and Date is null"),
)
register(
    "attr_value_latest",
    lambda t: a.latest_value(_named(t)),
    _first("Date desc nulls last, AcademicYear desc nulls last, Value desc nulls last"),
)
register(
    "attr_value_earliest",
    lambda t: a.earliest_value(_named(t)),
    _first("Date asc nulls first, AcademicYear asc nulls first, Value asc nulls first"),
)
register(
    "attr_lookup_conflicts",
    lambda t: a.lookup_conflicts(a.value_for_year(_named(t), "2021")),
    f"select * from ({_sole(_FOR_YEAR)}) where Matches>1",
)

register(
    "attr_values_by_year",
    lambda t: a.values_by_year(_named(t)),
    f"select {_OWNER}, AcademicYear, max(Value) as Value, count(*) Matches from ({_NAMED}) "
    f"where AcademicYear is not null and Date is null group by {_OWNER}, AcademicYear",
)


def _views(t):
    """The look-ups joined in SQL, as a user of the views writes it."""
    for name, found in attribute_look_ups(t).items():
        found.createOrReplaceTempView(name)
    t["Students"].createOrReplaceTempView("students_of_views")
    return t.spark.sql("""
        select s.StudentId, n.AttributeName, n.Value latest, e.Value earliest, y.Value of_2021, u.Value undated
        from students_of_views s
        join v_AttributeValueLatest n on n.StudentId=s.StudentId
        left join v_AttributeValueEarliest e on e.StudentId=s.StudentId and e.AttributeName=n.AttributeName
          and e.Academy=n.Academy and e.DataSet=n.DataSet
        left join v_AttributeValueAcademicYear y on y.StudentId=s.StudentId and y.AttributeName=n.AttributeName
          and y.Academy=n.Academy and y.DataSet=n.DataSet and y.AcademicYear='2021'
        left join v_AttributeValueNoTimeStamp u on u.StudentId=s.StudentId and u.AttributeName=n.AttributeName
          and u.Academy=n.Academy and u.DataSet=n.DataSet
        """)


register(
    "attr_look_up_views",
    _views,
    f"""
    with named as (select *, (coalesce(Date,DATE '0001-01-01'), coalesce(AcademicYear,''), coalesce(Value,'')) place,
        coalesce(Value,chr(0)) shown
      from ({_NAMED}) where StudentId in (select StudentId from {{Students}}))
    select StudentId, AttributeName, nullif(arg_max(shown,place),chr(0)) latest,
      nullif(arg_min(shown,place),chr(0)) earliest,
      max(Value) filter (where AcademicYear='2021' and Date is null) of_2021,
      max(Value) filter (where AcademicYear is null and Date is null) undated
    from named group by StudentId, Academy, DataSet, AttributeName
    """,
)

_SHOWN = ("FSM", "Ethnicity")
_LATEST = _first("Date desc nulls last, AcademicYear desc nulls last, Value desc nulls last")
register(
    "attr_latest_on_students",
    lambda t: a.attach(t["Students"].select("StudentId", "Academy", "DataSet"), a.latest_value(_named(t, _SHOWN)),
                       _SHOWN, prefix="latest_"),
    f"""
    select s.StudentId, s.Academy, s.DataSet,
      {", ".join(f"(select Value from latest x where x.AttributeName='{n}' and x.StudentId=s.StudentId "
                 f"and x.Academy=s.Academy and x.DataSet=s.DataSet) latest_{n}" for n in _SHOWN)}
    from {{Students}} s
    """.replace("from latest x", f"from ({_LATEST}) x"),
)


# The values are stored and reduced; then the slices of one academy are replaced (other values, fewer rows) and those
# of another are emptied.
_AGAIN = "select AttributeTypeId, StudentId, Value||'*' as Value, AcademicYear, Date, Academy, DataSet, AttributeGroup from {AttributeValues} where Academy='A1' and AcademicYear is not null"
_LOOK_UP_NAMES = {"v_AttributeValueLatest": "latest", "v_AttributeValueEarliest": "earliest", "v_AttributeValueAcademicYear": "year", "v_AttributeValueNoTimeStamp": "none"}


def _kept_look_ups(t):
    """All look-ups, merged from what is kept by slice after slices have been replaced and emptied."""
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    store(warehouse, t, ["AttributeTypes", "AttributeValues"])
    warehouse.lookups()
    replaced = t["AttributeValues"].where("Academy in ('A1','A2')").select("Academy", "DataSet", "AttributeGroup").distinct()
    warehouse.replace_slices("AttributeValues", t.sql(_AGAIN), replaced)
    views = warehouse.lookups().views(warehouse.read("AttributeTypes"))
    shown = [views[v].withColumn("look_up", F.lit(name)) for v, name in _LOOK_UP_NAMES.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shown)


_KEPT = f"(select StudentId, AttributeTypeId, Value, AcademicYear, Date from {{AttributeValues}} where Academy not in ('A1','A2') union all select StudentId, AttributeTypeId, Value, AcademicYear, Date from ({_AGAIN}))"
_OWN = f"select v.StudentId, t.Academy, t.DataSet, t.AttributeName, v.Value, v.AcademicYear, v.Date from {{AttributeTypes}} t join {_KEPT} v on v.AttributeTypeId=t.AttributeTypeId"
_FIRST_OF = f"select {_OWNER}, Value, '{{0}}' look_up, cast(null as string) AcademicYear, cast(null as bigint) Matches from (select *, row_number() over (partition by {_OWNER} order by {{1}}) rn from own) where rn=1"
register(
    "attr_look_ups_kept",
    _kept_look_ups,
    f"""
    with own as ({_OWN})
    {_FIRST_OF.format("latest", "Date desc nulls last, AcademicYear desc nulls last, Value desc nulls last")}
    union all {_FIRST_OF.format("earliest", "Date asc nulls first, AcademicYear asc nulls first, Value asc nulls first")}
    union all select {_OWNER}, max(Value), 'year', AcademicYear, count(*) from own
      where AcademicYear is not null and Date is null group by {_OWNER}, AcademicYear
    union all select {_OWNER}, max(Value), 'none', null, count(*) from own
      where AcademicYear is null and Date is null group by {_OWNER}
    """,
)

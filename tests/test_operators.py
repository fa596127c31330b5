"""Look-ups, replacing and checks against plain Python."""

import random
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rollbook.operators import attributes as a
from rollbook.operators.checks import orphan_report
from rollbook.operators.project import project
from rollbook.operators.replace import cascade_delete, replace_slices, upsert_by_id

NAMED = (
    "StudentId string, Academy string, DataSet string, AttributeName string, Value string, AcademicYear string, Date date"
)


def named(spark, *rows):
    return spark.createDataFrame([(s, "A", "2021", n, v, y, d) for s, n, v, y, d in rows], NAMED)


def picked(df):
    return {(r.StudentId, r.AttributeName): r.Value for r in df.collect()}


def test_latest_and_earliest_against_sorting(spark):
    rng = random.Random(3)
    days = [None, date(2020, 1, 1), date(2021, 5, 5)]
    rows = [
        (f"s{rng.randrange(12)}", rng.choice("xy"), rng.choice(["a", "b", "c", None]), rng.choice([None, "2020", "2021"]),
         rng.choice(days))
        for _ in range(400)
    ]
    low = ""

    def order(row):
        return (row[4] or date.min, row[3] or low, row[2] or low)

    groups = {}
    for row in rows:
        groups.setdefault(row[:2], []).append(row)
    df = named(spark, *rows)
    assert picked(a.latest_value(df)) == {k: max(g, key=order)[2] for k, g in groups.items()}
    assert picked(a.earliest_value(df)) == {k: min(g, key=order)[2] for k, g in groups.items()}


def test_single_value_look_ups(spark):
    df = named(
        spark, ("s", "x", "1", "2021", None), ("s", "x", "2", "2021", date(2021, 1, 1)), ("s", "x", "3", None, None),
        ("t", "x", "4", "2021", None), ("t", "x", "5", "2021", None),
    )
    found = a.value_for_year(df, "2021")
    assert {(r.StudentId, r.Value, r.Matches) for r in found.collect()} == {("s", "1", 1), ("t", "5", 2)}
    assert [r.StudentId for r in a.lookup_conflicts(found).collect()] == ["t"]
    assert picked(a.value_without_timestamp(df)) == {("s", "x"): "3"}
    with pytest.raises(PySparkException, match="several values"):
        a.value_for_year(df, "2021", strict=True).collect()


def test_pivot_defaults(spark):
    types = spark.createDataFrame([("t1", "FSM"), ("t2", "Disadvantaged")], "AttributeTypeId string, AttributeName string")
    values = spark.createDataFrame(
        [("t1", "only", "True"), ("t1", "none", None), ("t2", "both", "False"), ("t1", "both", "True"), ("zz", "odd", "1")],
        "AttributeTypeId string, StudentId string, Value string",
    )
    students = spark.createDataFrame([(s,) for s in ("only", "none", "both", "odd", "bare")], "StudentId string")
    columns = [a.PivotColumn("FSM", "FSM"), a.PivotColumn("D", "Disadvantaged", default="No")]
    shown = a.attach_pivot(students, a.pivot_attributes(types, values, columns), columns)
    assert {r.StudentId: (r.FSM, r.D) for r in shown.collect()} == {
        "only": ("Yes", "No"), "none": (None, "No"), "both": ("Yes", "No"), "odd": ("", "No"), "bare": ("", "No"),
    }


def test_replacing_twice_is_replacing_once(spark):
    old = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "g string, v int")
    new = spark.createDataFrame([("A", 9)], "g string, v int")
    asked = spark.createDataFrame([("A",), ("C",)], "g string")
    once = replace_slices(old, new, asked, ["g"])
    assert sorted(map(tuple, once.collect())) == [("A", 9), ("B", 3)]
    assert sorted(map(tuple, replace_slices(once, new, asked, ["g"]).collect())) == [("A", 9), ("B", 3)]
    assert sorted(map(tuple, replace_slices(old, new.filter("false"), asked, ["g"]).collect())) == [("B", 3)]
    assert sorted(map(tuple, upsert_by_id(old, new, "g").collect())) == [("A", 9), ("B", 3)]


def test_a_row_goes_with_any_of_its_parents(spark):
    tables = {
        "Students": spark.createDataFrame([("s1",), ("s2",)], "StudentId string"),
        "Subjects": spark.createDataFrame([("b1", "d"), ("b2", "d")], "SubjectId string, DepartmentId string"),
        "Groups": spark.createDataFrame([("g1", "b1"), ("g2", "b2")], "GroupId string, SubjectId string"),
        "GroupStudents": spark.createDataFrame(
            [("g1", "s1"), ("g2", "s1"), ("g2", "s2")], "GroupId string, StudentId string"),
    }
    left = cascade_delete(tables, "Subjects", spark.createDataFrame([("b1",)], "SubjectId string"))
    assert sorted(map(tuple, left["GroupStudents"].collect())) == [("g2", "s1"), ("g2", "s2")]
    left = cascade_delete(left, "Students", spark.createDataFrame([("s1",)], "StudentId string"))
    assert sorted(map(tuple, left["GroupStudents"].collect())) == [("g2", "s2")]
    assert left["Groups"].count() == 1
    report = orphan_report({**tables, "Groups": tables["Groups"].filter("false")})
    found = {(r.child, r.parent): r.orphans for r in report.collect()}
    assert found == {("GroupStudents", "Groups"): 3, ("GroupStudents", "Students"): 0, ("Groups", "Subjects"): 0}


def test_orphans_with_null_repeated_and_mixed_keys(spark):
    tables = {
        "Departments": spark.createDataFrame([("d1",), (None,)], "DepartmentId string"),
        "Subjects": spark.createDataFrame([(1, "d1"), (1, "d2"), (None, "d2"), (2, None)], "SubjectId bigint, DepartmentId string"),
        "Groups": spark.createDataFrame(
            [("g1", "1"), ("g2", "3"), ("g3", "3"), ("g4", "x"), ("g5", None)], "GroupId string, SubjectId string"),
        "Staff": spark.createDataFrame([(1,)], "StaffId bigint"),
    }
    found = {(r.child, r.child_column, r.parent): r.orphans for r in orphan_report(tables).collect()}
    assert found == {("Subjects", "DepartmentId", "Departments"): 2, ("Groups", "SubjectId", "Subjects"): 3}


def test_projection_is_by_name(spark):
    staged = spark.createDataFrame([("extra", "m", 5, "s", "A", "2021", "n")],
                                   "SubjectId string, MarksheetId string, MaxMarks int, MarkslotId string, "
                                   "Academy string, DataSet string, Name string")
    kept = project(staged.withColumn("MaxMarks", F.lit("5")), "Markslots")
    assert kept.columns == ["MarkslotId", "MarksheetId", "Name", "MaxMarks", "Academy", "DataSet"]
    assert kept.first().MaxMarks == 5

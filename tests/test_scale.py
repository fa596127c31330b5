"""What must hold for plans on large tables: no gathering of groups, no cross joins, and hot keys split."""

import re

import pytest
from pyspark.sql import functions as F

from rollbook.operators.attributes import earliest_value, latest_value, value_for_year
from rollbook.operators.checks import orphan_report
from rollbook.operators.joins import expand, look_up
from standins import catalogue
from standins.relations import Standins
from tests.conftest import SF

QUERIES = catalogue.queries()
# Jobs write while they are being built, and their landed pages are grouped by page on purpose.
LAZY = [n for n in QUERIES if not n.startswith(("sync_behaviour", "sync_key", "stream_"))]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_plan_gathers_groups_or_crosses_tables(spark, name):
    plan = optimized(QUERIES[name](spark, SF))
    assert not re.search(r"\bWindow\b|collect_list|collect_set|Join Cross|GlobalLimit|Sample|PythonUDF", plan)
    # Joins without a condition would be cross joins under another name.
    assert not re.search(r"Join (Inner|LeftOuter)\s*$", plan, re.MULTILINE)


@pytest.fixture
def small_partitions(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name in changed:
        spark.conf.unset(name)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def hot(spark, rows=60000):
    """A third of the rows have one key; the rest are spread."""
    return spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("key"), F.col("id").alias("value"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_in_a_look_up_is_split(spark, small_partitions):
    names = spark.range(0, 60000, 1, 8).select(F.col("id").alias("code"), F.concat(F.lit("n"), "id").alias("name"))
    rows, plan = final_plan(look_up(hot(spark), names, {"key": "code"}, {"name": "name"}))
    assert "skew=true" in plan
    assert len(rows) == 60000 and all(r.name == f"n{r.key}" for r in rows)


def test_a_hot_key_on_the_many_side_is_split(spark, small_partitions):
    facts = spark.range(0, 70000, 1, 8).select(F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("f"))
    rows, plan = final_plan(expand(facts, hot(spark), ["key"]).select("key", "value", "f", "filler"))
    assert "skew=true" in plan
    plain = facts.join(hot(spark), "key", "left").select("key", "value")
    assert sorted((r.key, r.value or -1) for r in rows) == sorted((r.key, r.value or -1) for r in plain.collect())


def test_look_ups_reduce_before_the_shuffle(spark):
    named = spark.range(0, 1000).select(
        F.lit("A2021-1").alias("StudentId"), F.lit("A").alias("Academy"), F.lit("2021").alias("DataSet"),
        F.lit("FSM").alias("AttributeName"), F.col("id").cast("string").alias("Value"),
        F.lit("2021").alias("AcademicYear"), F.lit(None).cast("date").alias("Date"),
    )
    for found in (latest_value(named), earliest_value(named), value_for_year(named, "2021")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "partial_max" in plan or "partial_min" in plan


def test_orphans_are_counted_without_joining_keys(spark, small_partitions):
    report = QUERIES["orphan_report"](spark, SF)
    assert "LeftAnti" not in optimized(report)
    rows, plan = final_plan(report)
    # Only the list of foreign keys is joined; a table that is worked out and read for several keys is shuffled once.
    assert plan.partition("== Initial Plan ==")[0].count("Join") == 1
    assert "ReusedExchange" in plan
    assert len(rows) == 26


def test_keys_of_orphans_are_reduced_before_the_shuffle(spark):
    t = Standins(spark, SF)
    plan = orphan_report({n: t[n] for n in ("Students", "MarkslotMarks")})._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(key#\d+, \d+\)", plan)
    assert "partial_bool_or" in plan or "partial_max" in plan


def test_rows_without_a_student_or_class_are_not_looked_up(spark):
    plan = optimized(QUERIES["behaviour_view"](spark, SF)).splitlines()
    depth = {line.index("Join"): line for line in plan if "Join LeftOuter" in line}
    expanded = next(line.index("Union") for line in plan if "Union" in line)
    # NULL keys meet in one task: students are looked up below the expansion, classes for the types alone.
    above = [line for at, line in depth.items() if at < expanded]
    assert above and not [line for line in above if re.search(r"InvolvedId|StudentId|BehClassificationId", line)]

"""Kept partial look-ups against look-ups made from the values."""

import random

import pytest
from pyspark.sql import functions as F

from rollbook.operators import attributes, partials
from rollbook.plans import cascades
from rollbook.plans.reports import attribute_look_ups
from rollbook.session import scratch_path
from rollbook.sources import commits
from rollbook.sources.warehouse import Warehouse
from standins.stored import store
from tests.test_commits import Killed

SLICE = ["Academy", "DataSet", "AttributeGroup"]


@pytest.fixture
def warehouse(spark, interpreted):
    return Warehouse(spark, scratch_path(spark, "warehouse"))


def rows(df):
    return sorted(map(str, df.collect()))


def agree(warehouse):
    tables = {n: warehouse.read(n) for n in ("AttributeTypes", "AttributeValues")}
    kept = warehouse.lookups().views(tables["AttributeTypes"])
    for name, found in attribute_look_ups(tables).items():
        assert rows(kept[name].select(*found.columns)) == rows(found), name


def random_values(spark, seed, academies):
    """A few rows with ties, repeated rows, NULL dates, years and values; types shared by the slices."""
    rng = random.Random(seed)
    made = [
        (rng.choice(["t1", "t2", "t3", "unknown"]), rng.choice(["s1", "s2", None]), rng.choice(["x", "y", "", None]),
         rng.choice(["2020", "2021", None]), rng.choice(["2024-01-01", "2024-01-02", None]), rng.choice(academies), rng.choice(["2020", "2021"]), rng.choice(["g", "h"]))
        for _ in range(60)
    ]
    rows = spark.createDataFrame(made, "AttributeTypeId string, StudentId string, Value string, AcademicYear string, Date string, Academy string, DataSet string, AttributeGroup string")
    return rows.withColumn("Date", F.col("Date").cast("date"))


def test_kept_look_ups_follow_replaced_and_emptied_slices(spark, warehouse):
    types = [("t1", "A", "2020", "g", "FSM"), ("t2", "A", "2020", "h", "FSM"), ("t3", "B", "2021", "g", "EAL")]
    types = spark.createDataFrame(types, "AttributeTypeId string, Academy string, DataSet string, AttributeGroup string, AttributeName string")
    types = types.withColumns({"SourceAttributeId": F.lit(1).cast("long"), "Code": F.lit(None).cast("string"), "IsSystem": F.lit(False)})
    warehouse.replace_slices("AttributeTypes", types, types.select(*SLICE))
    first = random_values(spark, 1, ["A", "B", "C"])
    warehouse.replace_slices("AttributeValues", first, first.select(*SLICE))
    agree(warehouse)
    for seed in (2, 3, 4):
        again = random_values(spark, seed, ["B", "C"]).where(F.col("DataSet") == ("2021" if seed % 2 else "2020"))
        # Slices asked for that bring no row are emptied.
        warehouse.replace_slices("AttributeValues", again, first.where("Academy<>'A'").select(*SLICE).distinct())
        agree(warehouse)
    renamed = types.withColumn("AttributeName", F.concat("AttributeName", F.lit("!")))
    warehouse.replace_slices("AttributeTypes", renamed, types.select(*SLICE))
    agree(warehouse)
    assert warehouse.lookups().read().count() > 0


def test_cascades_and_killed_jobs_leave_look_ups_and_values_in_step(warehouse, standins, monkeypatch):
    store(warehouse, standins, ["Students", "AttributeTypes", "AttributeValues"])
    agree(warehouse)
    owners = warehouse.read("Students").join(warehouse.read("AttributeValues"), "StudentId", "left_semi").select("StudentId")
    gone = warehouse.spark.createDataFrame(owners.orderBy("StudentId").limit(3).collect(), "StudentId string")
    assert gone.count() == 3
    # Slices of one student are emptied, not written: the job dies at its first touch of the look-ups, whichever it is.
    put, remove = commits._put, commits.remove

    def dying(step, at):
        def made(spark, *paths):
            if "/_lookups/AttributeValues/" in paths[at]:
                raise Killed
            step(spark, *paths)

        return made

    monkeypatch.setattr(commits, "_put", dying(put, 1))
    monkeypatch.setattr(commits, "remove", dying(remove, 0))
    with pytest.raises(Killed):
        cascades.delete_stored(warehouse, "Students", gone)
    monkeypatch.undo()
    assert not warehouse.lookups().read().join(gone, "StudentId", "left_semi").isEmpty()
    warehouse.recover()
    assert warehouse.read("AttributeValues").join(gone, "StudentId", "left_semi").isEmpty()
    assert warehouse.lookups().read().join(gone, "StudentId", "left_semi").isEmpty()
    agree(warehouse)


def test_strict_look_ups_fail_on_several_values(spark):
    values = spark.createDataFrame([("t", "s", v, "2021", None) for v in ("x", "y")], "AttributeTypeId string, StudentId string, Value string, AcademicYear string, Date date")
    types = spark.createDataFrame([("t", "A", "2021", "FSM")], "AttributeTypeId string, Academy string, DataSet string, AttributeName string")
    named = partials.named_partials(types, partials.partial_values(values), ["FSM"])
    assert partials.value_for_year(named, "2021").first()["Matches"] == 2
    assert attributes.lookup_conflicts(partials.value_for_year(named, "2021")).count() == 1
    with pytest.raises(Exception, match="several values"):
        partials.value_for_year(named, "2021", strict=True).collect()

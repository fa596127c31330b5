"""Pages made from the test tables."""

from standins import pages, relations
from standins.relations import Standins
from tests.conftest import SF


def test_pages_are_made_in_tasks_of_so_many_rows(spark, monkeypatch):
    """The table is one small file: read as it is, one task would make and parse all of its pages."""
    standins = Standins(spark, SF)
    expected = sorted(map(str, pages.ingest(standins, "send_attributes", "AttributeValues").collect()))
    rows = standins.base("part").count()
    monkeypatch.setattr(relations, "ROWS_A_TASK", -(-rows // 5))
    made = pages.ingest(standins, "send_attributes", "AttributeValues")
    assert made.rdd.getNumPartitions() == 5
    assert sorted(map(str, made.collect())) == expected

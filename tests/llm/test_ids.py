"""Hot and null ids, and letters beyond A-Z."""

import random
from statistics import median

from pyspark.sql import functions as F

from rollbook.llm import fingerprints, licenses, packing
from rollbook.llm.common import lower_az


def _docs(spark, n=6000):
    """A third of the ids null, a sixth one id; texts differ."""
    rng = random.Random(3)
    ids = [None if k % 3 == 0 else 77 if k % 6 == 1 else rng.randrange(10**6) for k in range(n)]
    return spark.createDataFrame([(d, f"text number {k}") for k, d in enumerate(ids)], "doc_id bigint, text string").repartition(6)


def test_hot_ids_are_cut_into_buckets_like_others(spark):
    docs = _docs(spark)
    sizes = [r["count"] for r in fingerprints.cut_by_id(docs, "doc_id", each=100).groupBy("__bucket").count().collect()]
    assert len(sizes) > 40 and max(sizes) <= 2.5 * median(sizes)


def test_the_next_document_follows_in_the_order_of_ids(spark):
    rows = fingerprints.with_next(_docs(spark, 1200), "doc_id", 5, 64, each=50).collect()
    after = {r["text"]: r["next_text"] for r in rows}
    assert len(after) == 1200 and set(after) == set(after.values())
    ids = {r["text"]: -1 if r["doc_id"] is None else r["doc_id"] for r in rows}
    # One circle, which falls back to the smallest id once.
    at, seen, falls = rows[0]["text"], 0, 0
    while True:
        seen, falls, at = seen + 1, falls + (ids[after[at]] < ids[at]), after[at]
        if at == rows[0]["text"]:
            break
    assert seen == 1200 and falls == 1


def test_packing_deals_out_rows_of_one_id(spark):
    docs = spark.createDataFrame([(None if k % 2 else 5, "a b c") for k in range(1000)], "doc_id bigint, text string")
    found = packing.packed(docs).collect()
    assert len({(r["bucket"], r["batch"], r["batch_row"]) for r in found}) == 1000


def test_only_a_to_z_are_lowered(spark):
    texts = ["ABCZ az", "\u0130ABC \u00c4\u212a", "", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(lower_az(F.col("t")).alias("t"))
    assert [r["t"] for r in found.collect()] == ["abcz az", "\u0130abc \u00c4\u212a", "", None]
    docs = spark.createDataFrame([(1, "GENERAL PUBLIC LICENSE \u0130"), (2, "GENERAL PUBL\u0130C LICENSE")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["base_labels"] for r in licenses.scan(docs).collect()} == {1: "gpl", 2: ""}

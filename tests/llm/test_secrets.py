"""Secrets in texts without a digit or a sign."""

import pytest
from pyspark.sql import functions as F

from rollbook.llm import pii


@pytest.mark.parametrize("key", ["AKIA" + "ABCDEFGHIJKLMNOP", "ghp_" + "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ"])
def test_a_key_of_letters_only(spark, key):
    made = pii.with_candidates(spark.createDataFrame([(f"the key {key} stays here",), ("plain",)], "text string"), "text", "c")
    assert [[(s["kind"], s["value"]) for s in r[0]] for r in made.select(F.col("c")).collect()] == [[("secret", key)], []]

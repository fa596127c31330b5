"""The pipeline stage by stage against brute force, on the small tables and on odd ones."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rollbook.llm import pii, quality
from rollbook.llm.common import staged
from tests.conftest import SF
from tests.llm import brute

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def held(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


@pytest.mark.parametrize("which", ["small", "odd"])
def test_stages(spark, which, request):
    at = SF if which == "small" else request.getfixturevalue("odd_dir")
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    model = quality.train(docs, spark.read.parquet(f"{at}/labels.parquet"), F.lit(True), "quality")

    good = staged(stages["quality classifier"](spark, docs, at), "good")
    expected = Counter()
    for r in docs.collect():
        score = model.score(np.stack([quality.term_counts((r["text"] or "").encode())]))[0]
        if score >= quality.THRESHOLD:
            expected[tuple(r)] += 1
    assert good.columns == columns and held(good) == expected

    one = staged(stages["SimHash near-dedup"](spark, good, at), "one")
    groups = {}
    texts = {}
    for r in good.collect():
        texts.setdefault(r["doc_id"], []).append(r)
    for (doc, _, component), _ in brute.components([(r["doc_id"], r["text"]) for r in good.collect()]).items():
        groups.setdefault(component, set()).add(doc)
    assert one.columns == columns and Counter(r["doc_id"] for r in one.collect()) == Counter(list(groups))
    assert set(held(one)) <= set(held(good))

    clean = staged(stages["benchmark decontamination"](spark, one, at), "clean")
    items = [tuple(r) for r in spark.read.parquet(f"{at}/benchmark.parquet").select("item_id", "text").collect()]
    found = [brute.contamination([(r["doc_id"], r["text"])], items) for r in one.collect()]
    hit = [next(iter(f))[5] for f in found]
    assert clean.columns == columns and held(clean) == Counter(tuple(r) for r, h in zip(one.collect(), hit, strict=True) if not h)

    masked = staged(stages["PII"](spark, clean, at), "masked")
    assert masked.columns == columns and held(masked, "doc_id") == held(clean, "doc_id")
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in masked.collect():
        assert r["n_chars"] == (len(r["text"]) if r["text"] is not None else None)
        if not any(c in (before[r["doc_id"]] or "") for c in "@=:0123456789"):
            assert r["text"] == before[r["doc_id"]]
        found = brute.personal(before[r["doc_id"]])[0][0]
        assert (r["text"] or "").count("<EMAIL>") >= found * (found == 1)
    packed = stages["packing"](spark, masked, at)
    assert held(packed, *NAMES) == held(masked, *NAMES)


def test_run_is_the_chain_of_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), "stage")
    found = corpus_pipeline.run(spark, SF)
    assert held(found, *NAMES) == held(docs, *NAMES)
    # The texts are there to be read, masked, and each has one place.
    assert found.where(F.col("text").contains("<EMAIL>")).count() > 0
    places = [(r["bucket"], r["batch"], r["batch_row"]) for r in found.collect()]
    assert len(set(places)) == len(places)
    assert pii.BASE == ("email", "ip", "card", "phone")


def test_empty_tables(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0

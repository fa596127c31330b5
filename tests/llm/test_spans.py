"""Texts with very many spans: places and masks against plain Python, over block boundaries and overlaps."""

import random

from pyspark.sql import functions as F

from rollbook.llm import pii
from tests.llm import brute


def _masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out.append(f"{text[at:start]}<{kind.upper()}>")
        at = max(at, end)
    return "".join(out) + text[at:]


def test_masks_of_overlapping_spans(spark):
    rng = random.Random(5)
    cases = []
    for n in (0, 1, 2, pii.BLOCK - 1, pii.BLOCK, pii.BLOCK + 1, 5 * pii.BLOCK + 3):
        text = "".join(rng.choice("ab é\n𝄞") for _ in range(4 * n + 5))
        starts = [rng.randrange(len(text)) for _ in range(n)]
        cases.append((text, [(s, min(len(text), s + rng.randint(1, 9)), rng.choice(pii.KINDS)) for s in starts]))
    cases.append(("x" * 3000, [(0, 2990, "card")] + [(k, k + 2, "ip") for k in range(1, 2999, 2)]))
    rows = spark.createDataFrame(cases, "text string, spans array<struct<start:int,end:int,kind:string>>")
    shown = {r["text"]: r["m"] for r in rows.select("text", pii.masked(F.col("text"), F.col("spans")).alias("m")).collect()}
    assert shown == {text: _masked(text, spans) for text, spans in cases}


def test_places_in_texts_of_many_spans(spark):
    rng = random.Random(7)
    pieces = ("ü{}@x.de ", "+49 30 123456{} ", "10.0.{}.7, ", "4111 1111 1111 111{} ", "plain 𝄞 {} words ")
    texts = ["".join(rng.choice(pieces).format(rng.randint(0, 9)) for _ in range(n)) for n in (3, 128, 700, 3000)]
    found = pii.detect(spark.createDataFrame([(t,) for t in texts], "text string"))
    for r in found.collect():
        own = [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"] if s["base"]]
        assert ",".join(own) == brute.personal(r["text"])[1]
        assert all(r["text"][s["start"] : s["end"]] == s["value"] for s in r["spans"])

"""Every operator's query against its contract in plain Python, on the small tables and on odd ones."""

from collections import Counter, defaultdict

import pytest

from rollbook.llm import fingerprints, licenses, queries, urls
from tests.compare import differences, duck
from tests.conftest import SF
from tests.llm import brute

Q = queries.QUERIES


@pytest.fixture(params=["small", "odd"])
def tables(request, spark):
    return SF if request.param == "small" else request.getfixturevalue("odd_dir")


def rows(spark, at, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{at}/{name}.parquet").select(*columns).collect()]


def same(df, expected, *columns):
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    assert got == expected, (list((got - expected).items())[:3], list((expected - got).items())[:3])


def test_sharding(spark, tables):
    docs = rows(spark, tables, "documents", "doc_id", "text")
    found = Q["op1_label_propagation"](spark, tables).collect()
    expected = Counter((d, len((t or "").encode()) + 8, brute.crc(t)) for d, t in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected
    slots = defaultdict(list)
    for r in found:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(len(slots[s]) for s in range(24)) <= 1
    groups = defaultdict(set)
    sizes = Counter(brute.crc(t) for _, t in docs)
    for r in found:
        groups[r["text_crc32"]].add(r["shard"])
    least = min(len(docs) // 24, len(docs))
    small = [c for c, n in sizes.items() if 1 < n <= least // 2]
    assert sum(len(groups[c]) > 1 for c in small) <= len(small) * 0.1


def test_decontamination(spark, tables):
    expected = brute.contamination(rows(spark, tables, "documents", "doc_id", "text"), rows(spark, tables, "benchmark", "item_id", "text"))
    same(Q["op3_winnowing"](spark, tables), expected, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_simhash(spark, tables):
    same(Q["op5_gray_index"](spark, tables), brute.components(rows(spark, tables, "documents", "doc_id", "text")), "doc_id", "fingerprint", "component_id")


def test_licenses(spark, tables):
    stride = max(len(t.words) for t in licenses.TEMPLATES)
    expected = Counter()
    for d, t in rows(spark, tables, "documents", "doc_id", "text"):
        labels, score = brute.notices(t, licenses.TEMPLATES, stride)
        expected[(d, *brute.phrases(t), labels, score)] += 1
    same(Q["op7_license_join"](spark, tables), expected, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def test_personal_data(spark, tables):
    docs = rows(spark, tables, "documents", "doc_id", "text")
    expected = Counter((d, *brute.personal(t)[0]) for d, t in docs)
    found = Q["op8_weak_supervision"](spark, tables)
    same(found, expected, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    spans = {r["doc_id"]: set(r["spans"].split(",")) for r in found.collect()}
    for d, t in docs:
        own = brute.personal(t)[1]
        assert not own or set(own.split(",")) <= spans[d]


def test_urls(spark, tables):
    expected = Counter((p, *brute.verdict(u, urls.LISTED_HOSTS)) for p, u in rows(spark, tables, "pages", "page_id", "url"))
    same(Q["op9_bloom_cascade"](spark, tables), expected, "page_id", "host", "path", "rule", "verdict")


def test_fingerprints(spark, tables):
    docs = rows(spark, tables, "documents", "doc_id", "text")
    found = Q["op10_bottom_k"](spark, tables)
    same(found, brute.edited(docs), "doc_id", "n_chars", "edited_sha256")
    prints = {}
    texts = dict(docs)
    for r in found.collect():
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert prints.setdefault(texts[r["doc_id"]] or "", r["fingerprint"]) == r["fingerprint"]
        assert len(r["fingerprint"]) <= 16 * fingerprints.K


@pytest.mark.parametrize(("name", "part", "column"), [("op2_toxicity", (4, 2), "toxic"), ("op6_neighbour_votes", (5, 0), "quality")])
def test_classifiers(spark, tables, name, part, column):
    import zlib

    docs = rows(spark, tables, "documents", "doc_id")
    found = Q[name](spark, tables).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(d for (d,) in docs)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % part[0] == part[1])
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


@pytest.mark.parametrize(("name", "column", "least"), [("op2_toxicity", "toxic", 0.9), ("op6_neighbour_votes", "quality", 0.9)])
def test_held_out_accuracy(spark, name, column, least):
    at = SF.replace("0.001", "0.01")
    labels = dict(rows(spark, at, "labels", "doc_id", column))
    told = [r for r in Q[name](spark, at).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in told) >= least * len(told)


def test_packing(spark, tables):
    found = Q["op4_length_buckets"](spark, tables).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(d for (d,) in rows(spark, tables, "documents", "doc_id"))
    batches = defaultdict(list)
    longest = {}
    for r in found:
        assert 0 <= r["n_tokens"] <= r["bucket_tokens"] and r["padding"] == r["bucket_tokens"] - r["n_tokens"]
        batches[r["bucket"], r["batch"]].append(r["batch_row"])
        longest[r["bucket"]] = r["bucket_tokens"]
    for (bucket, _), held in batches.items():
        assert sorted(held) == list(range(len(held)))
        assert len(held) * longest[bucket] <= 65_536 or len(held) == 1
    assert sorted(longest.values()) == [longest[b] for b in sorted(longest)]


@pytest.mark.parametrize("name", list(Q))
def test_empty_tables(spark, empty_dir, name):
    assert Q[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql_says_the_same(spark, name):
    assert differences(Q[name](spark, SF), duck(SF), queries.ORACLES[name]) is None

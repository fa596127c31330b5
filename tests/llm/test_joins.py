"""The Jaccard join, the reversed search and the whitening against plain versions, on the small tables, odd ones and planted rows."""

import random
from collections import Counter

import numpy as np
import pytest

from rollbook.llm import jaccard, queries, search, whitening
from tests.llm import brute
from tests.llm.test_queries import rows, same, tables  # noqa: F401

Q = queries.QUERIES


def test_jaccard(spark, tables):  # noqa: F811
    expected = brute.jaccard_components(rows(spark, tables, "documents", "doc_id", "text"))
    same(Q["op11_jaccard_join"](spark, tables), expected, "doc_id", "n_shingles", "component_id")


def _near(seed):
    """Texts of all sizes and copies with some words exchanged, so that similarities lie on both sides of 0.9."""
    rng = random.Random(seed)
    out, number = [], 0
    for size in [1, 2, 3, 4, 5, 8, 10, 11, 12, 13, 14, 15, 19, 20, 21, 22, 24, 30, 40, 60, 100, 150, 300, 700, 1500]:
        for _ in range(4):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            for edits in (0, 0, 1, 1, 2, 3, size // 60, size // 45):
                copy = list(base)
                for at in rng.sample(range(size), min(size, edits)):
                    copy[at] = f"n{rng.randrange(10**6)}"
                if rng.random() < 0.4:
                    copy = copy[: max(1, size - rng.randrange(1 + size // 12))]
                number += 1
                out.append((number, " ".join(copy)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_link_between_near_copies_is_lost(spark, seed):
    docs = _near(seed)
    found = jaccard.joined(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4))
    same(found, brute.jaccard_components(docs), "doc_id", "n_shingles", "component_id")


def test_fragments_meet_for_every_link():
    """Any two sets that link share a fragment's key, whatever their sizes and hashes."""
    rng = np.random.default_rng(5)
    met = 0
    for _ in range(4000):
        n = int(rng.integers(9, 400))
        own = rng.integers(0, 1 << 63, n + 60, dtype=np.uint64) * np.uint64(2)
        gone, more = int(rng.integers(0, n // 8 + 2)), int(rng.integers(0, n // 8 + 2))
        a, b = np.unique(own[:n]), np.unique(np.concatenate((own[gone:n], own[n : n + more])))
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 90 * (len(a) + len(b) - shared) and not np.array_equal(a, b):
            met += 1
            assert len(np.intersect1d(jaccard._fragment_keys(a, 90), jaccard._fragment_keys(b, 90)))
    assert met > 500


def test_a_crowd_of_near_copies_and_odd_rows(spark):
    rng = random.Random(9)
    base = [f"w{k}" for k in range(200)]
    docs = []
    for d in range(400):  # many are near one another, many apart
        copy = list(base)
        for at in rng.sample(range(200), rng.choice((1, 2, 3, 4, 5))):
            copy[at] = f"x{d}_{at}"
        docs.append((d, " ".join(copy)))
    docs += [(None, None), (900, ""), (None, "lone words here and there"), (None, docs[3][1]), (901, docs[3][1].upper()), (901, "other text"), (902, "a b"), (903, "A  b")]
    found = jaccard.joined(spark.createDataFrame([(*r, 1, "k") for r in docs], "doc_id bigint, text string, n int, key string").repartition(5))
    same(found, brute.jaccard_components(docs), "doc_id", "n_shingles", "component_id")


def test_long_texts_are_counted_in_parts(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    copy, far = list(base), list(base)
    for at in range(0, 20_000, 400):
        copy[at] = f"x{at}"
    for at in range(0, 20_000, 30):
        far[at] = f"y{at}"
    docs = [(3, " ".join(base)), (2, " ".join(copy)), (1, " ".join(far))]
    for keys in (jaccard.BROADCAST_KEYS, 0):  # digests travel, or are joined
        monkeypatch.setattr(jaccard, "BROADCAST_KEYS", keys)
        found = jaccard.joined(spark.createDataFrame(docs, "doc_id bigint, text string"))
        same(found, brute.jaccard_components(docs), "doc_id", "n_shingles", "component_id")


def test_low_similarities_are_refused(spark):
    with pytest.raises(ValueError, match="percent"):
        jaccard.joined(spark.createDataFrame([], "doc_id bigint, text string"), percent=50)


def test_search(spark, tables):  # noqa: F811
    expected = brute.ranking(rows(spark, tables, "documents", "doc_id", "text"), rows(spark, tables, "benchmark", "item_id", "text"))
    same(Q["op12_reversed_search"](spark, tables), expected, "item_id", "rank", "doc_id", "score")


def test_search_in_blocks_with_ties_and_unknown_ids(spark):
    docs = [(k if k % 3 else None, f"red {'green ' * (k % 4)}blue") for k in range(60)] + [(5, None), (6, ""), (7, "RED"), (7, "RED")]
    items = [(1, "red blue"), (1, "Green"), (None, "blue BLUE blue"), (2, "none of these"), (3, None), (4, "red")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, score int").repartition(4)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, rank int")
    for size in (search.BLOCK_BYTES, 6):
        same(search.ranked(d, i, block_bytes=size), brute.ranking(docs, items), "item_id", "rank", "doc_id", "score")


def test_whitening(spark, tables):  # noqa: F811
    vectors = [r for r in rows(spark, tables, "embeddings", "vec_id", "embedding") if r[1] is None or (len(r[1]) != 2 and not any(c and 1e20 < c < 1e40 for c in r[1]))]
    deviation, n, values, axes, centred = brute.whitened(vectors)
    found = Q["op13_chebyshev_whitening"](spark, tables).collect()
    k = min(8, len(values))
    assert len(found) == n * k and {r["component"] for r in found} == set(range(1, k + 1))
    assert Counter((r["vec_id"], r["deviation"]) for r in found) == Counter({key: k * c for key, c in Counter(deviation).items()})
    assert {r["n"] for r in found} == {n} and len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9
    for c in range(1, k + 1):
        own = [r for r in found if r["component"] == c]
        assert own[0]["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-10)
        expected = np.sort(np.abs(centred @ axes[:, c - 1]) / np.sqrt(values[c - 1]))
        assert np.allclose(np.sort([abs(r["whitened"]) for r in own]), expected, atol=1e-6)


def test_eigenvectors_of_a_crowded_spectrum():
    """Wanted and unwanted eigenvalues lie close together; the operator is only seen through products."""
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    values = np.concatenate(([50, 20, 9, 8.9], np.linspace(8, 1, 296)))
    v = turn * values @ turn.T
    found, axes, residual = whitening.leading(lambda q: v @ q, 300, 8)
    assert np.allclose(found, values[:8], rtol=1e-12) and residual <= 1e-10
    assert np.allclose(np.abs(np.sum(axes * turn[:, :8], axis=0)), 1, atol=1e-9)


def test_vectors_without_spread_and_far_from_64_bits(spark):
    make = lambda values: spark.createDataFrame(list(enumerate(values)), "vec_id bigint, embedding array<double>")
    assert whitening.whitened(make([[1.0, 2.0]] * 5)).collect() == []
    assert whitening.whitened(make([[1.0, 2.0]])).collect() == []
    flat = whitening.whitened(make([[1.0, 2.0], [2.0, 4.0], [4.0, 8.0]])).collect()
    assert {r["component"] for r in flat} == {1}
    far = whitening.whitened(make([[2.0**39, 0.0], [-(2.0**39), 1.0], [0.0, 3.0]])).collect()
    assert {r["vec_id"]: r["deviation"] for r in far}[0] is None

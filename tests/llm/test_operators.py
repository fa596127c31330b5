"""The operators' own interfaces beyond what the queries use, against brute force on small data."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollbook.llm import decontaminate, fingerprints, packing, pii, quality, sharding, simhash, toxicity, urls
from tests.llm import brute
from tests.llm.test_queries import rows, same


def test_gray_index_finds_every_link(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.int64).astype(np.uint64)
    near = [c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, rng.integers(1, 5)).astype(np.uint64)) for c in np.repeat(centres, 25)]
    codes = sorted({int(c) for c in [*centres, *near, 0, (1 << 64) - 1, 1 << 63]})
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(c,) for c in signed], "code bigint")
    # Small blocks and fans, so that there are several levels.
    found = simhash.components(simhash.links(frame, block=16, leaf=4, fan=3)).collect()
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in combinations(codes, 2):
        if (a ^ b).bit_count() <= 2:
            root[find(a)] = find(b)
    groups, expected = {}, {}
    for r in found:
        groups.setdefault(r["root"], set()).update({r["node"] % (1 << 64), r["root"] % (1 << 64)})
    for c in codes:
        expected.setdefault(find(c), set()).add(c)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_gray_rank_is_the_inverse_of_the_code():
    n = np.arange(5000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_decontamination_without_the_filter(spark, odd_dir):
    docs, items = (spark.read.parquet(f"{odd_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    found = decontaminate.contamination(docs, items, filter_hashes=0)
    expected = brute.contamination(rows(spark, odd_dir, "documents", "doc_id", "text"), rows(spark, odd_dir, "benchmark", "item_id", "text"))
    found = found.withColumn("sha", F.sha2(F.array_join("items", ","), 256)).withColumn("hit", F.col("n_hit") > 0)
    same(found, expected, "doc_id", "n_words", "n_hit", "n_items", "sha", "hit")


def test_winnowing_keeps_a_hash_of_every_window():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 50, 400).astype(np.uint64)  # many ties
    kept = set(decontaminate._winnowed(hashes, 6).tolist())
    for k in range(len(hashes) - 5):
        window = hashes[k : k + 6]
        assert k + max(i for i in range(6) if window[i] == window.min()) in kept


def _padding(longest, counts, total, ends):
    cost, start = 0, 0
    for e in ends:
        cost += longest[e] * sum(counts[start : e + 1]) - sum(total[start : e + 1])
        start = e + 1
    return cost


def test_boundaries_have_the_least_padding():
    rng = np.random.default_rng(5)
    for _ in range(20):
        n = int(rng.integers(1, 9))
        longest = sorted(set(rng.integers(0, 100, n).tolist()))
        counts = rng.integers(1, 9, len(longest)).tolist()
        total = [length * c for length, c in zip(longest, counts, strict=True)]
        for k in range(1, 5):
            ends = packing.best_boundaries(longest, counts, total, k)
            last = len(longest) - 1
            best = min(_padding(longest, counts, total, [*c, last]) for m in range(min(k, last + 1)) for c in combinations(range(last), m))
            assert ends[-1] == last and _padding(longest, counts, total, ends) == best


def test_cells_keep_the_order_of_lengths(spark):
    lengths = [*range(2000), *(1 << k for k in range(11, 40)), *((1 << k) + 1 for k in range(11, 40))]
    cells = [r[0] for r in spark.createDataFrame([(n,) for n in sorted(lengths)], "n bigint").select(packing.cell_of(F.col("n"))).collect()]
    assert cells == sorted(cells) and len(set(cells)) < 2500 and cells[:128] == list(range(128))


def test_cascade_is_exact_with_few_bits(spark, monkeypatch):
    monkeypatch.setattr(urls, "BITS_PER_KEY", 2)
    monkeypatch.setattr(urls, "PROBES", 1)
    universe = spark.range(3000).select(F.concat(F.lit("h"), F.col("id").cast("string")).alias("key"))
    listed = universe.where(F.pmod(F.xxhash64("key"), F.lit(7)) == 0).union(spark.createDataFrame([("elsewhere",)], "key string"))
    known = universe.join(listed.withColumn("known", F.lit(True)), "key", "left")
    plain, bound = urls.build_cascade(listed, universe), urls.build_cascade(listed, universe, most=460)
    # Where too many keys would pass wrongly, a level has more bits.
    assert len(plain.levels) > 2 and bound.levels[0].bits > plain.levels[0].bits
    for cascade in (plain, bound):
        assert known.where(cascade.holds(F.col("key")) != F.coalesce("known", F.lit(False))).count() == 0
    with pytest.raises(ValueError, match="listed keys"):
        urls.build_cascade(listed, universe, most=100)
    monkeypatch.setattr(urls, "MAX_BITS", 64)
    with pytest.raises(ValueError, match="wrongly"):
        urls.build_cascade(listed, universe, most=460)
    assert urls.build_cascade(listed.limit(0), universe).levels == ()


def test_sketches_of_parts_merge(spark):
    words = [f"w{k}" for k in range(900)]
    texts = [(0, " ".join(words)), (1, " ".join(words[:600])), (2, " ".join(words[300:])), (3, "w1 w2")]
    made = fingerprints.with_sketch(spark.createDataFrame(texts, "id int, text string"), "text", "s")
    sketch = {r["id"]: r["s"] for r in made.collect()}
    parts = made.where("id in (1, 2)").withColumn("g", F.lit("g"))
    merged = fingerprints.merge(parts, ["g"], "s").first()["s"]
    assert merged == sketch[0]  # the parts overlap, so together they have all shingles of the whole
    both = made.alias("a").where("id = 1").select(F.col("s").alias("a")).crossJoin(made.where("id = 0").select(F.col("s").alias("b")))
    found = both.select(
        fingerprints.resemblance("a", "b").alias("r"), fingerprints.containment("a", "b").alias("c"), fingerprints.distinct_shingles("b").alias("n")
    ).first()
    assert abs(found["r"] - 596 / 896) < 0.2 and found["c"] > 0.75 and abs(found["n"] - 896) < 350
    assert len(sketch[3]) == 1


def test_label_propagation_over_several_hubs(spark):
    # Ten communities of 40 rows, each row in two of its community's five hubs.
    links = [(r, f"{r // 40}-{h}") for r in range(400) for h in (r % 5, (r * 3 + 1) % 5)]
    rows_ = spark.createDataFrame([(r,) for r in range(640)], "row bigint")
    hubs = spark.createDataFrame(sorted(set(links)), "row bigint, hub string")

    def cut(shard):
        return sum(shard[a] != shard[b] for a in range(400) for b in range(a) if a // 40 == b // 40)

    start = {r["row"]: r["shard"] for r in sharding.balanced(rows_, hubs, 8, 0).collect()}
    after = {r["row"]: r["shard"] for r in sharding.balanced(rows_, hubs, 8, 6).collect()}
    sizes = np.bincount([after[r] for r in range(640)], minlength=8)
    assert sizes.max() - sizes.min() <= 1 and cut(after) < 0.75 * cut(start)


def test_masking(spark):
    text = "ü write to a.b@c.org or call +1 (555) 555-1234 now"
    found = pii.detect(spark.createDataFrame([(text,), (None,), ("plain",)], "text string"), out="spans")
    shown = [r[0] for r in found.select(pii.masked(F.col("text"), F.col("spans"))).collect()]
    assert shown == ["ü write to <EMAIL> or call <PHONE> now", None, "plain"]


def test_reliabilities_tell_good_labelers(spark):
    patterns = [("card", 1, 1, 1, 1, 1, 2, 60), ("card", 1, 1, -1, 1, 1, 2, 10), ("card", -1, 0, -1, -1, 0, 2, 80), ("card", -1, 1, 0, -1, 0, 2, 20), ("email", 1, 1, 0, 1, 1, 0, 50)]
    counts = spark.createDataFrame(patterns, "kind string, regex int, gazetteer int, context int, shape int, length int, digits int, n bigint")
    model = pii.fit(counts)
    assert model.reliability["regex"] > model.reliability["context"] > 0.5
    votes = F.struct(*[F.lit(v).alias(n) for n, v in zip(pii._TRAITS, patterns[0][:7], strict=True)])
    against = F.struct(*[F.lit(v).alias(n) for n, v in zip(pii._TRAITS, patterns[2][:7], strict=True)])
    good, bad = spark.range(1).select(model.probability(votes), model.probability(against)).first()
    assert good > 0.9 > 0.1 > bad


def test_misspelt_words_share_subwords():
    rng = np.random.default_rng(2)
    plain = ["river", "stone", "garden", "window", "letter", "summer", "bridge", "market"]
    clean = [" ".join(rng.choice(plain, 30)) for _ in range(150)]
    toxic = [" ".join([*rng.choice(plain, 20), "dreadfulness", *rng.choice(plain, 10)]) for _ in range(150)]
    model = toxicity.fit([t.encode() for t in clean + toxic], np.array([0] * 150 + [1] * 150))
    seen, misspelt, other = (model.score(f"river stone {w} garden window".encode()) for w in ("dreadfulness", "dredfulness", "marketstone"))
    assert seen > 0.5 and misspelt > 0.5 > other


def test_exact_cosine_votes():
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["abc", "abd", "acd"], 20)) for _ in range(40)] + ["### !!! " * 10 + str(k) for k in range(40)]
    counts = np.stack([quality.term_counts(t.encode()) for t in texts])
    model = quality.fit(counts, np.array([1] * 40 + [0] * 40))
    got = model.score(counts)
    v = model.project(counts)
    for k in range(0, 80, 7):
        near = np.maximum(v[k] @ model.vectors.T, 0)
        top = np.argsort(-near)[: quality.NEIGHBOURS]
        weight = near[top].astype(np.float64) ** quality.POWER + 1e-9
        assert abs(got[k] - (weight * model.labels[top]).sum() / weight.sum()) < 1e-3
    assert got[:40].min() > 0.5 > got[40:].max()


CLASHES = [
    (lambda d: urls.judge(d.withColumns({"url": F.lit("http://a.net/"), "HOST": F.lit(1)})), "host"),
    (lambda d: packing.packed(d.withColumn("bucket", F.lit("x"))), "bucket"),
    (lambda d: simhash.near_duplicates(d.withColumn("fingerprint", F.lit(1))), "fingerprint"),
    (lambda d: simhash.with_fingerprint(d, "text", "code"), "code"),
    (lambda d: pii.detect(d.withColumn("Spans", F.lit(1))), "spans"),
    (lambda d: quality.scored(d, quality.fit(np.zeros((0, quality.TERMS), np.float32), np.zeros(0))), "score"),
    (lambda d: toxicity.scored(d, toxicity.fit([], np.zeros(0, int))), "score"),
]


@pytest.mark.parametrize(("add", "name"), CLASHES)
def test_an_output_replaces_a_column_of_its_name(spark, odd_dir, add, name):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    made = add(docs)
    assert [c.lower() for c in made.columns].count(name) == 1
    assert made.count() == docs.count() and made.select(name).where(F.col(name).isNull()).count() == 0

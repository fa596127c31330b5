"""Label propagation goes on until it is settled."""

from rollbook.llm import sharding


def test_a_hot_group_fills_few_shards(spark):
    # A third of all rows is one group, and shards have 20 rows: the group fills 8 of 24, pairs lie together.
    rows = spark.createDataFrame([(r,) for r in range(480)], "row bigint")
    links = spark.createDataFrame([(r, "hot") for r in range(160)] + [(r, f"p{r // 2}") for r in range(160, 260)], "row bigint, hub string")
    shard = {r["row"]: r["shard"] for r in sharding.balanced(rows, links).collect()}
    sizes = [list(shard.values()).count(s) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1
    assert len({shard[r] for r in range(160)}) <= 10
    assert sum(shard[r] != shard[r + 1] for r in range(160, 260, 2)) <= 2

"""Sharding by balanced label propagation.

Documents are linked through hubs: a hub joins all its members (documents of equal text, in the registered query; any
table of (row, hub) will do). A shard is a label. At first rows are dealt out evenly by a hash. Then, round by round,

1. every hub counts its members per shard, by an aggregation that combines before the shuffle, as one short array;
2. every linked row adds up the arrays of its hubs. Its home is the shard with most of its neighbours that has room for
   them all or, if none has, as many of the fullest as hold them together. Ties go the same way for all members of a
   hub, so a group doesn't swap places for ever. Rows elsewhere wish for a home, by a running total of the homes' room;
3. wishes are granted up to each shard's quota, the number of its rows without links: these make way. The number of
   rows that come and go differs, so rows without links move from shards with too many to shards with too few.

Rounds go on until no wish is granted or a round brings no more neighbours together. After every round shards differ by one row at most (law ``rows``). A group larger than a shard fills several. Pairs of
members are never made: a hub costs one row per member and one array. Only shard-by-shard totals reach the driver.

Defined cases: a null text has no bytes and equals an empty one. Repeated rows are placed each, and are linked by their
text. Null ids are placed as well. Empty tables give empty results. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import constant_array, discard, numbered, slices_for, staged

SHARDS = 24


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, id, size, text_crc32, hub): a row number of its own for every row, and what the text amounts to."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(doc_id).alias("id"),
        (F.octet_length(raw) + 8).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.unhex(F.md5(raw)).alias("hub"),
    )
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "rows")


def links_of(rows: DataFrame, hub: str = "hub") -> DataFrame:
    """(row, hub) of the hubs with more than one member."""
    shared = rows.groupBy(hub).agg(F.count("*").alias("n")).where(F.col("n") > 1).select(hub)
    return staged(rows.join(shared, hub, "left_semi").select("row", F.col(hub).alias("hub")), "links")


def _wishes(state: DataFrame, links: DataFrame, room: list[int], shards: int, slices: int) -> DataFrame:
    """(row, shard, wish) of the linked rows that want to move."""
    placed = links.join(state, "row")
    counts = placed.groupBy("hub", "shard").agg(F.count("*").alias("n"))
    held = counts.groupBy("hub").agg(F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("held"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.coalesce(F.element_at("held", s), F.lit(0)))
    votes = placed.join(held.select("hub", dense.alias("votes")), "hub")
    one = votes.groupBy("row", "shard").agg(F.collect_list("votes").alias("all"), F.min("hub").alias("hub"))
    total = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.struct(
            F.aggregate("all", F.lit(0).cast("bigint"), lambda t, v: t + F.element_at(v, s + 1)).alias("n"),
            F.xxhash64("hub", s).alias("tie"),
            s.alias("s"),
        ),
    )
    space = lambda s: F.element_at(constant_array(room), s + 1)
    every = F.aggregate("total", F.lit(0).cast("bigint"), lambda t, x: t + x["n"])
    ranked = F.sort_array(
        F.transform("total", lambda x: F.struct((x["n"] + space(x["s"]) >= F.col("every")).alias("whole"), x["n"].alias("n"), x["tie"].alias("tie"), x["s"].alias("s"))), asc=False
    )
    start = F.struct(F.lit(0).cast("bigint").alias("held"), F.array().cast("array<int>").alias("of"))
    step = lambda t, x: F.when(
        t["held"] < F.col("every"),
        F.struct((t["held"] + x["n"] + space(x["s"])).alias("held"), F.concat(t["of"], F.array(x["s"])).alias("of")),
    ).otherwise(t)
    homes = one.select("row", "shard", "hub", total.alias("total")).withColumn("every", every).withColumn("ranked", ranked)
    homes = homes.select("row", "shard", "hub", F.aggregate("ranked", start, step, lambda t: t["of"]).alias("homes"))
    movers = numbered(homes.where(~F.array_contains("homes", F.col("shard"))), ["hub"], "row", "at", slices)
    none = F.struct(F.col("at").cast("bigint").alias("left"), F.lit(None).cast("int").alias("s"))
    pick = lambda t, s: F.struct((t["left"] - space(s)).alias("left"), F.when(t["s"].isNull() & (t["left"] < space(s)), s).otherwise(t["s"]).alias("s"))
    wished = movers.select("row", "shard", F.aggregate("homes", none, pick, lambda t: t["s"]).alias("wish"))
    return wished.where(F.col("wish").isNotNull())


def _range_of(at: Column, sizes: list[int]) -> Column:
    """The index of the range of sizes that a number falls into."""
    ends, total = [], 0
    for n in sizes:
        total += n
        ends.append(total)
    return F.size(F.filter(constant_array(ends), lambda e: e <= at)).cast("int")


def balanced(rows: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """(row, shard) after label propagation; ``rows`` has ``row``, ``links`` has (row, hub). Counts stay even."""
    slices = slices_for(rows.count())
    linked = links.select("row").distinct().withColumn("linked", F.lit(True))
    state = rows.select("row").join(linked, "row", "left").select("row", F.coalesce("linked", F.lit(False)).alias("linked"))
    state = numbered(state, [], "row", "at", slices)
    state = staged(state.select("row", "linked", (F.col("at") % shards).cast("int").alias("shard")), "state0")
    number, best = 0, 0
    while rounds is None or number < rounds:
        number += 1
        totals = {r["shard"]: (r["n"], r["free"]) for r in state.groupBy("shard").agg(F.count("*").alias("n"), F.count_if(~F.col("linked")).alias("free")).collect()}
        size = [totals.get(s, (0, 0))[0] for s in range(shards)]
        room = [totals.get(s, (0, 0))[1] for s in range(shards)]
        wishes = staged(_wishes(state.select("row", "shard"), links, room, shards, slices), f"wishes{number}")
        granted = numbered(wishes, ["wish"], "row", "at", slices).where(F.col("at") < F.element_at(constant_array(room), F.col("wish") + 1))
        granted = staged(granted.select("row", "shard", "wish"), f"granted{number}")
        flows = granted.groupBy("shard", "wish").agg(F.count("*").alias("n")).collect()  # shards squared at most
        moved = sum(f["n"] for f in flows)
        if not moved:
            discard(wishes, granted)
            return state.select("row", "shard")
        change = [sum(f["n"] for f in flows if f["wish"] == s) - sum(f["n"] for f in flows if f["shard"] == s) for s in range(shards)]
        over = [max(0, c) for c in change]  # so many free rows leave a shard,
        under = [max(0, -c) for c in change]  # and so many come to one
        ahead = [sum(over[:s]) for s in range(shards)]
        free = numbered(state.where(~F.col("linked")), ["shard"], "row", "at", slices)
        leaving = free.where(F.col("at") < F.element_at(constant_array(over), F.col("shard") + 1))
        place = F.element_at(constant_array(ahead), F.col("shard") + 1) + F.col("at")
        moves = granted.select("row", "wish").union(leaving.select("row", _range_of(place, under).alias("wish")))
        before = state
        state = staged(state.join(moves, "row", "left").select("row", "linked", F.coalesce("wish", "shard").alias("shard")), f"state{number}")
        discard(wishes, granted)
        together = links.join(state, "row").groupBy("hub", "shard").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * F.col("n"))).first()[0]
        if rounds is None and together <= best:
            state = before
            break
        best = together
        discard(before)
    return state.select("row", "shard")


def sharded(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``hub`` (digest of the text), ``shard``, ``slot``."""
    rows = measured(docs, doc_id, text)
    placed = rows.join(balanced(rows, links_of(rows), shards, rounds), "row")
    slots = numbered(placed, ["shard"], "row", "slot", slices_for(rows.count()))
    return slots.select(F.col("id").alias(doc_id), "size", "text_crc32", "hub", "shard", "slot")

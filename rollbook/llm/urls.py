"""Native URL filter: a cascade of Bloom filters gives exact membership of listed keys, without a join.

A key is a host (or one of its parent domains, cut at a dot) followed by a beginning of the path, such as
``example.net/en/``. The *universe* is every key that any url of the corpus has. Level 0 of a cascade encodes the listed
keys. Those keys of the universe that pass it without being listed are encoded in level 1, those listed keys that pass
level 1 in level 2, and so on until no key passes wrongly. A key of the universe is listed exactly if the first level
that it does not pass is an odd one (or, where it passes them all, if the number of levels is odd).

The levels are arrays of 64-bit words and go into the plan as constants: probing is arithmetic on columns. Building
works on the distinct keys of the corpus, of which only those in doubt are carried on. ``MAX_LISTED`` bounds a list and
so the size of its levels; a longer list is refused, never cut. The universe may be of any size: a level that so many keys
of it pass wrongly that the next one would exceed that bound is made anew with twice the bits, up to ``MAX_BITS``.

Defined cases: a null url, or one without ``://``, has an empty host and an empty path and fits no rule. An empty host
fits none either. Repeated rows get one result each. Empty tables give empty results. Other columns are kept; one with
the name of an output is replaced by it. Of two rules of equal length that fit, the blocking one wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import constant_array, discard, free_of, small_table, staged

MAX_LISTED = 1_000_000  # keys of one list: with 12 bits a key at most 1.5 MB in a plan
BITS_PER_KEY = 12
MAX_BITS = 1 << 27  # of one level: 16 MB
PROBES = 4
MAX_LEVELS = 24

# (action, host, path): the longest rule that fits decides.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Registered names, in any of these domains, whose pages are blocked where no rule fits.
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_DOMAINS = ("example.com", "example.net", "example.org")
LISTED_HOSTS = tuple(f"{name}.{domain}" for name in LISTED_NAMES for domain in LISTED_DOMAINS)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: up to ``?`` or ``#``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def keys_of(host: Column, path: Column, labels: Sequence[int], lengths: Sequence[int]) -> Column:
    """All keys of a url that a rule can equal: parents of so many labels, joined to paths cut at so many characters."""
    n = F.size(F.split(host, r"\."))
    hosts = F.filter(
        F.array(*[F.when((n >= k) & (host != ""), F.substring_index(host, ".", -k)) for k in labels]), lambda x: x.isNotNull()
    )
    paths = F.filter(
        F.array(*[F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in lengths]), lambda x: x.isNotNull()
    )
    return F.array_distinct(F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p)))))


@dataclass(frozen=True)
class Level:
    bits: int
    words: list[int] = field(repr=False)

    def passes(self, key: Column, number: int) -> Column:
        held = constant_array(self.words)
        tests = [
            F.getbit(F.element_at(held, (at / 64).cast("int") + 1), F.pmod(at, F.lit(64)).cast("int")) == 1
            for at in _positions(key, number, self.bits)
        ]
        return reduce(Column.__and__, tests)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe is listed: exact, one level after the other only as far as needed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for number in reversed(range(len(self.levels))):
            answer = F.when(self.levels[number].passes(key, number), answer).otherwise(F.lit(number % 2 == 1))
        return answer


def _positions(key: Column, number: int, bits: int) -> list[Column]:
    first, step = F.xxhash64(F.lit(number), key), F.xxhash64(F.lit(-1 - number), key)
    mask = (1 << 40) - 1  # sums stay within 64 bits
    return [F.pmod(first.bitwiseAND(F.lit(mask)) + F.lit(k) * step.bitwiseAND(F.lit(mask)), F.lit(bits)) for k in range(PROBES)]


def _level(keys: DataFrame, number: int, bits: int) -> Level:
    """The filter of some distinct keys: bits are or-ed per 64-bit word by Spark; the words are at most bits / 64."""
    set_bits = keys.select(F.explode(F.array(*_positions(F.col("key"), number, bits))).alias("at"))
    words = set_bits.groupBy((F.col("at") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("at", F.lit(64)).cast("int"))).alias("value")
    )
    held = [0] * (bits // 64)
    for row in words.collect():
        held[row["word"]] = row["value"]
    return Level(bits, held)


def _narrow_level(keys: DataFrame, count: int, others: DataFrame, number: int, most: int) -> tuple[Level, DataFrame, int]:
    """A filter of ``keys`` that at most ``most`` of the ``others`` pass, these others, and their number."""
    bits = 64 * max(1, -(-count * BITS_PER_KEY // 64))
    while True:
        level = _level(keys, number, bits)
        passing = staged(others.where(level.passes(F.col("key"), number)), f"doubt{number}")
        if (wrongly := passing.count()) <= most:
            return level, passing, wrongly
        if bits >= MAX_BITS:
            raise ValueError(f"{wrongly} keys pass level {number} of {bits} bits wrongly; the next holds {most}")
        discard(passing)
        bits = min(2 * bits, MAX_BITS)


def build_cascade(listed: DataFrame, universe: DataFrame, most: int = MAX_LISTED) -> Cascade:
    """The cascade of the distinct ``key`` of ``listed`` over those of ``universe``; both are read whole."""
    listed = listed.select("key").where(F.col("key").isNotNull()).distinct()
    count = listed.count()
    if count > most:
        raise ValueError(f"{count} listed keys; one cascade holds {most}: split the list")
    if count == 0:
        return Cascade(())
    levels, inside, outside = [], listed, universe.join(listed, "key", "left_anti")
    while count > 0:
        if len(levels) == MAX_LEVELS:
            raise ValueError(f"{count} keys are left after {MAX_LEVELS} levels")
        level, passing, count = _narrow_level(inside, count, outside, len(levels), most)
        levels.append(level)
        discard(outside)
        inside, outside = passing, inside
    discard(inside, outside)
    return Cascade(tuple(levels))


def judge(
    pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, hosts: Sequence[str] = LISTED_HOSTS
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``.

    ``rules`` are (action, host, path); a rule fits its host and all subdomains if the path starts with the rule's.
    ``hosts`` and their subdomains are blocked where no rule fits; everything else is allowed.
    """
    pages = free_of(pages, "host", "path", "rule", "verdict", "__url", "__keys", "__host_keys")
    spark = pages.sparkSession
    host, path = host_and_path(F.col("__url"))
    keyed = pages.withColumn("__url", F.col(url)).withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    labels = sorted({h.count(".") + 1 for _, h, _ in rules})
    lengths = sorted({len(p) for _, _, p in rules})
    host_labels = sorted({h.count(".") + 1 for h in hosts})
    rule_keys = keys_of(F.col("host"), F.col("path"), labels, lengths) if rules else F.array().cast("array<string>")
    host_keys = keys_of(F.col("host"), F.lit(""), host_labels, [0]) if hosts else F.array().cast("array<string>")
    keyed = keyed.withColumns({"__keys": rule_keys, "__host_keys": host_keys})

    every = keyed.select(F.explode(F.array_union("__keys", "__host_keys")).alias("key")).distinct()
    universe = staged(every, "url-keys")

    def cascade(listed: list[str]) -> Cascade:
        return build_cascade(small_table(spark, [{"key": k} for k in listed], "key: string"), universe)

    block = cascade([h + p for action, h, p in rules if action == "block"])
    allow = cascade([h + p for action, h, p in rules if action == "allow"])
    listed = cascade(list(hosts))
    discard(universe)

    # A struct's first field decides: the longest key, then "block" before "allow".
    def best(action: str, found: Cascade) -> Column:
        held = F.filter("__keys", lambda k: found.holds(k))
        return F.transform(held, lambda k: F.struct(F.length(k).alias("n"), F.lit(action).alias("action"), k.alias("key")))

    top = F.array_max(F.concat(best("block", block), best("allow", allow)))
    own = F.when(F.exists("__host_keys", lambda k: listed.holds(k)), F.lit("block")).otherwise(F.lit("allow"))
    return (
        keyed.withColumn("__top", top)
        .withColumn("rule", F.col("__top.key"))
        .withColumn("verdict", F.coalesce(F.col("__top.action"), own))
        .drop("__url", "__keys", "__host_keys", "__top")
    )

"""Join shapes shared by the reports.

Look-up sides are broadcast only when Spark's own size estimate, or the size AQE measures at run time, is under
``spark.sql.autoBroadcastJoinThreshold``; beyond that the join is sort-merge. No size is assumed here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def look_up(facts: DataFrame, lookup: DataFrame, on: dict[str, str], take: dict[str, str]) -> DataFrame:
    """LEFT join of ``facts`` to a table that holds one row per key.

    ``on`` maps fact columns to look-up columns, ``take`` maps look-up columns to their names in the result.
    Only the named columns are read. A hot key sits on the fact side, which AQE splits in a left join.
    """
    renamed = {key: f"__key_{i}" for i, key in enumerate(on.values())}
    right = lookup.select(
        *[F.col(key).alias(name) for key, name in renamed.items()],
        *[F.col(source).alias(target) for source, target in take.items()],
    )
    condition = [facts[fact] == right[renamed[key]] for fact, key in on.items()]
    return facts.join(right, condition, "left").drop(*renamed.values())


def expand(facts: DataFrame, many: DataFrame, on: Sequence[str]) -> DataFrame:
    """LEFT join of ``facts`` to a table that holds any number of rows per key.

    A left join can be split only on its left side, so a key with very many rows on the right would end in one
    task. The matches are therefore an inner join, which AQE can split on both sides, and the facts without a
    match are added by an anti join against the distinct keys. ``on`` is a key of ``facts`` and never NULL there;
    saying so on both branches lets them share one shuffle of the facts.
    """
    on = list(on)
    for column in on:
        facts = facts.filter(F.col(column).isNotNull())
    matched = facts.join(many, on, "inner")
    unmatched = facts.join(many.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)

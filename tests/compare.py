"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None) is not None:
        return value.replace(tzinfo=None)
    return value


def differences(spark_df, con, sql: str) -> str | None:
    """None when both give the same columns and the same rows, as often."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    expected = relation.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    actual = [tuple(_plain(r[n]) for n in names) for r in spark_df.collect()]
    wanted = Counter(tuple(_plain(v) for v in row) for row in expected)
    got = Counter(actual)
    if got == wanted:
        return None
    return (
        f"{len(actual)} rows against {len(expected)}; only here {list((got - wanted).items())[:3]}; "
        f"only there {list((wanted - got).items())[:3]}"
    )

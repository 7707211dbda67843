"""Run registered queries next to their SQL in DuckDB and compare."""

from __future__ import annotations

import math
import os
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def as_bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        Counter(tuple(_value(row[i]) for i in order) for row in rows),
    )


def spark_bag(df):
    return as_bag(df.columns, [tuple(r) for r in df.collect()])


def duck_bag(connection, sql):
    relation = connection.sql(sql)
    return as_bag(relation.columns, relation.fetchall())


def difference(mine, theirs) -> str | None:
    """None if equal, else a short account."""
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if mine[1] == theirs[1]:
        return None
    only_mine, only_theirs = mine[1] - theirs[1], theirs[1] - mine[1]
    return (
        f"rows {sum(mine[1].values())} vs {sum(theirs[1].values())}; "
        f"only spark {list(only_mine)[:2]}; only sql {list(only_theirs)[:2]}"
    )

"""Distributed running totals against a plain loop; one key holds most rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import prefix


def plain(rows):
    """Running total per key of (key, order, amount) rows."""
    sums, out = {}, []
    for key, order, amount in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        sums[key] = sums.get(key, 0) + (amount or 0)
        out.append((key, order, sums[key]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [True, False])
def test_running_totals_with_a_hot_key(spark, rows, monkeypatch, small):
    if not small:
        monkeypatch.setattr(prefix, "broadcast_if_small", lambda frame, **_: frame)
    data = [("hot" if i % 3 else None if i % 7 == 0 else f"k{i % 11}", (i * 7919) % 3001, i % 13 or None) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, o int, v bigint").repartition(5)
    out = prefix.running_totals(df, ["o"], {"total": F.col("v")}, by=["k"], ties=False)
    assert rows(out, "k", "o", "total") == plain(data)


def test_dense_numbers_keep_the_order_and_have_no_gaps(spark):
    data = [(i % 10, i) for i in range(2000)]
    df = spark.createDataFrame(data, "o int, id int").repartition(6)
    out = [tuple(r) for r in prefix.dense_numbers(df, ["o"], "n", first=5).orderBy("n").select("o", "n").collect()]
    assert [n for _, n in out] == list(range(5, 2005))
    assert [o for o, _ in out] == sorted(o for o, _ in data)


def test_ties_spread_over_ranges(spark):
    df = spark.range(4000).select(F.lit(1).alias("o"))
    out = prefix.dense_numbers(df, ["o"], "n")
    assert out.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[:] == (1, 4000, 4000)
    assert prefix.dense_numbers(df.where("false"), ["o"], "n").count() == 0


def test_plan_has_no_window_over_everything(spark, plan):
    df = spark.range(1000).select((F.col("id") % 5).alias("o"))
    text = plan(prefix.dense_numbers(df, ["o"], "n"))
    assert "SinglePartition" not in text and "CartesianProduct" not in text and "NestedLoop" not in text

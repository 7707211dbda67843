"""One key holds a third of all rows: results stay whole and plans stay flat."""

import collections
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, joins, lending, quality
from tidemark.sinks import tables

ROWS = 30000


@pytest.fixture(scope="module")
def hot(spark):
    """Key 0 holds a third of the rows, as exact copies; the rest is spread."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)
    return (
        spark.range(ROWS, numPartitions=8)
        .select(
            key.cast("bigint").alias("k"),
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"),
        )
        .cache()
    )


@pytest.fixture(scope="module")
def local(hot):
    return [tuple(r) for r in hot.collect()]


def test_latest_sends_one_row_per_key_and_task(hot, local, plan, rows):
    latest = dedup.latest_per_key(hot, ["k"], ["v"])
    want = {}
    for k, v in local:
        want[k] = max(v, want.get(k, v))
    assert rows(latest) == sorted(want.items(), key=repr)
    text = plan(latest)
    assert text.index("Partial") > text.index("Exchange hashpartitioning")  # below the exchange
    assert "Final" in text


@pytest.mark.parametrize("small", [True, False])
def test_rare_duplicates_give_the_same_rows(spark, hot, rows, monkeypatch, small):
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "k bigint, v bigint")
    df = hot.unionByName(nulls)
    if not small:
        monkeypatch.setattr(dedup, "broadcast_if_small", lambda frame, **_: frame)
    assert rows(dedup.latest_where_rare(df, ["k"], ["v"])) == rows(
        dedup.latest_per_key(df, ["k"], ["v"])
    )


def test_rare_duplicates_shuffle_no_key(spark, rows, monkeypatch):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 2, 3), (None, 1, 4), (None, 1, 5), ("b", 1, 6)], "k string, n int, v int")
    kept, plain = [], dedup.staged
    monkeypatch.setattr(dedup, "staged", lambda frame, name: kept.append(frame) or plain(frame, name))
    want = rows(dedup.latest_per_key(df, ["k", "n"], ["v"]))
    assert rows(dedup.latest_where_rare(df, ["k", "n"], ["v"])) == want
    assert [f.dtypes for f in kept] == [[("_key_hash", "bigint")]]
    # keys that share a hash are told apart
    monkeypatch.setattr(dedup.F, "xxhash64", lambda *_: dedup.F.lit(7).cast("bigint"))
    assert rows(dedup.latest_where_rare(df, ["k", "n"], ["v"]), "k", "n", "v") == want


def test_counts(hot, local, rows):
    counts = collections.Counter(k for k, _ in local)
    assert rows(quality.duplicate_keys(hot, ["k"])) == sorted(
        ((k, n) for k, n in counts.items() if n > 1), key=repr
    )
    row = quality.key_violations(hot, "hot", ["k"]).first()
    assert (row.rows, row.distinct_keys) == (ROWS, len(counts))


@pytest.mark.parametrize("small", [True, False])
def test_orphans_with_a_hot_missing_key(spark, hot, local, rows, monkeypatch, small):
    parents = spark.range(1, 900).select(F.col("id").alias("p"))
    want = sorted(((k, v) for k, v in local if not 1 <= k < 900), key=repr)
    if not small:  # as if the missing keys were too many to broadcast
        monkeypatch.setattr(joins, "broadcast_if_small", lambda df, **_: df)
        monkeypatch.setattr(joins, "_HOT_KEYS", 3)
    assert rows(joins.orphan_rows(hot, parents, ["k"], ["p"])) == want
    counts = collections.Counter(k for k, _ in want)
    got = joins.orphan_counts(hot, parents, ["k"], ["p"])
    assert rows(got) == sorted(counts.items(), key=repr)


def test_null_keys_are_orphans(spark, rows):
    child = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "k int, v string")
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(joins.orphan_rows(child, parent, ["k"])) == [(None, "b"), (None, "c")]


def test_orphans_against_a_hot_parent(spark, hot, rows):
    child = spark.createDataFrame([(0,), (5,), (5000,)], "k bigint")
    assert rows(joins.orphan_rows(child, hot, ["k"])) == [(5000,)]


def test_running_balance_of_a_hot_loan(spark, local, rows):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("v") % 50).cast("int"))
    payments = spark.createDataFrame(local, "k bigint, v bigint").select(
        F.col("k").alias("loan"), day.alias("value_date"), (F.col("v") % 7).alias("paid_cents")
    )
    opening = payments.select("loan").distinct().withColumn("amount_cents", F.lit(10**9))
    got = rows(lending.running_balance(opening, payments), "loan", "value_date", "paid_so_far")
    per_day = collections.defaultdict(int)
    for k, v in local:
        per_day[k, dt.date(2024, 1, 1) + dt.timedelta(days=v % 50)] += v % 7
    want, total, last = [], 0, None
    for (loan, date), paid in sorted(per_day.items()):
        total = paid if loan != last else total + paid
        last = loan
        want.append((loan, date, total))
    assert got == sorted(want, key=repr)


def test_hot_date_is_written_by_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        day = F.when(F.col("id") % 3 != 2, "2024-01-01").otherwise("2024-01-02").cast("date")
        df = spark.range(0, 400000, numPartitions=8).select(
            F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("t"), day.alias("dt")
        )
        tables.load_bronze(df, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    hot_files = list((tmp_path / "t" / "dt=2024-01-01").glob("*.parquet"))
    assert len(hot_files) > 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400000


def test_broadcast_needs_a_measured_size(spark, plan):
    small, large = spark.range(10), spark.range(5000)
    assert joins.broadcast_if_small(small) is not small
    assert joins.broadcast_if_small(large, max_rows=100) is large
    assert joins.broadcast_if_small(large, threshold_mb=0.01) is large

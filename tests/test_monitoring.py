"""Sketches, outages, volumes, tokens and samples against plain Python, with one hot key."""

import collections
import datetime as dt
import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import monitoring, sampling, tokens

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def test_merged_sketches_stay_within_their_error(spark):
    draws = random.Random(2)
    data = [("hot" if i % 3 else f"t{i % 5}", day(i % 40), int(draws.paretovariate(1.2) * 100), i % 4001) for i in range(30000)]
    df = spark.createDataFrame(data, "t string, d date, v bigint, k int").repartition(7)
    daily = monitoring.daily_sketches(df, ["t"], "d", F.col("v"), F.col("k"))
    merged = monitoring.merged_sketches(daily, "t").select(
        "t", "n", monitoring.distinct_keys().alias("keys"), *[monitoring.quantile(q).alias(f"q{int(100 * q)}") for q in (0.5, 0.95)]
    )
    for r in merged.collect():
        values = sorted(v for t, _, v, _ in data if t == r.t)
        assert r.n == len(values)
        for q, got in ((0.5, r.q50), (0.95, r.q95)):
            low, high = sum(v < got for v in values), sum(v <= got for v in values)
            assert low / r.n - 0.02 <= q <= high / r.n + 0.02
        exact = len({k for t, _, _, k in data if t == r.t})
        assert abs(r["keys"] - exact) <= 0.08 * exact


def test_a_sketch_of_nulls_has_no_quantile(spark):
    df = spark.createDataFrame([("a", day(0), None, 1)], "t string, d date, v bigint, k int")
    daily = monitoring.daily_sketches(df, ["t"], "d", F.col("v"), F.col("k"))
    assert monitoring.merged_sketches(daily, "t").select("n", monitoring.quantile(0.5)).first()[:] == (1, None)


def test_outages_and_streaks(spark, rows):
    start, end = str(day(0)), str(day(9))
    log = [("a", day(n), "SUCCESS") for n in (-5, 2, 3, 6)] + [("a", day(3), "FAILED"), ("a", day(4), "FAILED"), ("b", day(0), "SUCCESS")]
    log += [("b", day(n), "SUCCESS") for n in range(1, 10)] + [("hot", day(5), "FAILED")] * 500
    df = spark.createDataFrame(log, "table_id string, run_dt date, status string").repartition(3)
    feeds = spark.createDataFrame([("a",), ("b",), ("hot",), ("never",)], "table_id string")
    assert rows(monitoring.outages(df, feeds, start, end)) == sorted(
        [("a", day(0), day(1), 2, 0, False), ("a", day(4), day(5), 2, 1, False), ("a", day(7), day(9), 3, 0, True),
         ("hot", day(0), day(9), 10, 1, True), ("never", day(0), day(9), 10, 0, True)], key=repr
    )
    assert rows(monitoring.streaks(df, start, end)) == sorted(
        [("a", day(2), day(3), 2, False), ("a", day(6), day(6), 1, False), ("b", day(0), day(9), 10, True)], key=repr
    )


def test_volume_anomalies_count_missing_days(spark):
    counts = {n: 100 + n % 3 for n in range(60) if n not in (20, 21)}
    counts[40] = 900
    df = spark.createDataFrame([("t", day(n), c) for n, c in counts.items()] + [("flat", day(n), 5 + (n == 9)) for n in range(12)], "table_name string, dt date, records bigint")
    found = {(r.table_name, (r.dt - DAY).days): r for r in monitoring.volume_anomalies(df).collect()}
    assert len([k for k in found if k[0] == "t"]) == 60
    for n in range(60):
        before = [counts.get(m, 0) for m in range(max(0, n - 28), n)]
        r = found["t", n]
        assert r.records == counts.get(n, 0)
        if not before:
            assert r.median is None and not r.is_anomaly
            continue
        median = statistics.median(before)
        mad = statistics.median(abs(b - median) for b in before)
        assert (r.median, r.mad) == (median, mad)
    assert {n for t, n in found if t == "t" and found[t, n].is_anomaly} == {20, 21, 40}
    assert [n for t, n in sorted(found) if t == "flat" and found[t, n].is_anomaly] == [9]


def test_vault_grows_once_and_restores(spark, tmp_path, rows):
    path = str(tmp_path / "vault")
    first = spark.createDataFrame([("ann",), ("bob",), (None,), ("ann",)] + [("hot",)] * 300, "name string")
    assert tokens.vault_at(spark, path) is None
    assert tokens.register(spark, path, first, "s") == 3
    assert tokens.register(spark, path, first, "s") == 0
    assert tokens.register(spark, path, spark.createDataFrame([("bob",), ("eve",)], "other string"), "s") == 1
    vault = tokens.vault_at(spark, path)
    expected = {n: "TOK" + hashlib.sha256(f"s|{n}".encode()).hexdigest()[:24].upper() for n in ("ann", "bob", "eve", "hot")}
    assert dict(rows(vault, "value", "token")) == expected
    hidden = tokens.tokenised(first.withColumn("kept", F.lit(1)), ["name"], "s")
    assert {r.name for r in hidden.collect()} == {expected["ann"], expected["bob"], expected["hot"], None}
    assert rows(tokens.restored(hidden, ["name"], vault).drop("kept")) == rows(first)
    with pytest.raises(Exception, match="unknown token"):
        tokens.restored(spark.createDataFrame([("TOK0",)], "name string"), ["name"], vault).collect()


def test_values_that_would_share_a_token_are_refused(spark, tmp_path):
    path = str(tmp_path / "vault")
    many = spark.range(40).select(F.col("id").cast("string").alias("v"))
    with pytest.raises(ValueError, match="share a token"):
        tokens.register(spark, path, many, "s", digits=1)
    assert tokens.vault_at(spark, path) is None


@pytest.mark.parametrize("how", [{"share": 0.1}, {"share": 0.25}, {"size": 7}, {"size": 0}, {"size": 10**6}])
@pytest.mark.parametrize("small", [True, False])
def test_sample_sizes_are_exact(spark, rows, monkeypatch, how, small):
    if not small:
        monkeypatch.setattr(sampling, "broadcast_if_small", lambda frame, **_: frame)
    data = [(i, "hot" if i % 3 else None if i % 5 == 0 else f"s{i % 7}") for i in range(3000)]
    df = spark.createDataFrame(data, "k int, s string").repartition(5)
    got = rows(sampling.fixed_sample(df, ["k"], ["s"], "salt", **how))
    by = collections.defaultdict(list)
    for k, s in data:
        by[s].append(k)
    want = []
    for s, ks in by.items():
        n = min(len(ks), int(len(ks) * how["share"] + 0.5) if "share" in how else how["size"])
        order = sorted(ks, key=lambda k: hashlib.md5(f"salt|{k}".encode()).hexdigest())
        want += [(k, s) for k in order[:n]]
    assert got == sorted(want, key=repr)


def test_a_sample_of_equal_keys_is_exact_too(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.lit("s").alias("s"))
    assert sampling.fixed_sample(df, ["k"], ["s"], "salt", size=10).count() == 10
    with pytest.raises(ValueError):
        sampling.fixed_sample(df, ["k"], ["s"], "salt")

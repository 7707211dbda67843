"""Quarantine release, nested drift and renames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import drift, nested_drift, release
from tidemark.sinks import tables
from tidemark.sources import landing

TARGET = "k int, v string, amount double, at date"


def layout(spark, ddl=TARGET):
    return spark.createDataFrame([], ddl).schema


def test_what_fits(spark):
    payloads = [
        '{"k":1,"v":"a","amount":1.5,"at":"2024-01-02"}', '{"k":"2","v":null}', '{"k":2.5}', '{"k":"x"}', '{"K":1}',
        '{"k":1,"extra":1}', "[1]", "no json", '{"at":"2024-13-01"}', '{"k":99999999999}', "{}", '{"v":{"deep":1}}',
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "payload string")
    got = {r.payload: (r._row, r._misfit) for r in release.fitted(df, layout(spark)).collect()}
    assert got[payloads[0]][0][:] == (1, "a", 1.5, dt.date(2024, 1, 2)) and got[payloads[0]][1] is None
    assert got[payloads[1]][0][:2] == (2, None) and got[payloads[1]][1] is None
    reasons = {p: got[p][1] for p in payloads[2:]}
    assert reasons[payloads[2]] == reasons[payloads[3]] == reasons[payloads[9]] == "k is no int"
    assert reasons[payloads[4]] == "unknown K" and reasons[payloads[5]] == "unknown extra"
    assert reasons[payloads[6]] == reasons[payloads[7]] == "no object"
    assert reasons[payloads[8]] == "at is no date" and reasons["{}"] is None
    strict = T.StructType([T.StructField("k", T.IntegerType(), False)])
    assert release.fitted(df.where("payload = '{}'"), strict).first()._misfit == "k is missing"


def test_released_once_and_the_rest_stays(spark, tmp_path, rows):
    path, parked = str(tmp_path / "t"), str(tmp_path / "t_quarantine")
    assert release.release(spark, parked, path) == 0
    good = spark.createDataFrame([(1, "a", 1.0, None)], TARGET)
    tables.full_refresh(good, path)
    batch = spark.createDataFrame([("7", "x", "new")] * 300 + [("8", None, "new"), ("bad", "z", "new")], "k string, v string, w string")
    outcome = drift.apply_policy(batch, good.schema, drift.QUARANTINE)
    tables.append(outcome.quarantined.withColumn("run_dt", F.lit("2024-01-01").cast("date")), parked, ["run_dt"])
    assert release.release(spark, parked, path) == 0
    assert "unknown w" in landing.read_partitioned(spark, parked).first().drift_reason
    tables.append(good.where("false").withColumn("w", F.lit("")), path)
    before = tmp_path / "copy"
    landing.read_partitioned(spark, parked).write.parquet(str(before))
    assert release.release(spark, parked, path) == 301
    table = landing.read_partitioned(spark, path)
    assert rows(table.where("k > 1").groupBy("k", "v", "w").count()) == [(7, "x", "new", 300), (8, None, "new", 1)]
    left = landing.read_partitioned(spark, parked)
    assert [(r.payload, r.drift_reason) for r in left.collect()] == [('{"k":"bad","v":"z","w":"new"}', "k is no int")]
    # a run that broke off before the quarantine was rewritten
    tables.full_refresh(spark.read.parquet(str(before)), parked, ["run_dt"])
    assert release.release(spark, parked, path) == 0
    assert landing.read_partitioned(spark, path).count() == 302


def test_nested_findings(spark):
    target = layout(spark, "a int, s struct<x:int,y:struct<z:string>>, l array<struct<p:int>>, m map<string,struct<q:int>>")
    source = layout(spark, "A int, s struct<X:bigint,y:struct<w:string>,n:struct<o:int>>, l array<struct<p:int,r:int>>, m map<string,struct<q:string>>")
    got = [(f.event, f.column, f.data_type) for f in nested_drift.find_nested_drift(source, target)]
    assert got == [
        ("MISSING", "s.y.z", "string"), ("NEW", "l[].r", "int"), ("NEW", "s.n", "struct<o:int>"), ("NEW", "s.y.w", "string"),
        ("TYPE_CHANGED", "m{}.q", "string"), ("TYPE_CHANGED", "s.X", "bigint"),
    ]
    assert nested_drift.find_nested_drift(target, target) == []
    changed = layout(spark, "a struct<b:int>, s struct<x:int,y:struct<z:string>>, l array<struct<p:int>>, m map<string,struct<q:int>>")
    assert [(f.event, f.column) for f in nested_drift.find_nested_drift(changed, target)] == [("TYPE_CHANGED", "a")]


def test_renames_follow_the_values(spark):
    ids = spark.range(5000)
    target = ids.select("id", (F.col("id") * 7).alias("amount"), (F.col("id") % 50).alias("branch"), F.lit("x").alias("note"))
    later = ids.where("id < 4500").select(
        "id", (F.col("id") % 50).alias("office"), (F.col("id") * 7).alias("sum"), (F.col("id") * 7).cast("string").alias("text"), (-F.col("id")).alias("other")
    )
    found = nested_drift.find_renames(later, target)
    assert {(a, b) for a, b, _ in found} == {("branch", "office"), ("amount", "sum")}
    assert {s for a, _, s in found if a == "branch"} == {1.0} and 0.8 < [s for a, _, s in found if a == "amount"][0] < 1
    assert set(nested_drift.with_renames(later, found).columns) == {"id", "branch", "amount", "text", "other"}
    assert nested_drift.find_renames(target, target) == []


@pytest.mark.parametrize("share", [0.2, 0.6, 1.0])
def test_sketched_overlap_is_near_the_true_one(spark, share):
    a = spark.range(20000).select(F.col("id").alias("v"))
    b = spark.range(int(20000 * (1 - share)), int(20000 * (2 - share))).select(F.col("id").alias("v"))
    sketches = [[r.hash for r in nested_drift.bottom_hashes(df, ["v"]).collect()] for df in (a, b)]
    assert abs(nested_drift.overlap(*sketches) - share / (2 - share)) < 0.1

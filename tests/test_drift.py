import datetime as dt

import pytest

from tidemark.operators import drift
from tidemark.schemas import METADATA_SCHEMAS


@pytest.fixture
def target(spark):
    return spark.createDataFrame([], "k int, v string").schema


def test_findings(spark, target):
    df = spark.createDataFrame([("1", 2)], "K string, extra int")
    got = [(f.event, f.column, f.data_type) for f in drift.find_drift(df.schema, target)]
    assert got == [
        ("MISSING", "v", "string"), ("NEW", "extra", "int"), ("TYPE_CHANGED", "K", "string")
    ]


def test_strict_refuses_any_difference(spark, target):
    same = spark.createDataFrame([(1, "a")], "k int, v string")
    assert drift.apply_policy(same, target).accepted.count() == 1
    with pytest.raises(drift.SchemaDrift, match="NEW extra int"):
        drift.apply_policy(spark.createDataFrame([(1, "a", 2)], "k int, v string, extra int"), target)


def test_evolve_widens_but_keeps_types(spark, target, rows):
    wide = spark.createDataFrame([(1, 2)], "k int, extra int")
    outcome = drift.apply_policy(wide, target, drift.EVOLVE)
    assert outcome.accepted.columns == ["k", "v", "extra"]
    assert rows(outcome.accepted) == [(1, None, 2)]
    with pytest.raises(drift.SchemaDrift, match="TYPE_CHANGED"):
        drift.apply_policy(spark.createDataFrame([("1", "a")], "k string, v string"), target, drift.EVOLVE)


def test_quarantine_keeps_every_row(spark, target, rows):
    outcome = drift.apply_policy(
        spark.createDataFrame([("1", "a"), ("x", None)], "k string, v string"), target, drift.QUARANTINE
    )
    assert outcome.accepted is None
    assert rows(outcome.quarantined, "payload") == [('{"k":"1","v":"a"}',), ('{"k":"x","v":null}',)]


def test_log_rows(spark, target):
    findings = drift.find_drift(spark.createDataFrame([(1, 2)], "k int, e int").schema, target)
    log = drift.drift_log_rows(spark, findings, "r1", 3, drift.EVOLVE, "2024-01-01")
    assert log.columns == METADATA_SCHEMAS["schema_drift_log"].fieldNames()
    got = {(r.column_name, r.event_type, r.action_taken) for r in log.collect()}
    assert got == {("e", "NEW", "AUTO_EVOLVED"), ("v", "MISSING", "AUTO_EVOLVED")}
    assert log.first().detected_at == dt.datetime(2024, 1, 1)
    again = drift.drift_log_rows(spark, findings, "r1", 3, drift.EVOLVE, "2024-01-01")
    assert again.join(log, "drift_log_id", "left_anti").count() == 0

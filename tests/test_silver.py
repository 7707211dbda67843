import hashlib
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, silver
from tidemark.schemas import ColumnRule
from tidemark.sinks.tables import write_with_rejects

RULES = [
    ColumnRule("k", "Key", "INT", nullable=False, purpose="NATURAL_KEY"),
    ColumnRule("name", "Name", "STRING", nullable=False, pii=True),
    ColumnRule("born", "Born", "DATE", pii=True),
    ColumnRule("money", "Money", "DECIMAL(15,2)"),
    ColumnRule("acc", "BranchCode", "STRING", purpose="DERIVED"),
    ColumnRule("acc", "ProductCode", "STRING", purpose="DERIVED"),
    ColumnRule("acc", "AccountSeq", "STRING", purpose="DERIVED"),
    ColumnRule("extra", "extra", "STRING", active=False),
]
SCHEMA = "k string, name string, born date, money double, acc string, extra string, LastUpdatedAt int"


@pytest.fixture
def raw(spark):
    born = dt.date(1990, 5, 6)
    return spark.createDataFrame(
        [
            ("1", "ann", born, 1.005, "0001LN00012", "x", 1),
            ("two", "bob", None, 2.0, "0002LN0002", "x", 1),
            ("3", None, born, 1e20, "0003LN0003", "x", 1),
            (None, "eve", born, None, None, "x", 1),
        ],
        SCHEMA,
    )


def test_rules_applied(raw):
    row = silver.accepted(raw, RULES, salt="s").first()
    assert row.asDict() == {
        "Key": 1,
        "Name": hashlib.sha256(b"sann").hexdigest(),
        "Born": dt.date(1990, 1, 1),
        "Money": Decimal("1.01"),
        "BranchCode": "0001",
        "ProductCode": "LN",
        "AccountSeq": "00012",
    }
    assert silver.accepted(raw, RULES).count() == 1


def test_reject_reasons(raw):
    refused = silver.rejected(silver.checked(raw, RULES))
    got = sorted(tuple(sorted(r.reject_reasons)) for r in refused.collect())
    assert got == [
        ("cast:Key",), ("cast:Money", "null:Name"), ("null:Key",)
    ]


def test_accepted_and_rejected_in_one_write(raw, tmp_path):
    good, bad = write_with_rejects(silver.checked(raw, RULES), str(tmp_path / "t"))
    assert (good.count(), bad.count()) == (1, 3)
    assert "reject_reasons" in bad.columns and "reject_reasons" not in good.columns


def test_transform_hook(raw):
    silver.register_transform("upper_name", lambda df: df.withColumn("name", F.upper("name")))
    hook = silver.transform_for("upper_name")
    df = silver.silver(raw, RULES, ["Key"], newest_first=("Money",), salt="s", transform=hook)
    assert df.first().Name == hashlib.sha256(b"sANN").hexdigest()
    assert silver.transform_for(None) is None
    with pytest.raises(KeyError):
        silver.transform_for("missing")


def test_latest_wins_and_ties_are_stable(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d")], "k int, u int, v string"
    )
    want = [(1, 2, "c"), (2, None, "d")]
    for n in (1, 3):
        assert rows(dedup.latest_per_key(df.repartition(n), ["k"], ["u"])) == want


def test_as_of_batch(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 3, "c")], "k int, batch int, v string")
    assert rows(dedup.as_of_batch(df, ["k"], 1)) == [(1, 1, "a")]
    assert rows(dedup.as_of_batch(df, ["k"], 2)) == [(1, 2, "b")]
    assert len(rows(dedup.as_of_batch(df, ["k"], 3))) == 2

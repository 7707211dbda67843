"""The configured load end to end: outcomes, drift policies, reruns."""

import pytest
from pyspark.sql import functions as F

from tidemark.loading import build_silver, load_plan_rows
from tidemark.operators import silver
from tidemark.schemas import natural_key
from tidemark.sinks import tables
from tidemark.sinks.daily_feed import client_range, land_day
from tidemark.sinks.run_log import RunLog
from tidemark.sources import config, landing

DAY = "2024-02-01"


@pytest.fixture
def env(spark, tmp_path):
    class Env:
        root, target = str(tmp_path / "landing"), str(tmp_path / "bronze")
        log = RunLog(spark, str(tmp_path / "log"))
        registry = config.table_config(spark, root)
        layers = config.process_config(registry)

        def run(self, run_dt=DAY, registry=None):
            return load_plan_rows(
                spark, self.log, self.registry if registry is None else registry, self.layers,
                run_dt, self.target,
            )

        def bronze(self, name):
            return spark.read.parquet(f"{self.target}/{name}")

    return Env()


def test_feed_is_landed_loaded_and_reloaded(spark, env):
    ids = client_range(spark, 1, 300)
    counts = land_day(ids, env.root, DAY, "2024-03-01")
    assert counts["t_Client"] == 300 and counts["t_AccountCustomer"] == 450
    assert counts["t_AccountTrx"] == 600 <= counts["t_Loan"]
    again = land_day(ids, env.root, DAY, "2024-03-01")
    assert landing.next_batch(spark, env.root, DAY) == 3
    assert env.run() == "SUCCESS"
    loads = {r.table_name: r for r in env.log.loads().collect()}
    assert loads["t_Loan"].rows_read == loads["t_Loan"].rows_written == (
        counts["t_Loan"] + again["t_Loan"]
    )
    first = env.bronze("t_client").drop("_ingestion_run_id", "_ingested_at")
    stamped = first.count()
    assert env.run() == "SUCCESS"
    assert env.bronze("t_client").count() == stamped == 600
    assert env.bronze("t_client").select("_ingestion_run_id").distinct().count() == 1
    loan, acc = env.bronze("t_loan"), env.bronze("t_accountcustomer")
    assert loan.join(acc, ["OurBranchID", "AccountID"], "left_anti").count() == 0


def test_silver_from_bronze(spark, env, tmp_path):
    land_day(client_range(spark, 1, 200), env.root, DAY, "2024-03-01")
    columns = config.column_config(env.registry, config.rule_rows(spark))
    wanted = env.registry.where("source_table_name in ('t_Client', 't_Loan')")
    assert env.run(registry=wanted) == "SUCCESS"
    run_id = env.log.start_etl_run("silver", "SILVER", DAY)
    layer = {"load_type": "INCREMENTAL", "transform_module": None}
    out = str(tmp_path / "silver")
    for name in ("t_Client", "t_Loan"):
        table = config.get_table_config(env.registry, name)
        rules = silver.column_rules(config.get_input_column_config(env.registry, columns, name))
        assert build_silver(
            spark, env.log, run_id, table, layer, rules, natural_key(name), DAY, env.target, out, salt="s"
        ) == "SUCCESS"
    loans = spark.read.parquet(f"{out}/t_loan")
    assert loans.count() == loans.select("LoanID").distinct().count() == 399
    assert dict(loans.dtypes)["SanctionAmount"] == "decimal(15,2)"
    clients = spark.read.parquet(f"{out}/t_client")
    assert clients.count() == 200 and clients.where("length(ClientName) = 64").count() == 200
    assert env.log.end_etl_run(run_id) == "SUCCESS"


def test_csv_source(spark, env):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    df.write.option("header", True).csv(f"{env.root}/t_Client/dt={DAY}/batch=1")
    registry = env.registry.where("table_id = 1").withColumn("source_format", F.lit("CSV"))
    assert env.run(registry=registry) == "SUCCESS"
    stored = env.bronze("t_client")
    assert stored.columns[:2] == ["k", "v"] and stored.where("k = '2' and v is null").count() == 1


def test_empty_source_is_skipped(env):
    assert env.run() == "SUCCESS"
    assert {r.status for r in env.log.loads().collect()} == {"SKIPPED"}


@pytest.mark.parametrize(
    "policy, status, run_status",
    [("STRICT", "FAILED", "FAILED"), ("EVOLVE", "SUCCESS", "SUCCESS"),
     ("QUARANTINE", "QUARANTINED", "SUCCESS")],
)
def test_drift_policies(spark, env, policy, status, run_status):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    registry = env.registry.where("table_id = 1").withColumn("drift_policy", F.lit(policy))
    tables.write_batch(df, env.root, "t_Client", DAY, 1)
    assert env.run(registry=registry) == "SUCCESS"
    wider = df.withColumn("w", F.lit(1))
    tables.write_batch(wider, env.root, "t_Client", "2024-02-02", 1)
    assert env.run("2024-02-02", registry) == run_status
    last = env.log.loads().where("run_dt = '2024-02-02'").first()
    assert last.status == status
    drift_log = spark.read.parquet(f"{env.log.root}/schema_drift_log").collect()
    assert [(r.column_name, r.event_type) for r in drift_log] == [("w", "NEW")]
    stored = spark.read.option("mergeSchema", "true").parquet(f"{env.target}/t_client")
    if policy == "EVOLVE":
        assert stored.where("w = 1").count() == 2 and stored.count() == 4
    else:
        assert stored.count() == 2 and "w" not in stored.columns
    if policy == "EVOLVE":  # the new column is known from now on; a lack of it is drift
        tables.write_batch(df, env.root, "t_Client", "2024-02-03", 1)
        assert env.run("2024-02-03", registry) == "SUCCESS"
        events = spark.read.parquet(f"{env.log.root}/schema_drift_log")
        assert sorted((r.column_name, r.event_type) for r in events.collect()) == [
            ("w", "MISSING"), ("w", "NEW")
        ]
        assert spark.read.parquet(f"{env.target}/t_client/dt=2024-02-03").columns.count("w") == 1
    if policy == "QUARANTINE":
        assert spark.read.parquet(f"{env.target}/t_client_quarantine").count() == 2


def test_quarantine_is_repeatable_and_whole(spark, env):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    registry = env.registry.where("table_id = 1").withColumn("drift_policy", F.lit("QUARANTINE"))
    tables.write_batch(df.select("k"), env.root, "t_Client", DAY, 1)
    env.run(registry=registry)
    tables.write_batch(df, env.root, "t_Client", "2024-02-02", 1)
    for _ in range(2):
        env.run("2024-02-02", registry)
    parked = landing.read_partitioned(spark, f"{env.target}/t_client_quarantine")
    assert parked.count() == 2
    assert parked.where("""payload LIKE '%"v":null%'""").count() == 1


def test_typed_csv_and_a_value_that_does_not_fit(spark, env):
    spark.createDataFrame([("CL1", "2020-01-01"), ("CL2", None)], "ClientID string, DOB string").write.option(
        "header", True
    ).csv(f"{env.root}/t_Client/dt={DAY}/batch=1")
    registry = env.registry.where("table_id = 1").withColumn("source_format", F.lit("CSV"))
    columns = config.column_config(env.registry, config.rule_rows(spark))
    args = (spark, env.log, registry, env.layers)
    assert load_plan_rows(*args, DAY, env.target, columns=columns) == "SUCCESS"
    assert dict(env.bronze("t_client").dtypes)["DOB"] == "date"
    spark.createDataFrame([("CL3", "x" * 3000)], "ClientID string, DOB string").write.option(
        "header", True
    ).csv(f"{env.root}/t_Client/dt=2024-02-02/batch=1")
    assert load_plan_rows(*args, "2024-02-02", env.target, columns=columns) == "FAILED"
    failed = env.log.loads("2024-02-02").first()
    assert "x" * 3000 in failed.error_message  # the whole error is kept
    assert env.bronze("t_client").count() == 2


def test_silver_needs_a_salt_and_its_upstreams(spark, env, tmp_path):
    columns = config.column_config(env.registry, config.rule_rows(spark))
    layers = config.process_config(env.registry, ["t_Client"], "SILVER")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.write_batch(df, env.root, "t_Client", DAY, 1)
    one = env.registry.where("table_id = 1")
    assert env.run(registry=one) == "SUCCESS"
    out = str(tmp_path / "silver")
    kwargs = {"columns": columns, "bronze_root": env.target}
    assert load_plan_rows(spark, env.log, one, layers, DAY, out, "SILVER", **kwargs) == "FAILED"
    errors = [r.error_message for r in env.log.loads().collect() if r.process_type == "SILVER"]
    assert any("needs a salt" in e for e in errors)
    blocked = layers.withColumn("depends_on_table_ids", F.lit("1, 3"))
    load_plan_rows(spark, env.log, one, blocked, DAY, out, "SILVER", salt="s", **kwargs)
    skipped = [r for r in env.log.loads().collect() if r.status == "SKIPPED"]
    assert len(skipped) == 1 and "1 of 2 upstream" in skipped[0].error_message
    with pytest.raises(ValueError, match="column configuration"):
        load_plan_rows(spark, env.log, one, layers, DAY, out, "SILVER")


def test_a_column_is_new_once(spark, env):
    """Older dates that are filled in later and carry a known column are no drift."""
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    registry = env.registry.where("table_id = 1")
    for run_dt, frame in (
        ("2024-02-05", df), ("2024-02-03", df.withColumn("w", F.lit(1))), ("2024-02-04", df.withColumn("w", F.lit(2)))
    ):
        tables.write_batch(frame, env.root, "t_Client", run_dt, 1)
        assert env.run(run_dt, registry) == "SUCCESS"
    events = spark.read.parquet(f"{env.log.root}/schema_drift_log").collect()
    assert [(r.column_name, r.event_type) for r in events] == [("w", "NEW")]
    versions = sorted((r.delta_version_before, r.delta_version_after) for r in env.log.loads().collect())
    assert versions == [(0, 1), (1, 2), (2, 3)]

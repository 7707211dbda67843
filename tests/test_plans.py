"""The shape of the plans: what is shuffled, pruned and pushed down."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.plans import QUERIES, inputs
from tidemark.operators import lending, quality, reports

NARROW = [
    "hash_txn_id", "hash_sample", "pick_by_modulus", "client_rows", "account_fanout",
    "loan_fanout", "loan_terms", "amortisation_schedule", "due_on_date", "disbursements",
    "repayments", "ledger_union", "updated_rows", "deleted_rows", "silver_rejects",
    "pii_masked", "partition_pruned_read", "malformed_keys", "future_dated",
]


@pytest.mark.parametrize("name", NARROW)
def test_narrow_queries_do_not_shuffle(name, spark, sf_dir, plan):
    text = plan(QUERIES[name](spark, sf_dir))
    # a fan-out may spread the few rows of a one-split file over the cores first
    spread = text.count("Exchange RoundRobinPartitioning")
    assert text.count("Exchange") == spread <= 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_forms_all_pairs_or_calls_python(name, spark, sf_dir, plan):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas",
                 "FlatMapGroups"):
        assert node not in text
    assert "SinglePartition" not in text or name in GLOBAL_AGGREGATES


# Their single partition holds one partial row per map task, one per batch, or a top three.
GLOBAL_AGGREGATES = {
    "table_row_counts", "null_rate", "allowed_values", "pk_violations", "relation_checks",
    "config_cross_values", "drift_events", "drift_history", "given_null_rates",
    "business_relations", "snapshot_history",
}


def test_report_reads_only_the_date(spark, sf_dir, plan):
    df = reports.rows_per_date(inputs.table(spark, sf_dir, "lineitem"), "l", inputs.day("l_shipdate"))
    assert re.search(r"ReadSchema: struct<l_shipdate:timestamp_ntz>", plan(df))


def test_null_filter_is_pushed_down(spark, sf_dir, plan):
    df = quality.not_allowed(inputs.table(spark, sf_dir, "orders"), "o_orderstatus", ["F"])
    assert "PushedFilters: [IsNotNull(o_orderstatus)" in plan(df)


def test_terms_are_computed_before_the_explode(spark, sf_dir, plan):
    text = plan(lending.schedule(inputs.order_loans(spark, sf_dir)))
    assert text.index("Generate") < text.index("round(")


def test_running_balance_counts_before_it_shuffles(spark, sf_dir, plan):
    text = plan(QUERIES["running_outstanding"](spark, sf_dir))
    assert text.count("HashAggregate") == 2


def test_window_is_applied_before_loads_are_counted(spark, sf_dir, plan):
    text = plan(QUERIES["load_outcomes"](spark, sf_dir))
    counted = text[text.index("partial_count"):]
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(ts,2024-01-10", counted)


def test_a_fan_out_gets_tasks_by_the_rows_it_makes(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(inputs, "ROWS_PER_TASK", 5_000)
    schedule = QUERIES["full_tenure_schedule"](spark, sf_dir)
    per_task = schedule.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 10_000 < schedule.count()
    # few rows are still spread over the cores
    assert inputs.spread(spark.range(8, numPartitions=1), 1).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert inputs.spread(spark.range(9, numPartitions=9), 1).rdd.getNumPartitions() == 9

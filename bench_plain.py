"""The plain way to write some of the benchmarked results, timed like bench.py.

Each pair gives the same rows; the difference is how Spark gets there.  The
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import lending  # noqa: E402
from tidemark.plans import QUERIES, inputs  # noqa: E402
from tidemark.plans.lending import AS_OF  # noqa: E402
from tidemark.session import local_session  # noqa: E402


def _raw_schedule(spark, sf_dir):
    """Explode first, then round on every installment."""
    loans = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("loan"), "o_totalprice", inputs.day("o_orderdate").alias("d0")
    )
    return (
        loans.withColumn("n", F.least(F.lit(36), F.col("loan") % 360 + 12).cast("int"))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n"))))
        .withColumn("due_date", F.add_months("d0", F.col("k")))
        .withColumn("principal", F.round(F.col("o_totalprice") / F.col("n"), 2))
        .withColumn(
            "interest",
            F.round(F.col("o_totalprice") * (8 + (F.col("loan") % 120) / 10) / 100 / 12, 2),
        )
    )


def amortisation_schedule(spark, sf_dir):
    return _raw_schedule(spark, sf_dir).select("loan", "k", "due_date", "principal", "interest")


def due_on_date(spark, sf_dir):
    due = _raw_schedule(spark, sf_dir).where(F.col("due_date") == F.lit(AS_OF).cast("date"))
    return due.select("loan", "k", "principal", "interest")


def dpd_as_of(spark, sf_dir):
    so_far = Window.partitionBy("loan").orderBy("k")
    paid = (
        inputs.line_payments(spark, sf_dir)
        .where(F.col("value_date") <= F.lit(AS_OF).cast("date"))
        .groupBy("loan")
        .agg(F.sum("paid_cents").alias("paid"))
    )
    open_part = _raw_schedule(spark, sf_dir).withColumn(
        "through", F.sum(F.round((F.col("principal") + F.col("interest")) * 100)).over(so_far)
    )
    unpaid = open_part.join(paid, "loan", "left").where(
        F.col("through") > F.coalesce("paid", F.lit(0))
    )
    return unpaid.groupBy("loan").agg(F.min("due_date"), F.sum("principal"), F.sum("interest"))


def running_outstanding(spark, sf_dir):
    so_far = Window.partitionBy("loan").orderBy("value_date")
    payments = inputs.line_payments(spark, sf_dir)
    running = payments.withColumn("paid_so_far", F.sum("paid_cents").over(so_far))
    opening = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("loan"), "o_totalprice"
    )
    return running.join(opening, "loan").dropDuplicates(["loan", "value_date"])


def latest_log_state(spark, sf_dir):
    newest = Window.partitionBy("log_id").orderBy(F.desc("seq"), F.desc("at"))
    events = inputs.run_events(spark, sf_dir)
    return events.withColumn("r", F.row_number().over(newest)).where("r = 1")


def orphans_four_key(spark, sf_dir):
    loans = lending.loans(lending.accounts(inputs.client_ids(spark, sf_dir)))
    known = loans.where(F.col("id") % 100 != 0)
    keys = ["OurBranchID", "AccountID", "LoanSeries", "LoanID"]
    return lending.installments(loans).join(known, keys, "left_anti")


def pick_by_modulus(spark, sf_dir):
    """A CASE branch per user."""
    number = F.col("o_orderkey")
    chain = F.when(number % 100 == 0, "USER0001")
    for i in range(1, 100):
        chain = chain.when(number % 100 == i, f"USER{i + 1:04d}")
    return inputs.table(spark, sf_dir, "orders").select("o_orderkey", chain.alias("user_code"))


def silver_dedup_latest(spark, sf_dir):
    lines = inputs.table(spark, sf_dir, "lineitem")
    newest = F.max_by(F.struct(*lines.columns), F.struct("l_shipdate", *lines.columns))
    return lines.groupBy("l_orderkey", "l_linenumber").agg(newest.alias("row")).select("row.*")


PLAIN = [
    amortisation_schedule, due_on_date, dpd_as_of, running_outstanding, latest_log_state,
    orphans_four_key, pick_by_modulus, silver_dedup_latest,
]


def _median(run, runs: int = 3) -> float:
    seconds = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds[1:])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "tidemark-plain", shuffle_partitions=int(cpus))
    print("| query | plain | here |\n| --- | --- | --- |")
    for plain in PLAIN:
        name = plain.__name__
        slow = _median(lambda: plain(spark, sf_dir))  # noqa: B023 - run at once
        fast = _median(lambda: QUERIES[name](spark, sf_dir))  # noqa: B023
        print(f"| {name} | {slow:.2f} | {fast:.2f} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

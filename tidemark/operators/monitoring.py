"""Monitoring from what is kept per day: sketches that merge, outages, streaks, unusual volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KLL_K = 400  # rank error of about 0.9 %
HLL_BITS = 12  # relative error of about 1.6 %
TRAILING_DAYS = 28
MAD_TO_SIGMA = 1.4826  # of a normal distribution


def daily_sketches(df: DataFrame, by: Sequence[str], day: str, amount: Column, key: Column) -> DataFrame:
    """``by, day, n, amounts, keys``: a KLL sketch of amounts and an HLL sketch of keys per day.

    Written once per day they stand in for the day's rows: any window of days is merged from
    them.  Sketches are built map-side, so a hot group travels as one sketch per task.
    """
    return df.groupBy(*by, day).agg(
        F.count(F.lit(1)).alias("n"),
        F.kll_sketch_agg_bigint(amount.cast("bigint"), F.lit(KLL_K)).alias("amounts"),
        F.hll_sketch_agg(key, F.lit(HLL_BITS)).alias("keys"),
    )


def merged_sketches(daily: DataFrame, *by: Column | str) -> DataFrame:
    """``by, n, amounts, keys`` over the days that fall together."""
    return daily.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.kll_merge_agg_bigint("amounts", F.lit(KLL_K)).alias("amounts"),
        F.hll_union_agg("keys").alias("keys"),
    )


def quantile(rank: float, sketch: str = "amounts") -> Column:
    """The amount at a rank; null where nothing but nulls was seen."""
    seen = F.kll_sketch_get_n_bigint(sketch) > 0
    return F.when(seen, F.kll_sketch_get_quantile_bigint(sketch, F.lit(rank)))


def distinct_keys(sketch: str = "keys") -> Column:
    return F.hll_sketch_estimate(sketch)


def _by_day(log: DataFrame, start: str, end: str) -> DataFrame:
    """One row per table and date of the window: whether any load of it succeeded."""
    days = F.col("run_dt").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    ok = F.max(F.when(F.col("status") == "SUCCESS", 1).otherwise(0)).alias("ok")
    return log.where(days).groupBy("table_id", "run_dt").agg(ok)


def outages(log: DataFrame, feeds: DataFrame, start: str, end: str) -> DataFrame:
    """``table_id, first_day, last_day, days, failed_days, is_open``: dates in a row without a success.

    A date without any load is part of an outage as much as a failed one, which ``failed_days``
    counts.  Outages are the gaps between successes, so no grid of tables and dates is made; a table
    of ``feeds`` without a success is one outage over the whole window.  An open outage reaches
    its last day.  A window holds one row per date.
    """
    ordered = Window.partitionBy("table_id").orderBy("run_dt")
    edge = feeds.select("table_id").distinct().select(
        "table_id", F.date_sub(F.lit(start).cast("date"), 1).alias("run_dt"), F.lit(1).alias("ok")
    )
    days = _by_day(log, start, end).unionByName(edge)
    grouped = days.withColumn("gap", F.sum("ok").over(ordered)).groupBy("table_id", "gap").agg(
        F.max(F.when(F.col("ok") == 1, F.col("run_dt"))).alias("before"), F.count_if(F.col("ok") == 0).alias("failed_days")
    )
    after_end = F.date_add(F.lit(end).cast("date"), 1)
    until = F.coalesce(F.lead("before").over(Window.partitionBy("table_id").orderBy("gap")), after_end)
    found = grouped.where(F.col("before").isNotNull()).withColumn("until", until)
    length = F.datediff("until", "before") - 1
    return found.where(length > 0).select(
        "table_id",
        F.date_add("before", 1).alias("first_day"),
        F.date_sub("until", 1).alias("last_day"),
        length.alias("days"),
        "failed_days",
        (F.col("until") == after_end).alias("is_open"),
    )


def streaks(log: DataFrame, start: str, end: str) -> DataFrame:
    """``table_id, first_day, last_day, days, is_open``: dates in a row that succeeded."""
    ordered = Window.partitionBy("table_id").orderBy("run_dt")
    done = _by_day(log, start, end).where("ok = 1")
    island = done.withColumn("island", F.date_sub("run_dt", F.row_number().over(ordered)))
    return island.groupBy("table_id", "island").agg(
        F.min("run_dt").alias("first_day"), F.max("run_dt").alias("last_day"), F.count(F.lit(1)).cast("int").alias("days")
    ).select("table_id", "first_day", "last_day", "days", (F.col("last_day") == F.lit(end).cast("date")).alias("is_open"))


def _middle(values: Column) -> Column:
    """The median of an array of numbers; null if it is empty."""
    ordered, n = F.array_sort(values), F.size(values)
    low, high = ((n + 1) / 2).cast("int"), (n / 2).cast("int") + 1
    pair = F.element_at(ordered, low) + F.element_at(ordered, high)
    return F.when(n > 0, pair / 2.0)


def volume_anomalies(
    counts: DataFrame, days: int = TRAILING_DAYS, limit: float = 3.0, least_days: int = 7
) -> DataFrame:
    """Every day of each table with the median of the days before it and how far off it is.

    ``counts``: ``table_name, dt, records``, one row per day that had any.  A missing day
    between a table's first and last counts as a day of no records, and is judged as one.
    The frame is ``days`` of the calendar, not of rows.  ``deviations`` is the distance from the
    median in robust standard deviations (from the median absolute deviation; null where that is 0), and a
    day is an anomaly beyond ``limit`` of them, or at any distance if all days before were alike.
    Fewer than ``least_days`` days before it decide nothing.
    """
    span = counts.groupBy("table_name").agg(F.min("dt").alias("first"), F.max("dt").alias("last"))
    calendar = span.select("table_name", F.explode(F.sequence("first", "last")).alias("dt"))
    filled = calendar.join(counts, ["table_name", "dt"], "left").withColumn("records", F.coalesce("records", F.lit(0)))
    number = F.datediff("dt", F.lit("1970-01-01"))
    before = Window.partitionBy("table_name").orderBy(number).rangeBetween(-days, -1)
    seen = filled.withColumn("seen", F.collect_list("records").over(before)).withColumn("median", _middle(F.col("seen")))
    spread = _middle(F.transform("seen", lambda v: F.abs(v - F.col("median"))))
    judged = seen.withColumn("mad", spread)
    off = F.abs(F.col("records") - F.col("median"))
    deviations = F.when(F.col("mad") > 0, off / (F.col("mad") * MAD_TO_SIGMA))
    known = F.size("seen") >= least_days
    odd = F.when(F.col("mad") > 0, deviations > limit).otherwise(off > 0)
    return judged.select(
        "table_name", "dt", "records", "median", "mad", deviations.alias("deviations"),
        F.coalesce(known & odd, F.lit(False)).alias("is_anomaly"),
    )

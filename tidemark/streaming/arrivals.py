"""Incremental arrival: load what landed since the last run, then stop.

The stream's checkpoint remembers which files were seen, so it takes the place
of a watermark derived from the run log.  Use one or the other for a table.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.tables import load_bronze
from tidemark.sources.landing import stamp_lineage, table_path


def load_arrivals(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    run_id: str,
    max_files: int | None = None,
) -> list[str]:
    """Brings Bronze up to date with the landing folder; returns the dates loaded.

    ``schema`` includes ``dt`` and ``batch``, by which Bronze is partitioned.  A
    micro-batch only tells which deliveries changed.  Those are read again in full and
    replaced, so a repeated micro-batch writes the same rows, and the work of a date
    grows with its deliveries and not with their square.
    """
    source = table_path(root, table)
    loaded: set[str] = set()

    def refresh(arrived: DataFrame, _: int) -> None:
        pairs = [(r["dt"], r["batch"]) for r in arrived.select("dt", "batch").distinct().collect()]
        if not pairs:
            return
        delivered = reduce(or_, [(F.col("dt") == d) & (F.col("batch") == b) for d, b in pairs])
        current = spark.read.schema(schema).parquet(source).where(delivered)
        load_bronze(stamp_lineage(current, run_id), target, ["dt", "batch"])
        loaded.update(d.isoformat() for d, _ in pairs)

    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sorted(loaded)

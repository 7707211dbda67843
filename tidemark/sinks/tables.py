"""Partitioned Parquet writes that can be repeated.

Every write goes through Spark's commit protocol: tasks write to a staging
folder, a lost executor's tasks run again, and files appear at job commit.

Plain Parquet has no transactions.  A reader that lists a table while a job
commits can see some partitions replaced and others not yet.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedup import upsert
from tidemark.operators.quality import assert_all
from tidemark.operators.silver import REASONS
from tidemark.operators.drift import conform
from tidemark.operators.joins import broadcast_if_small, matching
from tidemark.session import remove_folder, work_path
from tidemark.sources.landing import (
    PATH_TEMPLATE,
    SCHEMA_NOTE,
    read_partitioned,
    resolve_path,
    table_path,
    table_schema,
)

TARGET_FILE_MB = 128
_OPEN_FILES = 16


def files_for(total_bytes: int, target_mb: int = TARGET_FILE_MB) -> int:
    """How many files of the target size hold that many bytes."""
    return max(1, math.ceil(total_bytes / (target_mb * 1024 * 1024)))


def sized(df: DataFrame, *by: str, total_bytes: int | None = None) -> DataFrame:
    """The frame laid out for writing files of about the target size.

    With known bytes: that many even partitions.  Otherwise the REBALANCE hint:
    AQE groups rows by the partition columns, merges small groups and splits a
    group that holds, say, a third of all rows over many tasks, aiming at
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    if total_bytes is not None:
        return df.repartition(files_for(total_bytes))
    return df.hint("rebalance", *by)


def write_batch(
    df: DataFrame,
    root: str,
    table: str,
    run_dt: str,
    batch: int,
    files: int | None = None,
    keep_layout: bool = False,
) -> int:
    """Writes one delivery to its own folder, replacing it; returns the rows there.

    Laid out as that many files, or at the target size; ``keep_layout`` writes the
    partitions as they are, for frames that were laid out before they fanned out.
    The rows are counted from the written footers, which also proves that the
    folder is readable.
    """
    folder = resolve_path(PATH_TEMPLATE, table, run_dt, batch, root.rstrip("/"))
    laid_out = df
    if not keep_layout:
        laid_out = df.repartition(files) if files else df.hint("rebalance")
    laid_out.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder).count()


def land(df: DataFrame, root: str, table: str) -> str:
    """Writes all ``dt`` / ``batch`` folders present in the frame, replacing those only."""
    path = table_path(root, table)
    _overwrite_partitions(sized(df, "dt", "batch"), path, ["dt", "batch"])
    return path


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """Tasks write to several partitions at once instead of sorting all their rows by partition.

    A rebalanced task holds few partitions but any number of rows, and those are wide in
    memory: the columns of the lineage repeat, so they take next to nothing of the size that
    tasks are cut by.  A task that meets more partitions than this sorts what is left.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, "0")
    spark.conf.set(name, str(max(int(before), _OPEN_FILES)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    if not by:
        raise ValueError("a dynamic overwrite without partition columns would replace the table")
    with _open_files(df.sparkSession):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(path)
        )


def widened(known: T.StructType | None, more: T.StructType) -> T.StructType:
    """The known columns and then new ones; a column of another type is an error."""
    if known is None:
        return more
    kinds = {f.name.lower(): f.dataType for f in known.fields}
    for f in more.fields:
        if kinds.get(f.name.lower(), f.dataType) != f.dataType:
            raise ValueError(f"{f.name}: {f.dataType.simpleString()} is not what the table has")
    return T.StructType([*known.fields, *[f for f in more.fields if f.name.lower() not in kinds]])


def note_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keeps the table's columns next to its data, for every later read."""
    row = spark.createDataFrame([(schema.json(),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(f"{path}/{SCHEMA_NOTE}")


def _grow_schema(df: DataFrame, path: str) -> tuple[T.StructType, bool]:
    """The table's columns with those of ``df``, and whether they are more than before."""
    known = table_schema(df.sparkSession, path)
    schema = widened(known, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]))
    return schema, known is None or len(schema) > len(known)


def _note_if(grown: bool, spark: SparkSession, path: str, schema: T.StructType) -> None:
    """A table whose columns are as before has its note already."""
    if grown:
        note_schema(spark, path, schema)


def _drop_uncovered(
    spark: SparkSession, path: str, by: Sequence[str], where: Column, covered: DataFrame
) -> None:
    """Removes the partitions that ``where`` selects and ``covered`` does not name.

    A listing on the cluster; the driver sees the folders that are to go.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    if not set(by) <= set(files.columns):  # nothing was ever written
        return
    kinds = dict(covered.dtypes)
    there = files.select(
        *[F.col(c).cast(kinds[c]).alias(c) for c in by],
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"),
    )
    same = [F.col(f"there.{c}").eqNullSafe(F.col(f"covered.{c}")) for c in by]
    stale = there.where(where).alias("there").join(covered.distinct().alias("covered"), same, "left_anti")
    for row in stale.select("folder").distinct().collect():
        remove_folder(spark, row["folder"])


def replace_predicate(template: str, run_dt: str) -> str:
    """The configured predicate for a business date, which must be a date."""
    return template.format(run_dt=date.fromisoformat(run_dt).isoformat())


def load_bronze(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = ("dt",),
    replace_where: str | None = None,
) -> None:
    """Replaces what the load covers.  Running it twice changes nothing.

    Without ``replace_where`` that is the partitions of the frame.  With it, exactly the
    rows of the predicate: a row of the frame outside it fails the job before anything
    is committed, and rows of the table inside it go even if the frame has none for
    their partition.  A predicate over other columns than the partitions', or a table
    without any, is rewritten as a whole from the work folder.  A load that names
    neither is refused, as it would replace the table.
    """
    by = list(partition_cols)
    if not by and not replace_where:
        raise ValueError("an incremental load needs partition columns or replace_where")
    spark = df.sparkSession
    schema, grown = _grow_schema(df, path)
    if not replace_where:
        _overwrite_partitions(sized(df, *by), path, by)
        _note_if(grown, spark, path, schema)
        return
    where = F.expr(replace_where)
    df = assert_all(df, where, f"row outside replace_where: {replace_where}")
    if by and _names_only(spark, schema, by, replace_where):
        _overwrite_partitions(sized(df, *by), path, by)
        _note_if(grown, spark, path, schema)
        _drop_uncovered(spark, path, by, where, df.select(*by))
        return
    rows = conform(df, schema)
    if table_schema(spark, path) is not None:
        rest = read_partitioned(spark, path, schema=schema)
        rows = rest.where(~F.coalesce(where, F.lit(False))).unionByName(rows)
    staging = work_path(spark, "replaced")
    rows.write.parquet(staging)
    full_refresh(spark.read.schema(schema).parquet(staging), path, by)
    remove_folder(spark, staging)


def _names_only(spark: SparkSession, schema: T.StructType, by: Sequence[str], where: str) -> bool:
    """Whether a predicate names no column but these."""
    keys = T.StructType([f for f in schema.fields if f.name in by])
    try:
        spark.createDataFrame([], keys).where(where).schema  # noqa: B018 - resolves the names
    except AnalysisException as error:
        if (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return False
        raise
    return True


def full_refresh(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """Replaces the whole table."""
    writer = sized(df, *partition_cols).write.mode("overwrite")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    with _open_files(df.sparkSession):
        writer.parquet(path)
    note_schema(df.sparkSession, path, df.schema)


def append(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """Adds rows; columns that the table does not have yet are added to it."""
    schema, grown = _grow_schema(df, path)
    writer = df.write.mode("append")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    _note_if(grown, df.sparkSession, path, schema)


def touched_dates(df: DataFrame, column: str = "dt") -> list[date]:
    """The distinct business dates of a frame: as many values as it has days."""
    return [row[0] for row in df.select(column).distinct().orderBy(column).collect()]


def upsert_partitions(
    spark: SparkSession, changes: DataFrame, path: str, keys: Sequence[str], by: str = "dt"
) -> list[date]:
    """Puts ``changes`` into the table by key, rewriting only the dates they touch.

    Unless ``by`` is one of the keys, a changed key may have stood at another date: those
    old places are found by a scan of the keys alone and rewritten too, so that no key
    stays twice.  A date left without rows is dropped.  The changes are computed once, into
    the work folder, and so is the result, because a job must not overwrite what it reads.
    Columns that only one side has are kept and null in the other's rows; a changed type is
    an error.  Returns the dates that were rewritten.
    """
    incoming, staging = work_path(spark, "changes"), work_path(spark, "upsert")
    schema, grown = _grow_schema(changes, path)
    sized(changes, by).write.partitionBy(by).parquet(incoming)
    changes = spark.read.schema(changes.schema).parquet(incoming)
    days = touched_dates(changes, by)
    if days:
        merged = conform(changes, schema)
        if table_schema(spark, path) is not None:
            if by not in keys:
                days = sorted({*days, *_old_places(spark, changes, path, keys, by, schema)})
            existing = read_partitioned(spark, path, [d.isoformat() for d in days], schema=schema)
            merged = upsert(existing, merged, keys)
        written = _copy_through(merged, staging, path, by)
        _note_if(grown, spark, path, schema)
        emptied = sorted(set(days) - set(touched_dates(written, by)))
        if emptied:
            wanted = F.col(by).isin(*[F.lit(d).cast(schema[by].dataType) for d in emptied])
            _drop_uncovered(spark, path, [by], wanted, written.select(by))
        remove_folder(spark, staging)
    remove_folder(spark, incoming)
    return days


def _old_places(
    spark: SparkSession, changes: DataFrame, path: str, keys: Sequence[str], by: str, schema: T.StructType
) -> list[date]:
    """The dates at which the table holds keys of ``changes``; reads keys and dates only."""
    there = read_partitioned(spark, path, schema=schema).select(*keys, by)
    changed = broadcast_if_small(changes.select(*keys).distinct())
    return touched_dates(matching(there, changed, keys), by)


def _copy_through(df: DataFrame, staging: str, path: str, by: str) -> DataFrame:
    """Writes at the target file size to the work folder, then copies file by file.

    Returns the rows as they lie in the work folder, which the caller removes.
    """
    spark = df.sparkSession
    sized(df, by).write.partitionBy(by).parquet(staging)
    staged = spark.read.schema(df.schema).parquet(staging)
    _overwrite_partitions(staged, path, [by])
    return staged


def rewrite_partitions(
    spark: SparkSession,
    path: str,
    days: Sequence[str],
    edit: Callable[[DataFrame], DataFrame],
    by: str = "dt",
) -> None:
    """Copy-on-write for some dates of a table: UPDATE, DELETE and the like.

    All columns of the table are kept.  A date whose rows are all deleted is dropped.
    """
    edited = read_partitioned(spark, path, days).transform(edit)
    schema, grown = _grow_schema(edited, path)
    staging = work_path(spark, "rewrite")
    sized(edited, by).write.partitionBy(by).parquet(staging)
    staged = spark.read.schema(edited.schema).parquet(staging)
    _overwrite_partitions(staged, path, [by])
    _note_if(grown, spark, path, schema)
    wanted = F.col(by).isin(*[F.lit(d).cast(edited.schema[by].dataType) for d in days])
    _drop_uncovered(spark, path, [by], wanted, staged.select(by))
    remove_folder(spark, staging)


def compact(spark: SparkSession, path: str, days: Sequence[str], by: str = "dt") -> None:
    """Rewrites the files of some dates at the target size.  Rows and columns are unchanged."""
    rewrite_partitions(spark, path, days, lambda df: df, by)


def write_with_rejects(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Writes accepted and rejected rows in one pass and returns both.

    They land in two folders of one table, so the checks run once and nothing
    has to be cached.
    """
    spark = checked.sparkSession
    flagged = checked.withColumn("is_rejected", F.size(REASONS) > 0)
    flagged.write.mode("overwrite").partitionBy("is_rejected").parquet(path)
    stored = spark.read.schema(flagged.schema).parquet(path)
    good = stored.where(~F.col("is_rejected")).drop("is_rejected", REASONS)
    return good, stored.where("is_rejected").drop("is_rejected")

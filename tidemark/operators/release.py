"""The way back from quarantine: parked rows that fit the table by now are loaded once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import broadcast_if_small, matching
from tidemark.session import remove_folder, staged, work_path
from tidemark.sinks.tables import append, full_refresh, table_schema
from tidemark.sources.landing import read_partitioned

PARKED_ID = "_parked_id"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _path(name: str) -> str:
    return "$[" + "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def _value(field: T.StructField) -> Column:
    kind = field.dataType.simpleString()
    # a date or time was parked as text
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.try_variant_get("_variant", _path(field.name), "string").try_cast(kind)
    return F.try_variant_get("_variant", _path(field.name), kind)


def fitted(parked: DataFrame, target: T.StructType) -> DataFrame:
    """``parked`` with ``_row`` (a struct in the layout of ``target``) and ``_misfit``.

    ``payload`` is JSON.  A payload fits if it is an object whose fields are columns of the
    target and whose values can be cast without loss; columns it lacks are null.  ``_misfit``
    names what does not fit, null if nothing.
    """
    df = parked.withColumn("_variant", F.try_parse_json("payload"))
    names = F.coalesce(F.json_object_keys("payload"), F.array().cast("array<string>"))
    known = F.array(*[F.lit(f.name) for f in target.fields])
    problems = [
        F.when(F.col("_variant").isNull() | (F.schema_of_variant("_variant").startswith("OBJECT") == F.lit(False)), "no object"),
        F.when(F.size(F.array_except(names, known)) > 0, F.concat(F.lit("unknown "), F.array_join(F.array_sort(F.array_except(names, known)), " "))),
    ]
    for field in target.fields:
        there = F.try_variant_get("_variant", _path(field.name), "string").isNotNull()
        bad = there & _value(field).isNull()
        if isinstance(field.dataType, _WHOLE):
            exact = F.try_variant_get("_variant", _path(field.name), "double")
            bad = bad | (there & (exact != _value(field).cast("double")))
        problems.append(F.when(bad, F.lit(f"{field.name} is no {field.dataType.simpleString()}")))
        if not field.nullable:
            problems.append(F.when(~there, F.lit(f"{field.name} is missing")))
    misfit = F.concat_ws("; ", *problems)
    row = F.struct(*[_value(f).alias(f.name) for f in target.fields])
    return df.withColumns({"_row": row, "_misfit": F.when(misfit != "", misfit)}).drop("_variant")


def split(parked: DataFrame, target: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The rows that fit, in the layout of ``target`` with ``_parked_id``, and the parked rows that stay.

    Equal payloads are counted before they are exchanged and come out as often as they were
    parked, each under an id of its own.  Rows that stay have the new reason in ``drift_reason``.
    """
    counted = parked.groupBy("payload").agg(F.count(F.lit(1)).alias("_copies"))
    judged = fitted(counted, target)
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))
    free = judged.where("_misfit IS NULL").select("_row", F.sha2("payload", 256).alias("_id"), copy.alias("_copy"))
    loaded = free.select("_row.*", F.concat_ws("-", "_id", F.col("_copy").cast("string")).alias(PARKED_ID))
    reasons = fitted(parked, target).where("_misfit IS NOT NULL")
    return loaded, reasons.withColumn("drift_reason", F.col("_misfit")).drop("_row", "_misfit")


def release(
    spark: SparkSession, parked_path: str, path: str, partition_cols: tuple[str, ...] = (), by: str = "run_dt"
) -> int:
    """Loads what fits the table at ``path`` from its quarantine; returns how many rows.

    The target's noted columns say what fits.  Loaded rows keep ``_parked_id``, and an id that is in the
    target is never loaded again, so a run that broke off between the load and the removal
    from quarantine can simply be repeated.
    """
    target = table_schema(spark, path)
    if target is None or table_schema(spark, parked_path) is None:
        return 0
    layout = T.StructType([f for f in target.fields if f.name != PARKED_ID])
    parked = read_partitioned(spark, parked_path)
    loaded, left = split(parked, layout)
    loaded = staged(loaded, "released")
    if PARKED_ID in target.fieldNames():
        before = read_partitioned(spark, path).where(f"{PARKED_ID} IS NOT NULL").select(PARKED_ID)
        loaded = staged(matching(loaded, broadcast_if_small(before), [PARKED_ID], "left_anti"), "released")
    released = loaded.count()
    if released:
        append(loaded, path, partition_cols)
    # a job must not overwrite what it reads
    staging = work_path(spark, "still-parked")
    left.write.parquet(staging)
    full_refresh(spark.read.schema(left.schema).parquet(staging), parked_path, [by] if by in left.columns else [])
    remove_folder(spark, staging)
    return released

"""Sharding by a two-pass external shuffle.

First pass: every row is scattered by a seeded hash into one of many buckets that each
fit in memory; in Spark that pass is the exchange, whose files lie outside memory.
Second pass: each bucket is put into the order of a Fisher-Yates shuffle with seeded
draws and written.  Buckets follow one another, so the rows of all buckets form one
random sequence, which is cut into shards whose row counts differ by one at most.

Only DataFrame functions are used.  The draws are hashes, so that the same rows and seed
give the same shards on any layout and after any lost executor.

Defined results: a null or empty text is a row like any other (its digest has size 1 and
CRC 0); very long texts stay whole and only enlarge their bucket; equal texts are separate rows;
rows that are equal in every column are kept as often as they occur and are scattered
apart, being collapsed and counted before anything is exchanged; an empty table gives no
row; columns of any name are carried inside ``doc``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.inputs import partitions
from tidemark.operators.joins import broadcast_if_small
from tidemark.operators.prefix import running_totals
from tidemark.session import staged

SHARDS = 16
SEED = 20_240_301
BUCKET_ROWS = 2048
BUCKET_BYTES = 64 << 20
_CHUNK = 10_000  # copies of one row that one task makes at a time
_WIDTH = 4  # bytes of a place in a permutation


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType)


def _identity(docs: DataFrame) -> list[Column]:
    """128 bits of hash over every column of a row; maps are hashed as JSON."""
    columns = [
        F.to_json(F.struct(F.col(f"`{f.name}`"))) if _has_map(f.dataType) else F.col(f"`{f.name}`")
        for f in docs.schema.fields
    ]
    # a null would leave the hash as it is, so where the nulls are is hashed as well
    nulls = F.concat_ws("", *[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in docs.columns])
    return [
        F.xxhash64(F.lit(1), nulls, *columns).alias("key"),
        F.xxhash64(F.lit(2), nulls, *columns).alias("key2"),
    ]


def _each_copy(rows: DataFrame, repeated: int) -> DataFrame:
    """A row per copy; a row with very many copies is multiplied by many tasks."""
    once = rows.where("copies = 1").withColumn("copy", F.lit(0).cast("bigint"))
    if not repeated:
        return once.drop("copies")
    chunks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {_CHUNK}"))
    many = rows.where("copies > 1").withColumn("chunk", F.explode(chunks))
    many = many.repartition(partitions(rows.sparkSession), "key", "key2", "chunk")
    copies = F.sequence(
        F.col("chunk") * _CHUNK, F.least(F.col("copies"), (F.col("chunk") + 1) * _CHUNK) - 1
    )
    many = many.withColumn("copy", F.explode(copies)).drop("chunk")
    return once.unionByName(many).drop("copies")


def permutation(n: Column, seed: int, bucket: Column) -> Column:
    """The Fisher-Yates shuffle of the places below ``n`` (1 at least), ``_WIDTH`` bytes each, as binary.

    From the last place down to the second, the place is swapped with a drawn one that is
    not above it.  The bytes are overlaid in place of building an array for every swap.
    """
    place = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.lpad(F.hex(i), 2 * _WIDTH, F.lit("0")))
    start = F.unhex(F.array_join(place, ""))

    def swap(order: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(F.lit(seed), bucket, i), i + 1).cast("int")
        at_i, at_j = i * _WIDTH + 1, j * _WIDTH + 1
        taken = F.substring(order, at_i, F.lit(_WIDTH))
        moved = F.overlay(order, F.substring(order, at_j, F.lit(_WIDTH)), at_i, F.lit(_WIDTH))
        return F.overlay(moved, taken, at_j, F.lit(_WIDTH))

    downwards = F.when(n > 1, F.sequence(n - 1, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(downwards, start, swap)


def shuffled(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``doc`` (the row), ``position``, ``shard`` and ``slot`` of every row of ``docs``.

    ``position`` is the place in the random sequence of all rows, ``slot`` the one in its
    shard; both are gapless from 0.  Buckets hold about ``bucket_rows`` rows and
    ``bucket_bytes`` of text at most.

    One pass hashes the rows and counts them; the only exchange of whole rows is the
    scatter.  A bucket's permutation is joined by the bucket, as its row counts are.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    keys = docs.select(*_identity(docs), size.alias("size")).groupBy("key", "key2")
    keys = staged(keys.agg(F.count(F.lit(1)).alias("copies"), F.sum("size").alias("bytes")), "row-keys")
    seen = keys.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.count_if(F.col("copies") > 1).alias("repeated"),
    ).first()
    buckets = max(1, -(-seen["rows"] // bucket_rows), -(-seen["bytes"] // bucket_bytes))
    drawn = F.pmod(F.xxhash64(F.lit(seed), "key", "key2", "copy"), F.lit(buckets))
    bucket = F.coalesce(drawn, F.lit(0)).alias("bucket")  # never null, which spares a filter that hashes again

    whole = docs.select(*_identity(docs), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    if seen["repeated"]:
        several = broadcast_if_small(keys.where("copies > 1").select("key", "key2"))
        single = whole.join(several, ["key", "key2"], "left_anti").withColumn("copies", F.lit(1).cast("bigint"))
        many = whole.join(several, ["key", "key2"], "left_semi").groupBy("key", "key2")
        many = many.agg(F.count(F.lit(1)).alias("copies"), F.first("doc").alias("doc"))
        whole = single.unionByName(many)
    else:
        whole = whole.withColumn("copies", F.lit(1).cast("bigint"))
    scattered = _each_copy(whole, seen["repeated"]).select("*", bucket)

    filled = _each_copy(keys.drop("bytes"), seen["repeated"]).select(bucket)
    filled = filled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    filled = running_totals(filled, ["bucket"], {"through": F.col("n")}, ties=False)
    orders = filled.select(
        "bucket",
        (F.col("through") - F.col("n")).alias("offset"),
        permutation(F.col("n").cast("int"), seed, F.col("bucket")).alias("order"),
    )
    in_bucket = Window.partitionBy("bucket").orderBy("key", "key2", "copy")
    ranked = scattered.withColumn("index", F.row_number().over(in_bucket)).drop("key", "key2", "copy")
    place = F.conv(F.hex(F.substring("order", (F.col("index") - 1) * _WIDTH + 1, F.lit(_WIDTH))), 16, 10)
    placed = ranked.join(staged(orders, "bucket-orders"), "bucket").select(
        "doc", (F.col("offset") + place.cast("bigint")).alias("position")
    )
    return cut(placed, seen["rows"], shards)


def cut(placed: DataFrame, rows: int, shards: int) -> DataFrame:
    """Consecutive positions dealt to shards whose row counts differ by one at most."""
    shard = F.expr(f"cast((({shards}L * (position + 1)) - 1) div {max(rows, 1)}L as int)")
    slot = F.expr(f"position - (shard * {max(rows, 1)}L) div {shards}L")
    return placed.withColumn("shard", shard).withColumn("slot", slot)


def write(sharded: DataFrame, path: str) -> None:
    """A folder per shard; every file holds a stretch of its shard in the order of slots."""
    spark = sharded.sparkSession
    laid_out = sharded.repartitionByRange(partitions(spark), "shard", "slot")
    laid_out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digests(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """A row per document with its digest and where it lies."""
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    return shuffled(docs, shards).select(
        F.col("doc.doc_id").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

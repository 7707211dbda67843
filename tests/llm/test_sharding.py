"""Sharding against a plain Fisher-Yates shuffle of the same draws."""

import collections
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import sharding


def drawn(*numbers):
    """Spark's xxhash64 of longs and ints, the hash of one seeding the next."""
    state = 42
    for number, width in numbers:
        state = xxhash.xxh64_intdigest(number.to_bytes(width, "little", signed=True), seed=state)
    return state - (1 << 64) if state >> 63 else state


def fisher_yates(n, seed, bucket):
    order = list(range(n))
    for i in range(n - 1, 0, -1):
        j = drawn((seed, 4), (bucket, 8), (i, 4)) % (i + 1)
        order[i], order[j] = order[j], order[i]
    return order


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257])
def test_permutation_is_fisher_yates(spark, n):
    made = spark.range(5, 6).select(sharding.permutation(F.lit(n), 7, F.col("id"))).first()[0]
    found = [int.from_bytes(made[i : i + 4], "big") for i in range(0, len(made), 4)]
    assert found == fisher_yates(n, 7, 5)


def places(df):
    return sorted(tuple(r) for r in df.select("doc.doc_id", "shard", "slot").collect())


def check_law(rows, n, shards):
    per_shard = collections.defaultdict(list)
    for _, shard, slot in rows:
        per_shard[shard].append(slot)
    sizes = [len(per_shard[s]) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in per_shard.values())


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 1000])
def test_shards_are_even_and_gapless(spark, frame, n):
    docs = frame([(i, "x" * (i % 7)) for i in range(n)])
    rows = places(sharding.shuffled(docs, bucket_rows=50))
    assert [r[0] for r in rows] == list(range(n))
    check_law(rows, n, 16)


def test_the_layout_does_not_matter_but_the_seed_does(documents):
    first = places(sharding.shuffled(documents, bucket_rows=20))
    assert first == places(sharding.shuffled(documents.repartition(7), bucket_rows=20))
    assert first != places(sharding.shuffled(documents, seed=1, bucket_rows=20))


def test_the_order_is_well_mixed(spark, frame):
    n = 4000
    docs = frame([(i, str(i)) for i in range(n)])
    order = [r[0] for r in sharding.shuffled(docs, bucket_rows=300).orderBy("position").select("doc.doc_id").collect()]
    ups = sum(a < b for a, b in zip(order, order[1:]))
    moved = sum(abs(a - i) for i, a in enumerate(order)) / n
    assert abs(ups / n - 0.5) < 0.05 and abs(moved / n - 1 / 3) < 0.03


@pytest.mark.parametrize("small", [True, False])
def test_hot_repeated_rows_spread_over_buckets(spark, frame, monkeypatch, small):
    monkeypatch.setattr(sharding, "_CHUNK", 100)
    if not small:
        monkeypatch.setattr(sharding, "broadcast_if_small", lambda frame, **_: frame)
    rows = [(7, "same")] * 1000 + [(None, None)] * 500 + [(None, "")] * 3 + [(i, "t" * 50_000) for i in range(20)]
    placed = sharding.shuffled(frame(rows), bucket_rows=100)
    found = placed.select("doc.doc_id", "doc.text", "shard", "slot").collect()
    assert collections.Counter((r.doc_id, r.text) for r in found) == collections.Counter(rows)
    check_law([(r.doc_id, r.shard, r.slot) for r in found], len(rows), 16)
    per_shard = collections.Counter(r.shard for r in found if r.doc_id == 7)
    assert max(per_shard.values()) < 3 * min(per_shard.values())


def test_digest_nulls_empty_tables_and_clashing_columns(spark, frame):
    docs = frame([(1, "é"), (2, None), (3, "")]).withColumns(
        {c: F.lit(f"mine {c}") for c in ("shard", "slot", "doc", "key", "copy", "bucket", "position", "copies", "law")}
    ).withColumn("tags", F.create_map(F.lit("a"), F.lit(1)))
    found = {r.doc_id: r for r in sharding.digests(docs).collect()}
    assert (found[1].size, found[1].text_crc32) == (3, zlib.crc32("é".encode()))
    assert (found[2].size, found[2].text_crc32) == (found[3].size, found[3].text_crc32) == (1, 0)
    assert {r.law for r in found.values()} == {"rows"} and found[1].grown_shard is None
    kept = sharding.shuffled(docs).where("doc.doc_id = 1").select("doc.*").first()
    assert kept.shard == "mine shard" and kept.tags == {"a": 1}
    assert sharding.digests(frame([])).count() == 0


def test_written_shards_are_in_the_order_of_slots(spark, frame, tmp_path):
    docs = frame([(i, str(i)) for i in range(500)])
    sharding.write(sharding.shuffled(docs, 4, bucket_rows=64), str(tmp_path / "out"))
    for folder in (tmp_path / "out").glob("shard=*"):
        slots = []
        for file in sorted(folder.glob("*.parquet")):
            slots += [r.slot for r in spark.read.parquet(str(file)).select("slot").collect()]
        assert slots == list(range(125))

"""The n-gram Jaccard join against all pairs."""

import random
import re
import tracemalloc
from fractions import Fraction
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from tidemark.llm import ngram_join
from tidemark.llm.inputs import ship_code, table

LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[k:] for k in range(width))))


def brute_force(rows, width, threshold):
    sets = {d: shingle_set(t, width) for d, t in rows}
    label = {d: d for d in sets}

    def find(d):
        while label[d] != d:
            d = label[d]
        return d

    ids = sorted(d for d in sets if sets[d])
    for i, x in enumerate(ids):
        for y in ids[i + 1 :]:
            small, large = sorted((len(sets[x]), len(sets[y])))
            if small < threshold * large:
                continue
            both = len(sets[x] & sets[y])
            if both >= threshold * (len(sets[x]) + len(sets[y]) - both):
                a, b = sorted((find(x), find(y)))
                label[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


def run(df, width, threshold, **more):
    out = ngram_join.linked_documents(df, width, threshold, **more)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()}


@pytest.mark.parametrize("width, threshold", [(3, Fraction(9, 10)), (5, Fraction(4, 5))])
def test_given_documents(spark, sf_dir, width, threshold):
    ship_code(spark)
    df = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert run(df, width, threshold) == brute_force(rows, width, threshold)


def near_copies(seed=3):
    """A crowd of near copies, some linked and some just below, and odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "é É"), (8, "é é")]
    rows += [(9, "a b c"), (10, "A b  c"), (11, "a b c d"), (12, "x " * 5000), (13, "x x x")]
    at = 100
    for length, copies in ((150, 60), (18, 30), (40, 30), (900, 12)):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, max(2, length // 25))):
                words[rng.randrange(length)] = rng.choice(vocabulary)
            rows.append((at, " ".join(words)))
            at += 1
    return rows


@pytest.mark.parametrize("tile", [ngram_join.TILE, 700])
@pytest.mark.parametrize("width, threshold", [(3, Fraction(9, 10)), (5, Fraction(4, 5))])
def test_crowds_and_odd_texts(spark, width, threshold, tile):
    ship_code(spark)
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert run(df, width, threshold, tile=tile) == brute_force(rows, width, threshold)


def test_empty_table_and_clashing_columns(spark):
    ship_code(spark)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert run(df, 3, Fraction(9, 10)) == {}
    df = spark.createDataFrame([(1, "a b c", 9, 9), (2, "a b c", 9, 9)], "doc_id long, text string, component_id int, n int")
    assert run(df, 3, Fraction(9, 10)) == {1: (1, 1), 2: (1, 1)}
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    assert [r.doc_id for r in kept.collect()] == [1]


@pytest.mark.parametrize("parts", [1, 2, 8, 211])
def test_small_tables_at_any_number_of_partitions(spark, parts):
    ship_code(spark)
    tables = [
        [(1, "one document of a few words")],
        [(1, None), (2, ""), (3, " \t ")],
        [(1, "four words are equal"), (2, "four words are equal")],
        [(1, "x"), (2, "x"), (3, None)],
    ]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        for rows in tables if parts < 200 else tables[2:3]:
            df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
            assert run(df, 3, Fraction(9, 10)) == brute_force(rows, 3, Fraction(9, 10))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def peak(run, batches):
    """Bytes that numpy and Python held at most while the batches were worked off."""
    tracemalloc.start()
    try:
        for _ in run(batches):
            pass
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def texts(n, words=60):
    rng = random.Random(n)
    rows = [(i, " ".join(str(rng.randrange(10**6)) for _ in range(words))) for i in range(n)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["doc_id", "text"])


def block_rows(buckets, each, seed=1):
    """Packed block rows of buckets in their order, a bucket in five rows; some keys are shared."""
    rng = np.random.default_rng(seed)
    for bucket in range(buckets):
        rows = [(bucket, rng.integers(0, 2 * each, each // 5, dtype=np.uint64) * np.uint64(buckets) + np.uint64(bucket), rng.integers(0, 400, each // 5)) for _ in range(5)]
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        columns = zip(*((b, k.tobytes(), d.tobytes(), np.full((1, 4), 5 * b + i).tobytes()) for i, (b, k, d) in enumerate(rows)))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "keys", "docs", "sizes"])


@pytest.mark.parametrize("step", ["counts", "candidates", "meet"])
def test_memory_of_a_worker_does_not_follow_its_rows(monkeypatch, step):
    for name in ("READ", "HELD", "COUNTED"):
        monkeypatch.setattr(ngram_join, name, 1 << 14, raising=False)
    often = SimpleNamespace(value=np.zeros(ngram_join.SKETCH // 8, np.uint8))
    run, few, many = {
        "counts": lambda: (ngram_join._frequent_counts(5), [texts(500)], [texts(10_000)]),
        "candidates": lambda: (ngram_join._candidates(5, Fraction(4, 5), 16, often), [texts(500)], [texts(10_000)]),
        "meet": lambda: (ngram_join._meet, block_rows(4, 20_000), block_rows(80, 20_000)),
    }[step]()
    ngram_join.blocks.powers(1 << 21)  # kept from call to call
    assert peak(run, many) < 2 * peak(run, few)


def test_sets_leave_a_worker_in_small_batches_however_many_the_tiles(monkeypatch):
    monkeypatch.setattr(ngram_join, "HELD", 1 << 14, raising=False)
    batch, tiles = texts(500), 40
    more = [pa.array([0] * 500), pa.array([tiles] * 500, pa.int32()), pa.array([i % tiles for i in range(500)], pa.int32())]
    batch = pa.RecordBatch.from_arrays([*batch.columns, *more], names=["doc_id", "text", "group", "tiles", "tile"])
    out = [*ngram_join._grams(5)(iter([batch]))]
    assert max(x.nbytes for x in out) < 12 * ngram_join.HELD
    rows = [r for x in out for r in x.to_pylist()]
    assert len({(r["doc"], r["tile_a"], r["tile_b"]) for r in rows}) == len(rows) == 500 * tiles
    assert all(r["doc"] % tiles == (r["tile_b"] if r["side"] else r["tile_a"]) for r in rows)


@pytest.mark.parametrize("held", [7, 300, 1 << 19])
def test_documents_with_an_equal_block_row_meet_however_few_rows_are_held(monkeypatch, held):
    monkeypatch.setattr(ngram_join, "HELD", held, raising=False)
    batches = [*block_rows(6, 500)]
    found = pa.Table.from_batches([x for x in ngram_join._meet(iter(batches))]).to_pylist()
    assert sorted(r["a"] for r in found if r["kind"] == 0) == sorted(5 * b + i for b in range(6) for i in range(5))

    def groups(pairs):
        label = list(range(400))
        for a, b in pairs:
            x, y = sorted((label[a], label[b]))
            label = [x if v == y else v for v in label]
        return label

    first, pairs = {}, []
    for batch in batches:
        for k, d in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            for key, doc in zip(np.frombuffer(k, np.uint64).tolist(), np.frombuffer(d, np.int64).tolist()):
                pairs.append((first.setdefault(key, doc), doc))
    assert groups((r["a"], r["b"]) for r in found if r["kind"] == 1) == groups(pairs)


def test_counts_in_parts_and_the_number_of_all_ngrams(monkeypatch):
    """A part of many documents and a set that is larger than a part."""
    monkeypatch.setattr(ngram_join, "READ", 100, raising=False)
    monkeypatch.setattr(ngram_join, "COUNTED", 50, raising=False)
    rows = [(i, "a b c d e") for i in range(40)] + [(99, " ".join(map(str, range(200))))]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["doc_id", "text"])
    counted = {}
    for out in ngram_join._frequent_counts(5)(iter([batch])):
        for bucket, n in zip(*(c.to_pylist() for c in out.columns)):
            counted[bucket] = counted.get(bucket, 0) + n
    assert counted.pop(-1) == 40 + 196
    assert list(counted.values()) == [40]

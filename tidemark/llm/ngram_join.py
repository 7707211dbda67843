"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

Two texts link when the Jaccard similarity of their word n-gram sets reaches a
threshold.  The incidence matrix is blocked twice.

*Column blocks.*  Sets are put in size classes; the largest symmetric difference that a
linked pair of a class can have follows from the sizes.  The columns are dealt by hash
into a few more blocks than that, so a linked pair has equal rows in at least one block
(pigeonhole).  Documents with an equal block row become candidates.  The columns of
n-grams that very many documents hold are left out: without them a difference can only
shrink, so the argument stands, and frequent lines gather no crowd.  Documents with so
many empty blocks that it fails (little but frequent n-grams) meet each other by blocks of
all their columns, and in the last resort in one block row per size class.

*Row blocks.*  Candidates fall into connected groups.  Within a group the rows are dealt
into tiles of bounded size, and every pair of tiles is multiplied in one task: overlap
counts are accumulated n-gram by n-gram, pairs below ``threshold / (1 + threshold) *
(size + size)`` are discarded, and a spanning forest of the links is kept.  Rows that
are connected to everything in their tiles need no further product.

Equal sets are one row of the product.  Nothing is capped: a group of any size is the
same work in more tiles.

*Memory.*  A Python worker holds one Arrow batch and, besides, arrays of bounded size:
block rows leave it as soon as there are ``HELD`` of them, one bucket of them is matched
at a time, and the number of buckets follows from the number of n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import blocks
from tidemark.llm.components import components
from tidemark.llm.inputs import partitions
from tidemark.session import staged

BUCKETS = 1024
SPARE = 1
SKETCH = 1 << 22  # buckets of n-grams that are frequent or not as a whole
FREQUENT = 0.001  # share of the documents from which a bucket is frequent
TILE = 1 << 20  # n-grams of a tile of the product
READ = 1 << 18  # bytes of text that become sets together
HELD = 1 << 19  # block rows, pairs or n-grams (8 or 16 bytes each) that a worker gathers
COUNTED = 1 << 22  # n-grams that are counted together

_PACKED = "bucket int, keys binary, docs binary, sizes binary"
_FOUND = "kind int, a long, b long, n long, s1 long, s2 long"
_SETS = "group long, tile_a int, tile_b int, side int, doc long, grams binary"


class Classes:
    """Size classes and the number of column blocks of each."""

    def __init__(self, threshold: Fraction):
        self.threshold = threshold
        self.lows = [1]

    def up_to(self, n: int) -> None:
        while self.lows[-1] <= n:
            low = self.lows[-1]
            self.lows.append(max(low + 1, int(low / self.threshold) + 1))

    def of(self, sizes: np.ndarray) -> np.ndarray:
        self.up_to(int(sizes.max(initial=1)) * 2 + 4)
        return np.searchsorted(self.lows, sizes, "right") - 1

    def difference(self, group: np.ndarray) -> np.ndarray:
        """The largest symmetric difference of a linked pair below the next class."""
        top = np.array(self.lows, np.int64)[group + 1] - 1
        rest = (1 - self.threshold) / (1 + self.threshold)
        return 2 * top * rest.numerator // rest.denominator

    def columns(self, group: np.ndarray, difference: np.ndarray) -> np.ndarray:
        """Column blocks of a class: one more than can differ, and as many as may be empty.

        Dealing the smallest set that is cut for the class leaves about ``empty`` blocks
        without a column; a set with more empty ones than are spare is unsafe.
        """
        least = np.array(self.lows)[np.maximum(group - 1, 0)]
        count = difference + 1 + SPARE
        for _ in range(4):
            empty = count * np.exp(-least / count)
            count = difference + 1 + SPARE + np.ceil(empty + 3 * np.sqrt(empty) - 0.1).astype(np.int64)
        return np.where(difference == 0, 1, count)  # only equal sets link: one block


def _set_rows(batch: pa.RecordBatch, width: int):
    """Sets of each chunk of a batch: ``ids, hashes, owner, bounds``."""
    ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    for first, last, data, offsets in blocks.chunks(batch.column(1), READ):
        n = last - first
        hashes, owner, _, _ = blocks.words(data, offsets)
        grams, of = blocks.shingles(hashes, owner, n, width)
        yield ids[first:last], *blocks.sets(grams, of, n)


def _frequent_counts(width: int):
    """How many documents hold n-grams of a bucket, where that is notable; at -1 all n-grams.

    A batch is counted as a whole, or in parts of ``COUNTED`` n-grams at most; a larger set is one.
    """

    def counted(grams: np.ndarray, documents: int) -> pa.RecordBatch:
        grams.sort()
        least = max(3, int(np.ceil(FREQUENT / 2 * documents)))
        begins = grams[: max(0, len(grams) - least + 1)] == grams[least - 1 :]
        begins[1:] &= grams[1 : len(begins)] != grams[: max(0, len(begins) - 1)]
        begins = np.flatnonzero(begins)
        n = np.searchsorted(grams, grams[begins], "right") - begins
        buckets = (grams[begins] % np.uint64(SKETCH)).astype(np.int64)
        buckets, n = np.append(buckets, -1), np.append(n, len(grams))
        return pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(n)], names=["bucket", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = np.empty(COUNTED, np.uint64)
        for batch in batches:
            documents = held = 0
            for ids, grams, _, _ in _set_rows(batch, width):
                if held + len(grams) > len(space):
                    yield counted(space[:held], documents)
                    documents = held = 0
                if len(grams) > len(space):
                    yield counted(grams, len(ids))
                    continue
                space[held : held + len(grams)] = grams
                documents, held = documents + len(ids), held + len(grams)
            if documents:
                yield counted(space[:held], documents)

    return run


def frequent_buckets(docs: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """A bit per bucket: whether a notable share of the documents hold n-grams of it.

    Of fixed size whatever the input.  It steers which columns the blocks leave out and
    has no influence on the result.  Also the number of n-grams of all documents.
    """
    least = max(8, int(FREQUENT * docs.count()))
    found = (
        docs.mapInArrow(_frequent_counts(width), "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .filter((F.col("n") >= least) | (F.col("bucket") < 0))
        .toPandas()
    )
    bucket, n = (found[c].to_numpy(np.int64) for c in ("bucket", "n"))
    bits = np.zeros(SKETCH, bool)
    bits[bucket[bucket >= 0]] = True
    return np.packbits(bits), int(n[bucket < 0].sum())


def _block_rows(grams, owner, bounds, classes: Classes, frequent: np.ndarray):
    """Block rows without the frequent columns, and with them where those are too few.

    ``frequent``: whether a bucket is frequent.  Sizes stay those of the whole sets.
    """
    sizes = np.diff(bounds)
    rare = ~frequent[(grams % np.uint64(SKETCH)).astype(np.int64)]
    keys, docs, unsafe = _blocks(grams[rare], owner[rare], sizes, classes, 33)
    if not len(unsafe):
        return keys, docs
    again = np.zeros(len(sizes), bool)
    again[unsafe] = True
    left = again[owner]
    more, of, last = _blocks(grams[left], owner[left], np.where(again, sizes, 0), classes, 34)
    own = classes.of(sizes[last])
    rest = [blocks.mix((own + step).astype(np.uint64) + blocks.SALTS[32]) for step in (0, 1)]
    return np.concatenate([keys, more, *rest]), np.concatenate([docs, of, last, last])


def _blocks(grams, owner, sizes, classes: Classes, salt: int):
    """``key, document`` of each nonempty column block, and documents with too few of them.

    Each set is cut for its own size class and for the next, where larger sets meet it.
    """
    full = np.flatnonzero(sizes)
    if not len(full):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    place = np.full(len(sizes), -1)
    place[full] = np.arange(len(full))
    owner, own = place[owner], classes.of(sizes[full])
    keys, docs, failed = [], [], np.zeros(len(full), bool)
    for step in (0, 1):
        group = own + step
        difference = classes.difference(group)
        count = classes.columns(group, difference)
        start = np.concatenate([[0], np.cumsum(count)])
        column = (grams >> np.uint64(9)) % count.astype(np.uint64)[owner]
        block = start[owner] + column.astype(np.int64)
        held = np.bincount(block, minlength=start[-1])
        sums = blocks.grouped_sums(blocks.mix(grams), block, start[-1])
        of = np.repeat(np.arange(len(full)), count)
        within = (np.arange(start[-1]) - start[:-1][of]).astype(np.uint64)
        key = sums + within * blocks.SALTS[30] + group[of].astype(np.uint64) * blocks.SALTS[31]
        key = blocks.mix(key + blocks.SALTS[salt])
        empty = np.add.reduceat((held == 0).astype(np.int64), start[:-1])
        failed |= empty >= count - difference
        keep = held > 0
        keys.append(key[keep])
        docs.append(full[of[keep]])
    return np.concatenate(keys), np.concatenate(docs), full[failed]


def _dealt(keys, docs, rows, buckets: int) -> Iterator[pa.RecordBatch]:
    """Block rows and documents in packed form, dealt into buckets by their hash."""
    schema = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("sizes", pa.binary())])
    keys, docs, rows = np.concatenate(keys), np.concatenate(docs), np.concatenate(rows)
    bucket = (keys % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    keys, docs, bucket = keys[order], docs[order], bucket[order]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    home = blocks.mix(rows[:, 0].astype(np.uint64)) % np.uint64(buckets)
    order = np.argsort(home, kind="stable")
    rows, home = rows[order], home[order]
    ends = np.searchsorted(home, np.arange(buckets + 1))
    full = np.flatnonzero((np.diff(cuts) > 0) | (np.diff(ends) > 0))
    for part in np.array_split(full, max(1, len(full) // 256)):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()),
                pa.array([keys[cuts[i] : cuts[i + 1]].tobytes() for i in part], pa.binary()),
                pa.array([docs[cuts[i] : cuts[i + 1]].tobytes() for i in part], pa.binary()),
                pa.array([rows[ends[i] : ends[i + 1]].tobytes() for i in part], pa.binary()),
            ],
            schema=schema,
        )


def _candidates(width: int, threshold: Fraction, buckets: int, frequent: Broadcast):
    """Map side: block rows in packed form, sent on whenever ``HELD`` of them are gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(threshold)
        often = np.unpackbits(frequent.value).view(bool)
        keys, docs, rows, held = [], [], [], 0
        for batch in batches:
            for ids, grams, owner, bounds in _set_rows(batch, width):
                key, of = _block_rows(grams, owner, bounds, classes, often)
                keys.append(key)
                docs.append(ids[of])
                twice = [blocks.grouped_sums(blocks.mix(grams ^ s), owner, len(ids)) for s in blocks.SALTS[50:52]]
                rows.append(np.stack([ids, np.diff(bounds), *(x.astype(np.int64) for x in twice)], 1))
                held += len(key)
                if held >= HELD:
                    yield from _dealt(keys, docs, rows, buckets)
                    keys, docs, rows, held = [], [], [], 0
        if rows:
            yield from _dealt(keys, docs, rows, buckets)

    return run


def _found(kind, columns) -> pa.RecordBatch:
    names = ("a", "b", "n", "s1", "s2")
    n = len(columns[0])
    data = [pa.array(np.full(n, kind, np.int32))]
    data += [pa.array(np.ascontiguousarray(c).astype(np.int64)) for c in columns]
    data += [pa.nulls(n, pa.int64())] * (6 - len(data))
    return pa.RecordBatch.from_arrays(data, names=["kind", *names])


def _tied(keys, docs):
    """``key, least, pairs``: distinct keys, the smallest document of each, and the others tied to it."""
    keys, docs = np.concatenate(keys), np.concatenate(docs)
    order = np.argsort(keys)
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(docs, first) if len(first) else docs
    of = np.repeat(least, np.diff(np.append(first, len(docs))))
    apart = of != docs
    return keys[first], least, np.unique(np.stack([of[apart], docs[apart]], 1), axis=0)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side: documents with an equal block row are tied to the smallest of them.

    The partition is sorted by bucket.  Of a bucket of more than ``HELD`` block rows, what is
    read so far gives way to its distinct keys, each with the smallest document.
    """
    now, keys, docs, held, ties, n = None, [], [], 0, [], 0
    for batch in batches:
        rows = []
        for bucket, k, d, s in zip(*batch.columns, strict=True):
            bucket = bucket.as_py()
            if bucket != now or held >= HELD:
                if keys:
                    key, least, pairs = _tied(keys, docs)
                    keys, docs = ([key], [least]) if bucket == now else ([], [])
                    ties.append(pairs)
                    n += len(pairs)
                now, held = bucket, 0
                if n >= HELD:  # the same two documents meet in many buckets
                    ties = [np.unique(np.concatenate(ties), axis=0)]
                    n = len(ties[0])
                    if n > HELD // 2:
                        yield _found(1, ties[0].T)
                        ties, n = [], 0
            keys.append(np.frombuffer(k.as_buffer(), np.uint64))
            docs.append(np.frombuffer(d.as_buffer(), np.int64))
            held += len(keys[-1])
            rows.append(np.frombuffer(s.as_buffer(), np.int64).reshape(-1, 4))
        if rows:
            keys, docs = [np.concatenate(keys)], [np.concatenate(docs)]  # the batch can go
            rows = np.concatenate(rows)
            yield _found(0, [rows[:, 0], rows[:, 0], *rows.T[1:]])
    if keys:
        ties.append(_tied(keys, docs)[2])
    if ties and len(pairs := np.unique(np.concatenate(ties), axis=0)):
        yield _found(1, pairs.T)


def _grams(width: int):
    """The whole set of each candidate, once for every pair of tiles that it is in."""
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    names = ["group", "tile_a", "tile_b", "side", "doc", "grams"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0

        def packed() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            at = 0
            groups, tiles, tile = (batch.column(i).to_numpy() for i in (2, 3, 4))
            for ids, grams, _, bounds in _set_rows(batch, width):
                for i, doc in enumerate(ids, at):
                    mine = int(tile[i])
                    own = grams[bounds[i - at] : bounds[i - at + 1]]
                    content = own.tobytes()
                    for other in range(int(tiles[i])):
                        out.append((groups[i], min(mine, other), max(mine, other), int(mine > other), doc, content))
                        held += len(own)
                        if held >= HELD:
                            yield packed()
                            out, held = [], 0
                at += len(ids)
        if out:
            yield packed()

    return run


def product_links(docs, sides, sets, threshold: Fraction) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs of two tiles (or of one with itself)."""
    n = len(docs)
    sizes = np.array([len(s) for s in sets])
    grams = np.concatenate(sets)
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    del grams
    ids = np.empty(len(order), np.int32)
    ids[order] = np.cumsum(new, dtype=np.int32) - 1
    row = np.repeat(np.arange(n, dtype=np.int32), sizes)[order]
    starts = np.append(np.flatnonzero(new), len(order))
    del order, new
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    label = np.arange(n)
    p, q = threshold.numerator, threshold.denominator
    both = sides.min() != sides.max()
    links = []
    for x in range(n):
        if both and sides[x]:
            continue
        other = (sides == 1) if both else np.arange(n) > x
        if not (other & (label != label[x])).any():
            continue
        mine = ids[bounds[x] : bounds[x + 1]]
        low, high = starts[mine], starts[mine + 1]
        spread = np.arange((high - low).sum()) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        overlap = np.bincount(row[np.repeat(low, high - low) + spread], minlength=n)
        linked = other & (overlap * (p + q) >= p * (sizes + sizes[x]))
        for y in np.flatnonzero(linked & (label != label[x])):
            if label[y] != label[x]:
                links.append((int(docs[x]), int(docs[y])))
                label[label == label[y]] = label[x]
    return links


def _multiply(threshold: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One group of rows after another: the partition is sorted by its tiles."""
        key, rows = None, []

        def done():
            if len(rows) > 1:
                docs, sides, sets = (list(x) for x in zip(*rows, strict=True))
                found = product_links(np.array(docs), np.array(sides), sets, threshold)
                if found:
                    pairs = np.array(found)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            for g, a, b, side, doc, grams in zip(*batch.columns, strict=True):
                now = (g.as_py(), a.as_py(), b.as_py())
                if now != key:
                    yield from done()
                    key, rows = now, []
                rows.append((doc.as_py(), side.as_py(), np.frombuffer(grams.as_py(), np.uint64)))
        yield from done()

    return run


def linked_documents(
    docs: DataFrame,
    width: int = 3,
    threshold: Fraction = Fraction(9, 10),
    buckets: int = BUCKETS,
    tile: int = TILE,
) -> DataFrame:
    """``doc_id, n_shingles, set_id, component_id`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` (distinct, not null) and ``text``; other columns are
    ignored.  Words are split at ASCII blanks after lower-casing A-Z.  A text of fewer
    words than ``width`` is one n-gram; a null or blank text is an empty set that links
    with nothing and is its own component.  ``set_id`` is the smallest document with
    the same set, ``component_id`` the smallest that links reach.  An empty table
    gives no rows.  ``buckets`` should be several times the shuffle partitions.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bits, grams = frequent_buckets(docs, width)
    often = spark.sparkContext.broadcast(bits)
    # as many buckets for each partition, and no more than about HELD block rows in one
    buckets = -(-max(buckets, 4 * parts, grams // HELD) // parts) * parts
    found = staged(
        docs.mapInArrow(_candidates(width, threshold, buckets, often), _PACKED)
        .repartitionById(parts, F.col("bucket"))
        .sortWithinPartitions("bucket")
        .mapInArrow(_meet, _FOUND),
        "ngram-candidates",
    )
    rows = found.filter("kind = 0").select(F.col("a").alias("doc_id"), F.col("n").alias("n_shingles"), "s1", "s2")
    # written, so that the join below is a plain one and Spark may split a crowd of copies
    same = staged(
        rows.filter("n_shingles > 0").groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("set_id")),
        "ngram-copies",
    )
    rows = staged(
        rows.join(same, ["n_shingles", "s1", "s2"], "left").select(
            "doc_id", "n_shingles", F.coalesce("set_id", "doc_id").alias("set_id")
        ),
        "ngram-sets",
    )
    names = rows.filter("doc_id <> set_id").select("doc_id", "set_id")
    ends = found.filter("kind = 1").select("a", "b").distinct()
    for end in ("a", "b"):  # equal sets are one row of the product
        ends = ends.join(names.withColumnRenamed("doc_id", end), end, "left").withColumn(
            end, F.coalesce("set_id", end)
        ).drop("set_id")
    groups = components(ends)
    members = groups.join(rows.select(F.col("doc_id").alias("node"), "n_shingles"), "node")
    weight = members.groupBy("component").agg(
        F.ceil(F.sum("n_shingles") / tile).cast("int").alias("tiles"), F.count("*").alias("m")
    )
    plan = staged(
        members.join(weight.filter("m > 1"), "component").select(
            F.col("node").alias("doc_id"),
            F.col("component").alias("group"),
            "tiles",
            F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("tile"),
        ),
        "ngram-tiles",
    )
    links = (
        docs.join(plan, "doc_id")
        .select("doc_id", "text", "group", "tiles", "tile")
        .mapInArrow(_grams(width), _SETS)
        .repartition(parts, "group", "tile_a", "tile_b")
        .sortWithinPartitions("group", "tile_a", "tile_b")
        .mapInArrow(_multiply(threshold), "a long, b long")
    )
    joined = components(links).select(F.col("node").alias("set_id"), F.col("component"))
    return rows.join(joined, "set_id", "left").select(
        "doc_id", "n_shingles", "set_id", F.coalesce("component", "set_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, width: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """``docs`` without the rows that a smaller document stands for."""
    kept = linked_documents(docs, width, threshold).filter("doc_id = component_id").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi")

"""Removal of repeated byte strings with merged Burrows-Wheeler transforms.

Every byte that is covered by a string of ``MATCH`` bytes which also starts earlier (in a
smaller document or further up) goes.

*Dealing.*  A window of ``MATCH`` bytes has an anchor: its ``GRAM``-byte string of the smallest
hash.  Neighbouring windows with one anchor form a stretch; equal windows have equal
anchors, so they meet when stretches are dealt by the anchor.  Equal stretches are
collapsed to their earliest one, first within a batch, and all later ones are covered
whole.  An anchor with a single stretch holds no repeat.

*Merging.*  What is left, distinct stretches that share an anchor, is gathered in groups of
bounded size.  A group is cut into shards; each shard's suffixes are sorted and give
its transform over symbols of ``STEP`` bytes.  The transforms are merged by refining their
interleave: each round reads every transform in its own order and sorts the symbols
stably, which orders the merged suffixes by ``STEP`` bytes more; a boundary appears where
the common prefix ends.  No suffix is sorted again.  After ``MATCH / STEP`` rounds, an
interval without a boundary is one repeated window with all its places.

An anchor with more than ``CROWD`` distinct stretches (a common line among ever other
text) is dealt on by the hashes of its single windows, so no task holds a crowd.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import blocks
from tidemark.llm.inputs import partitions
from tidemark.session import staged

MATCH = 100
GRAM = 32
STEP = 4
BUCKETS = 1024
CROWD = 4096
GROUP = 1 << 20  # bytes of stretches that are merged together
SHARD = 1 << 18

_PACKED = "bucket int, rows binary, bytes binary"
_FOUND = "kind int, key long, doc long, start long, stop long"
_STRETCH = np.dtype([("key", "<u8"), ("text", "<u8"), ("doc", "<i8"), ("start", "<u4"), ("size", "<u2")])
_PLACE = np.dtype([("key", "<u8"), ("doc", "<i8"), ("start", "<u4"), ("size", "<u2")])
SPAN, LATER, CROWDED = 0, 1, 2  # kinds of found rows


def _sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the rolling hash."""
    up, _ = blocks.powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(blocks._VALUES[data] * up[: len(data)], out=out[1:])
    return out


def _hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    _, down = blocks.powers(len(sums))
    return blocks.mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64))


def stretches(data: np.ndarray, offsets: np.ndarray):
    """``owner, start, stop, anchor, text``: runs of windows with one anchor."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < MATCH:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = _sums(data)
    _, down = blocks.powers(n + 1)
    grams = blocks.mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    # as many bits of the hash decide in every chunk, or equal windows could differ in anchors
    bits = np.uint64(max(24, n.bit_length()))
    least = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    span, width = 1, MATCH - GRAM + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[: n - MATCH + 1], least[width - span : width - span + n - MATCH + 1])
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    sizes = np.diff(offsets)
    change = np.ones(len(anchor), bool)
    change[1:] = anchor[1:] != anchor[:-1]
    inside = np.zeros(n + 1, np.int32)  # windows that do not cross into another document
    full = sizes >= MATCH
    np.add.at(inside, offsets[:-1][full], 1)
    np.add.at(inside, offsets[1:][full] - MATCH + 1, -1)
    inside = np.cumsum(inside)[: len(anchor)] > 0
    change[offsets[:-1][full]] = True
    change[1:] |= inside[1:] != inside[:-1]
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(anchor)) - 1
    keep = inside[first]
    first, last = first[keep], last[keep]
    stop = last + MATCH
    owner = np.searchsorted(offsets, first, "right") - 1
    # empty documents share an offset; the last of them owns the bytes
    return owner, first, stop, grams[anchor[first]], _hash(sums, first, stop)


def _merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Spans of each document, overlapping and adjacent ones joined."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order].astype(np.int64), stop[order].astype(np.int64)
    far = int(stop.max()) + 1
    group = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])])
    reach = np.maximum.accumulate(stop + group * far) - group * far
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], reach[ends]


def _collapse(rows: np.ndarray):
    """The earliest of equal stretches, sorted by anchor, and the spans of the others."""
    order = np.lexsort((rows["start"], rows["doc"], rows["text"], rows["key"]))
    rows = rows[order]
    head = np.ones(len(rows), bool)
    head[1:] = (rows["key"][1:] != rows["key"][:-1]) | (rows["text"][1:] != rows["text"][:-1])
    later = rows[~head]
    return rows[head], _merged(later["doc"], later["start"], later["start"].astype(np.int64) + later["size"])


def _dealt(rows: np.ndarray, buckets: int, texts=None) -> Iterator[pa.RecordBatch]:
    bucket = (rows["key"] % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    full = np.flatnonzero(np.diff(cuts))
    for part in np.array_split(full, max(1, len(full) // 256)):
        own = [rows[cuts[i] : cuts[i + 1]] for i in part]
        held = [texts(order[cuts[i] : cuts[i + 1]]) if texts else None for i in part]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()),
                pa.array([_columns(x) for x in own], pa.binary()),
                pa.array(held, pa.binary()),
            ],
            names=["bucket", "rows", "bytes"],
        )


def _columns(rows: np.ndarray) -> bytes:
    """Fields one after another: like values side by side compress better."""
    return b"".join(np.ascontiguousarray(rows[f]).tobytes() for f in rows.dtype.names)


def _rows(packed: bytes, kind: np.dtype) -> np.ndarray:
    n, at = len(packed) // kind.itemsize, 0
    out = np.empty(n, kind)
    for f in kind.names:
        size = kind[f].itemsize * n
        out[f] = np.frombuffer(packed, kind[f], n, at)
        at += size
    return out


def _anchored(buckets: int):
    """Map side: stretches of whole texts, equal ones of a batch collapsed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            parts = []
            for first, _, data, offsets in blocks.chunks(batch.column(1)):
                owner, start, stop, key, text = stretches(data, offsets)
                rows = np.empty(len(owner), _STRETCH)
                rows["key"], rows["text"] = key, text
                rows["doc"] = ids[first + owner]
                rows["start"], rows["size"] = start - offsets[owner], stop - start
                parts.append(rows)
            if not parts:
                continue
            rows, (doc, start, stop) = _collapse(np.concatenate(parts))
            yield from _dealt(rows, buckets)
            if len(doc):
                spans = np.stack([doc, start, stop], 1)
                home = (blocks.mix(doc.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
                for part in np.array_split(np.argsort(home), max(1, len(home) // 4096)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(home[part[:1]]), pa.nulls(1, pa.binary()), pa.array([spans[part].tobytes()], pa.binary())],
                        names=["bucket", "rows", "bytes"],
                    )

    return run


def _found(kind, key, doc, start, stop) -> pa.RecordBatch:
    columns = [np.broadcast_to(np.asarray(kind, np.int32), len(doc)), key, doc, start, stop]
    kinds = (np.int32, np.int64, np.int64, np.int64, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(c).astype(k)) for c, k in zip(columns, kinds, strict=True)],
        names=["kind", "key", "doc", "start", "stop"],
    )


def _meet(batches: Iterator[pa.RecordBatch], crowd: int) -> Iterator[pa.RecordBatch]:
    """Reduce side: covered spans, and distinct stretches that share an anchor."""
    parts = []
    for batch in batches:
        for packed, spans in zip(batch.column(1), batch.column(2), strict=True):
            if packed.is_valid:
                parts.append(_rows(packed.as_py(), _STRETCH))
            else:
                found = np.frombuffer(spans.as_py(), np.int64).reshape(-1, 3)
                yield _found(SPAN, found[:, 0] * 0, found[:, 0], found[:, 1], found[:, 2])
    if not parts:
        return
    rows, (doc, start, stop) = _collapse(np.concatenate(parts))
    yield _found(SPAN, doc * 0, doc, start, stop)
    key = rows["key"]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.repeat(np.diff(np.append(first, len(rows))), np.diff(np.append(first, len(rows))))
    rows, count = rows[count > 1], count[count > 1]
    yield _found(
        np.where(count > crowd, CROWDED, LATER).astype(np.int32),
        rows["key"].view(np.int64) if len(rows) else np.zeros(0, np.int64),
        rows["doc"],
        rows["start"],
        rows["start"].astype(np.int64) + rows["size"],
    )


def _texts(buckets: int):
    """The bytes of the stretches that are to be merged; single windows of a crowd."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = blocks.text_bytes(batch.column(1))
            lists = batch.column(2)
            counts = np.diff(lists.offsets.to_numpy())
            wanted = lists.flatten()
            kind, key, start, stop = (wanted.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            rows = np.empty(len(kind), _PLACE)
            owner = np.repeat(np.arange(len(ids)), counts)
            rows["key"], rows["doc"] = key.astype(np.int64).view(np.uint64), ids[owner]
            rows["start"], rows["size"] = start, stop - start
            at = offsets[:-1][owner] + start
            usual = kind != CROWDED
            own, begin = rows[usual], at[usual]

            def texts(index, own=own, begin=begin):
                return b"".join(data[begin[i] : begin[i] + int(own["size"][i])].tobytes() for i in index)

            if len(own):
                yield from _dealt(own, buckets, texts)
            crowd, begin = rows[~usual], at[~usual]
            for part in np.array_split(np.arange(len(crowd)), max(1, len(crowd) // 2048)):
                if len(part):
                    n = crowd["size"][part].astype(np.int64) - MATCH + 1
                    of = np.repeat(part, n)
                    step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                    bytes_ = np.concatenate([data[begin[i] : begin[i] + int(crowd["size"][i])] for i in part])
                    base = np.repeat(np.cumsum(n + MATCH - 1) - (n + MATCH - 1), n) + step
                    single = np.empty(len(of), _PLACE)
                    single["key"] = _hash(_sums(bytes_), base, base + MATCH)
                    single["doc"], single["start"], single["size"] = crowd["doc"][of], crowd["start"][of] + step, MATCH
                    # windows of a crowd meet by their own hashes and need no bytes
                    yield from _dealt(single, buckets, lambda index: b"")

    return run


class Transform:
    """Suffix order of a shard of strings and its transform over ``STEP`` bytes."""

    def __init__(self, codes: np.ndarray):
        n, rank, reach = len(codes), codes, STEP
        while True:
            top = np.int64(rank.max(initial=0)) + 1
            pair = rank.astype(np.int64) * top + np.roll(rank, -reach)
            self.order = np.argsort(pair)
            sorted_ = pair[self.order]
            new = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
            rank = np.empty(n, np.int64)
            rank[self.order] = new
            reach *= 2
            if new[-1] == n - 1 or reach > n:
                break
        self.symbols = codes[(self.order - STEP) % n]


def symbol_codes(letters: np.ndarray, string: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Dense, ordered codes of the ``STEP`` letters at each place; ends are all different."""
    n = len(letters)
    code, open_ = np.zeros(n, np.uint64), np.ones(n, bool)
    owner = np.zeros(n, np.uint64)
    for k in range(STEP):
        at = np.minimum(np.arange(n) + k, n - 1)
        code = code * np.uint64(512) + np.where(open_, letters[at], 0).astype(np.uint64)
        now = open_ & ends[at]
        owner[now] = string[at[now]] + 1
        open_ &= ~now
    return np.unique((code << np.uint64(28)) | owner, return_inverse=True)[1].astype(np.int64)


def _stable(symbols: np.ndarray) -> np.ndarray:
    """A stable order of dense codes, by one or two passes over 16 bits."""
    order = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    if int(symbols.max(initial=0)) > 0xFFFF:
        order = order[np.argsort((symbols[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def merge(transforms: list[Transform], bases: np.ndarray, depth: int = MATCH):
    """``place, interval`` of all suffixes in merged order, by their first ``depth`` bytes.

    The interleave says which shard the next suffix is from; within a shard they come in
    the shard's own order, so one vector of shard numbers is all that is refined.
    """
    sizes = np.array([len(t.order) for t in transforms])
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    symbols = np.concatenate([t.symbols for t in transforms])
    places = np.concatenate([t.order + b for t, b in zip(transforms, bases, strict=True)])
    shard = np.repeat(np.arange(len(transforms), dtype=np.uint8), sizes)
    interval = np.zeros(len(shard), np.int32)

    def own_order() -> np.ndarray:
        index = np.empty(len(shard), np.int64)
        for k in range(len(transforms)):
            index[shard == k] = np.arange(starts[k], starts[k] + sizes[k])
        return index

    for _ in range(-(-depth // STEP)):
        read = symbols[own_order()]
        order = _stable(read)
        read, interval, shard = read[order], interval[order], shard[order]
        new = np.zeros(len(shard), np.int32)
        new[1:] = np.cumsum((read[1:] != read[:-1]) | (interval[1:] != interval[:-1]))
        interval = new
    return places[own_order()], interval


def repeated(rows: np.ndarray, data: np.ndarray, shard: int = SHARD) -> np.ndarray:
    """Which windows of a group of stretches occur before: ``doc, start`` of each."""
    sizes = rows["size"].astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    string = np.repeat(np.arange(len(rows)), sizes + 1)
    begins = bounds[:-1] + np.arange(len(rows))
    within = np.arange(len(string)) - begins[string]
    ends = within == sizes[string]
    letters = np.zeros(len(string), np.int64)
    letters[~ends] = data.astype(np.int64) + 1
    codes = symbol_codes(letters, string, ends)
    cuts = [0]
    while cuts[-1] < len(rows):  # shards of whole strings
        full = np.searchsorted(begins, begins[cuts[-1]] + shard)
        cuts.append(int(max(cuts[-1] + 1, full)))
    limits = np.append(begins, len(string))
    bases = limits[cuts[:-1]]
    transforms = [Transform(codes[limits[a] : limits[b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    place, interval = merge(transforms, bases)
    window = within[place] + MATCH <= sizes[string[place]]
    place, interval = place[window], interval[window]
    doc = rows["doc"][string[place]]
    start = rows["start"].astype(np.int64)[string[place]] + within[place]
    order = np.lexsort((start, doc, interval))
    later = np.concatenate([[False], interval[order][1:] == interval[order][:-1]])
    return np.stack([doc[order][later], start[order][later]], 1)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that the merged transforms, or the windows of crowds, show as repeated."""
    parts, texts, single = [], [], []
    for batch in batches:
        for packed, held in zip(batch.column(1), batch.column(2), strict=True):
            rows = _rows(packed.as_py(), _PLACE)
            if held.as_py():
                parts.append(rows)
                texts.append(np.frombuffer(held.as_py(), np.uint8))
            else:
                single.append(rows)
    found = []
    if parts:
        rows, data = np.concatenate(parts), np.concatenate(texts)
        at = np.concatenate([[0], np.cumsum(rows["size"].astype(np.int64))])
        order = np.argsort(rows["key"], kind="stable")
        key, total = rows["key"][order], np.cumsum(rows["size"][order].astype(np.int64))
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        done, stops = 0, np.append(first[1:], len(key))
        while done < len(key):
            base = total[done - 1] if done else 0
            fits = stops[(stops > done) & (total[stops - 1] <= base + GROUP)]
            last = int(fits[-1]) if len(fits) else int(stops[stops > done][0])
            own = order[done:last]
            found.append(repeated(rows[own], np.concatenate([data[at[i] : at[i + 1]] for i in own])))
            done = last
    if single:
        rows = np.concatenate(single)
        rows = rows[np.lexsort((rows["start"], rows["doc"], rows["key"]))]
        rows = rows[1:][rows["key"][1:] == rows["key"][:-1]]
        found.append(np.stack([rows["doc"], rows["start"].astype(np.int64)], 1))
    if found:
        windows = np.concatenate(found)
        doc, start, stop = _merged(windows[:, 0], windows[:, 1], windows[:, 1] + MATCH)
        yield _found(SPAN, doc * 0, doc, start, stop)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        data, offsets = blocks.text_bytes(batch.column(1))
        spans = batch.column(2).to_pylist()
        out = [[], [], [], []]
        for i, own in enumerate(spans):
            text = data[offsets[i] : offsets[i + 1]]
            removed = runs = 0
            if own:
                pairs = np.array([(s["start"], s["stop"]) for s in own], np.int64)
                _, start, stop = _merged(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
                gone = np.zeros(len(text) + 1, np.int8)
                gone[start] += 1
                gone[stop] -= 1
                keep = np.cumsum(gone[:-1], dtype=np.int8) == 0
                removed, runs = int((stop - start).sum()), len(start)
                left = text[keep]
            else:
                left = text
            values = (len(text), removed, runs, hashlib.sha256(left.tobytes()).hexdigest())
            for column, value in zip(out, values, strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [ids, *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_spans(docs: DataFrame, buckets: int = BUCKETS, crowd: int = CROWD) -> DataFrame:
    """``doc_id, start, stop``: byte spans that repeat earlier ones; they may overlap."""
    spark = docs.sparkSession
    parts = partitions(spark)
    buckets = max(buckets, 4 * parts)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    met = staged(
        docs.mapInArrow(_anchored(buckets), _PACKED)
        .repartition(parts, "bucket")
        .mapInArrow(lambda batches: _meet(batches, crowd), _FOUND),
        "suffix-anchors",
    )
    wanted = (
        met.filter(F.col("kind") != SPAN)
        .groupBy("doc")
        .agg(F.collect_list(F.struct("kind", "key", "start", "stop")).alias("wanted"))
    )
    merged = (
        docs.join(wanted, F.col("doc_id") == F.col("doc"))
        .select("doc_id", "text", "wanted")
        .mapInArrow(_texts(buckets), _PACKED)
        .repartition(parts, "bucket")
        .mapInArrow(_repeats, _FOUND)
    )
    spans = met.filter(F.col("kind") == SPAN).union(staged(merged, "suffix-merged"))
    return spans.select(F.col("doc").alias("doc_id"), "start", "stop")


def without_repeats(docs: DataFrame, buckets: int = BUCKETS, crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` (distinct, not null) and ``text``; other columns are not read.
    Texts are UTF-8 bytes, a null is empty; matches never cross documents.  A text
    shorter than ``MATCH`` bytes loses nothing.  Strings are judged on the input: of equal
    documents the smallest stays whole.  An empty table gives no rows.
    """
    spans = (
        repeated_spans(docs, buckets, crowd)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
        .withColumnRenamed("doc_id", "__doc")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (
        rows.join(spans, F.col("doc_id") == F.col("__doc"), "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )

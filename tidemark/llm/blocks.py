"""Texts of an Arrow batch as byte arrays, and word and shingle hashes over them.

Everything works on whole texts.  A batch is cut between documents into chunks of
about a megabyte, so that the temporary arrays stay small; only a document longer
than that makes a chunk of its own size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)
SALTS = np.random.default_rng(20240301).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of the rolling hash, and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            both.append(np.multiply.accumulate(row))
        _powers = tuple(both)
    return _powers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and its offsets; a null is an empty text."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first, last, bytes, offsets`` of runs of documents of about ``size`` bytes."""
    if not len(column):
        return
    data, offsets = text_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(last, first + 1))
        own = offsets[first : last + 1]
        yield first, last, data[own[0] : own[-1]], own - own[0]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """``hash, document, start, end`` of the words of a chunk, in reading order."""
    if lower:
        data = _LOWER[data]
    inside = ~_SPACES[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))
    owner = np.searchsorted(offsets, begins, "right") - 1
    return hashes, owner, begins, ends


def shingles(hashes: np.ndarray, owner: np.ndarray, documents: int, width: int):
    """``hash, document`` of every run of ``width`` words; shorter texts give one."""
    n = len(hashes)
    counts = np.bincount(owner, minlength=documents)
    firsts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    m = max(0, n - width + 1)
    whole = owner[:m] == owner[n - m :]
    out = np.zeros(m, np.uint64)
    for k in range(width):
        out += hashes[k : k + m] * SALTS[k]
    found, of = [mix(out[whole])], [owner[:m][whole]]
    for k in range(1, width):
        short = np.flatnonzero(counts == k)
        total = np.full(len(short), SALTS[40 + k], np.uint64)
        for j in range(k):
            total += hashes[firsts[short] + j] * SALTS[20 + j]
        found.append(mix(total))
        of.append(short)
    found, of = np.concatenate(found), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return found[order], of[order]


def sets(hashes: np.ndarray, owner: np.ndarray, documents: int):
    """Distinct hashes of each document, sorted, and where each document begins."""
    bounds = np.searchsorted(owner, np.arange(documents + 1))
    hashes = hashes.copy()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, owner, np.searchsorted(owner, np.arange(documents + 1))


def grouped_sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit values by group, modulo 2**64; exact up to 2**20 values a group."""
    low = np.bincount(groups, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    high = np.bincount(groups, (values >> np.uint64(32)).astype(np.float64), n)
    high = np.fmod(high, 4294967296.0)
    return low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))

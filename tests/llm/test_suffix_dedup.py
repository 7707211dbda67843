"""Removed bytes against a scan over all 100-byte strings."""

import hashlib
import random

import numpy as np
import pytest
from tidemark.llm import suffix_dedup as sd


def brute_force(rows):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - sd.MATCH + 1):
            window = data[at : at + sd.MATCH]
            if window in seen:
                gone[at : at + sd.MATCH] = b"\1" * sd.MATCH
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def run(df, **more):
    rows = sd.without_repeats(df, **more).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}


def copies(seed=5):
    rng = random.Random(seed)
    words = [f"wörd{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 500), (6, "ab" * 400), (7, "x" * 100)]
    common, base, at = text(30), text(120), 20
    for k in range(60):
        kind = k % 4
        if kind == 0:
            own = base.split()
            for _ in range(k % 9):
                own[rng.randrange(len(own))] = rng.choice(words)
            body = " ".join(own)
        elif kind == 1:
            body = text(20) + " " + common + " " + text(15)
        elif kind == 2:
            body = base if k % 8 else text(200)
        else:
            body = text(25) + "\0" + rng.choice(words) * 30
        rows.append((at, body))
        at += 1
    return rows


def test_given_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert run(documents) == brute_force(rows)


@pytest.mark.parametrize("crowd", [sd.CROWD, 3])
def test_copies_periods_and_odd_texts(frame, crowd):
    rows = copies()
    assert run(frame(rows), crowd=crowd) == brute_force(rows)


def test_empty_table_and_more_columns(frame):
    assert run(frame([])) == {}
    df = frame([(1, "y" * 200, 1, 1)], ", start int, n_bytes int")
    assert run(df) == brute_force([(1, "y" * 200)])


@pytest.mark.parametrize("shard", [150, 700, 1 << 18])
def test_merged_transforms_find_repeats(shard):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 3, 400).astype(np.uint8)
    strings = [base[k : k + 100 + int(rng.integers(0, 60))].copy() for k in rng.integers(0, 200, 40)]
    for s in strings[::3]:
        s[len(s) // 2] = 255
    rows = np.zeros(len(strings), sd._PLACE)
    rows["doc"], rows["size"] = np.arange(len(strings)), [len(s) for s in strings]
    found = {tuple(x) for x in sd.repeated(rows, np.concatenate(strings), shard).tolist()}
    seen, expected = set(), set()
    for doc, s in enumerate(strings):
        for at in range(len(s) - sd.MATCH + 1):
            window = s[at : at + sd.MATCH].tobytes()
            if window in seen:
                expected.add((doc, at))
            seen.add(window)
    assert found == expected

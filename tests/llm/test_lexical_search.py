"""Ranked search against scoring every document for every question."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lexical_search as search

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return TERM.findall(text.translate(LOWER)) if text else []


def brute_force(docs, items, top=20):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // length
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, empty, doc) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if empty else doc, -score))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed=3, n=400):
    draws = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(draws.choices(words, weights, k=draws.randint(1, 40)))) for i in range(n)]
    items = [(i, " ".join(draws.choices(words, weights, k=draws.randint(1, 8)))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("block, segment, item_block", [(16, 4096, 2000), (2, 30, 2000), (4, 50, 7)])
def test_against_brute_force(spark, monkeypatch, block, segment, item_block):
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "SEGMENT", segment)
    docs, items = corpus()
    # a third of the documents are the same text, which ties every one of them
    docs += [(1000 + i, "w0 w1 w59 common") for i in range(200)]
    items += [(100, "w59 common"), (101, "common common W0"), (102, "unheard"), (103, "")]
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    got = search.search(df, spark.createDataFrame(items, ITEMS), item_block=item_block)
    assert found(got) == brute_force(docs, items)


def test_whole_tables_against_brute_force(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    wanted = brute_force(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 5
    )
    assert found(search.search(docs, items, top=5)) == wanted


def test_nulls_ties_repeated_rows_and_clashing_columns(spark):
    docs = [(5, "Äpfel und BIRNEN"), (5, "Äpfel und BIRNEN"), (None, "äpfel birnen"), (2, None), (3, ""), (4, "  \t"),
            (6, "birnen " * 50_000 + "x"), (7, "Äpfel, und-birnen!"), (8, "nothing here")]
    items = [(1, "Äpfel birnen"), (1, "Äpfel birnen"), (None, "birnen"), (9, None)]
    df = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit("mine") for c in ("row", "doc", "n", "terms", "score", "item")})
    asked = spark.createDataFrame(items, ITEMS).withColumn("rank", F.lit("mine"))
    assert found(search.search(df, asked)) == brute_force(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, None)]), ([(1, "b")], [(1, "a")])])
def test_nothing_to_find(spark, docs, items):
    got = search.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_summaries_bound_their_blocks_and_spare_visits():
    draws = np.random.default_rng(1)
    asked = search.questions([(j, " ".join(f"t{t}" for t in draws.choice(40, 6))) for j in range(10)])
    size = len(asked.vocabulary)
    asked.weights = draws.integers(1, 3000, size)
    rows = np.arange(600)
    groups = rows % 6  # similar documents lie apart
    own = [np.unique(np.concatenate([draws.choice(size, 3), np.arange(g * 5, g * 5 + 5) % size])) for g in groups]
    impacts = [draws.integers(1, 400_000, len(o)) for o in own]
    bounds = np.concatenate([[0], np.cumsum([len(o) for o in own])])
    part = search.Stretch(rows, rows, bounds, np.concatenate(own), np.concatenate(impacts))
    largest = np.zeros(size, np.int64)
    np.maximum.at(largest, part.terms, part.impacts)
    asked.floors = np.zeros(10, np.int64)
    walked = search.walks(asked, largest)
    searcher = search.Searcher(walked, asked.weights, asked.floors, 5)
    stored = search.packed(part, walked, size)
    again, lists = search.unpacked({k: np.frombuffer(v.tobytes(), search._BLOCK_KINDS[k]) for k, v in stored.items()}, walked)
    assert {b.term for b in lists} == set(walked)
    for blocks in lists:
        assert np.diff(blocks.bounds).max() <= search.BLOCK
        holding = np.unique(part.owners()[part.terms == blocks.term])
        assert sorted(blocks.members.tolist()) == holding.tolist()
        vectors = again.matrix(size)[np.ix_(blocks.members, walked[blocks.term].coordinates)]
        for b, maxima in enumerate(blocks.maxima):
            assert (vectors[blocks.bounds[b] : blocks.bounds[b + 1]].max(0) == maxima).all()
    searcher.search(again, lists)
    assert searcher.skipped > 0.4 * (searcher.skipped + searcher.opened)
    weight = np.zeros((10, size), np.int64)
    for j in range(10):
        terms_j, factor = asked.weighed(j)
        weight[j, terms_j] = factor
    dense = np.zeros((600, size), np.int64)
    dense[part.owners(), part.terms] = part.impacts
    scores = dense @ weight.T
    for j in range(10):
        best = sorted(((-int(s), i) for i, s in enumerate(scores[:, j]) if s > 0))[:5]
        assert sorted((-s, -d) for s, d, _ in searcher.best.heaps[j]) == best

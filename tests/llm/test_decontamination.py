"""Decontamination: exact windows, proximity, odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F
from tidemark.llm import decontamination as dc

ITEM = " ".join(f"term{i}" for i in range(14))


@pytest.fixture
def bench(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id long, text string")

    return make


def run(docs, benchmark, **more):
    return {r.doc_id: r for r in dc.contamination(docs, benchmark, **more).collect()}


def test_phrases_short_items_and_case(frame, bench):
    words = ITEM.split()
    rows = [
        (1, "intro " + ITEM.upper() + ", outro"),
        (2, " ".join(words[:9])),
        (3, " ".join(words[2:12]) + " x " + " ".join(words[3:13])),
        (4, "a short item here"),
        (5, "É short"),
        (6, "é short"),
        (7, None),
        (8, ""),
        (9, ("filler words " * 4000) + ITEM),
        (10, " ".join(w for w in words[:10] for w in (w, "gap"))),
    ]
    items = [(1, ITEM), (2, "short item"), (3, None), (4, "!!"), (5, "é short"), (12, ITEM)]
    out = run(frame(rows), bench(items))
    hit = {k: (r.n_hit, r.n_items) for k, r in out.items()}
    assert hit == {
        1: (14, 2), 2: (0, 0), 3: (20, 2), 4: (2, 1), 5: (0, 0), 6: (2, 1), 7: (0, 0), 8: (0, 0),
        9: (14, 2), 10: (0, 0),
    }
    assert out[1].items_sha256 == hashlib.sha256(b"1,12").hexdigest()
    assert out[7].n_words == 0 and not out[7].contaminated
    assert [r.doc_id for r in dc.clean(frame(rows), bench(items)).orderBy("doc_id").collect()] == [2, 5, 7, 8, 10]


def test_proximity(frame, bench):
    text = ITEM.split()[:10]
    near = [*text[:5], "between", *text[5:]]
    out = run(frame([(1, " ".join(near)), (2, "nothing near")]), bench([(1, " ".join(text))]))
    assert not out[1].contaminated and out[1].n_near == 1 and out[2].n_near == 0


def test_empty_tables_and_clashing_columns(frame, bench):
    docs = frame([(1, "some words", 3, "z")], ", n_words int, term string")
    assert run(docs, bench([]))[1].n_words == 2
    assert run(frame([]), bench([(1, ITEM)])) == {}
    assert dc.clean(docs, bench([(1, ITEM)])).columns == docs.columns


def test_native_plan(frame, bench, plan):
    text = plan(dc.contamination(frame([(1, ITEM)]), bench([(1, ITEM)])))
    assert not any(x in text for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
    assert F

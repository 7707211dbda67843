"""The pipeline stage by stage against brute force over its own input."""

from fractions import Fraction

import corpus_pipeline
from test_ngram_join import brute_force
from tidemark.llm import language_id
from tidemark.session import staged


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(staged(stage(spark, frames[-1], sf_dir), "stage-test"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frames[-1].columns == columns
    start, spoken, lines, single, clean, packed = ([tuple(r) for r in f.collect()] for f in frames)

    model = language_id.fit(docs).compressors()
    assert {r[0] for r in spoken} == {
        r[0] for r in start if (f := language_id.classify(r[1], model))[0] != "und" and f[2] >= language_id.NARROW
    }
    seen, left = set(), {}
    for doc, text, *_ in sorted(spoken):
        rows = text.split("\n")
        marked = [(k, x.strip(" \t\v\f\r")) for k, x in enumerate(rows) if x.strip(" \t\n\v\f\r")]
        gone = set()
        for three in zip(marked, marked[1:], marked[2:]):
            key = tuple(x for _, x in three)
            if key in seen:
                gone |= set(range(three[0][0], three[2][0] + 1))
            seen.add(key)
        rest = "\n".join(x for k, x in enumerate(rows) if k not in gone)
        if not gone or rest.strip():
            left[doc] = rest
    assert {r[0]: r[1] for r in lines} == left
    assert all(r[columns.index("n_chars")] == len(r[1]) for r in lines)
    groups = brute_force(list(left.items()), 5, Fraction(4, 5))
    assert {r[0] for r in single} == {d for d, (_, c) in groups.items() if d == c}
    assert {r[0] for r in clean} < {r[0] for r in single}
    assert {r[0] for r in packed} == {r[0] for r in clean}


def test_run_and_empty_table(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage-test")
    assert docs.count() == 0

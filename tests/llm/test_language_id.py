"""Language ID: held-out accuracy and odd texts."""

import random

import pytest
from pyspark.sql import functions as F
from tidemark.llm import language_id as li


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, li.fit(docs)


def test_held_out_accuracy(learned):
    docs, model = learned
    found = li.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right >= 0.95 * n


def test_learns_outside_the_fold_only(learned, frame):
    docs, model = learned
    again = li.fit(docs.withColumn("lang", F.when(li.fold() == 0, "xx").otherwise(F.col("lang"))))
    assert again == model


def test_odd_texts(learned, frame):
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (4, "the and of the and of that this with for")]
    rows += [(5, "the and of " * 60_000), (6, "½ ²")]
    out = {r.doc_id: r for r in li.predict(frame(rows), learned[1]).collect()}
    for k in (1, 2, 3, 6):
        assert (out[k].lang_pred, out[k].score, out[k].accepted) == ("und", 0.0, False)
    assert out[4].lang_pred == "en" and out[5].lang_pred == "en" and 0 < out[4].score <= 1


def test_empty_and_without_languages(frame):
    empty = frame([], ", lang string")
    model = li.fit(empty)
    assert model.dictionaries == {} and li.predict(empty, model).count() == 0
    assert [r.lang_pred for r in li.predict(frame([(1, "words")]), model).collect()] == ["und"]


TEXT = "the and of that with is was for by from it this are have he she be on at or as"


def test_accepted_keeps_rows_whole(learned, frame):
    df = frame([(1, TEXT, 7, 0.5), (2, None, 8, 0.5)], ", margin int, score double")
    kept = li.accepted(df, learned[1])
    assert kept.schema == df.schema and [tuple(r) for r in kept.collect()] == [(1, TEXT, 7, 0.5)]


def test_long_texts_without_a_clear_language(learned, frame):
    docs, model = learned
    rng = random.Random(3)
    noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(100_000))
    held = {r.lang: r.t for r in docs.filter(li.fold() == 0).groupBy("lang").agg(F.array_join(F.sort_array(F.collect_list("text")), " ").alias("t")).collect()}
    langs = sorted(k for k in held if k)
    size = min(len(held[k]) for k in langs)
    rows = [(0, noise)] + [(k + 1, held[lang][:size]) for k, lang in enumerate(langs)]
    out = {r.doc_id: r for r in li.predict(frame(rows), model).collect()}
    assert not out[0].accepted and out[0].margin >= li.NARROW
    assert all(out[k + 1].accepted and out[k + 1].lang_pred == lang for k, lang in enumerate(langs))
    # a language that was not learned
    less = li.fit(docs.filter("lang != 'fr'"))
    found = li.predict(frame([(1, held["fr"])]), less).first()
    assert found.margin >= li.NARROW and not found.accepted


def test_clean_texts_stay(learned):
    docs, model = learned
    found = li.predict(docs, model)
    assert model.narrow > 0.01 and found.filter("margin > 0 and not accepted").count() == 0

"""Toxicity by class-conditional Kneser-Ney models.

Two models give the probability of each letter of a word after the ``HISTORY`` letters
before it, the mark of the word's start being one of them: one model of toxic and one of
ordinary texts.  The window slides over the whole word.  Both discount their counts
and give the rest to one shared model of both classes, which is discounted in turn and
backs off to shorter histories by how many different words hold them.  Rare expressions
therefore weigh alike in both, and stems count as well as whole words.  The
discounts of each order follow from its counts of counts.  A word counts once for a text
that holds it.  The score of a text is the mean log-likelihood ratio of its words,
brought to a probability by a logistic fit; ratios within a neutral band say nothing about
a word and count as 0, larger ones count for what is beyond.  The band is one of
``BANDS``, chosen with the logistic fit.

The ratio of a word is a sum over those of its windows that were seen: what the letter is worth
after its history, and what a letter never seen would be worth next, until another window
takes its place.  Entries are whole numbers, so every order of adding gives the same
score, and the model can be joined as well as shipped: it is shipped to the tasks if it
measures small.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.inputs import fold
from tidemark.operators.joins import broadcast_if_small
from tidemark.session import remove_folder, staged, work_path

HISTORY = 10  # letters before a letter that it depends on
SHORTER = (3, 1)  # histories that the shared model backs off to, then to none
START, END = "\x02", "\x03"
HEAVY = 1e-3  # share of the distinct words that makes an entry one of many words
COMMON = 1e-5  # share of all words in texts that makes a word a frequent one
SHIPPED = 6_000_000  # entries (16 bytes each) up to which the model is sent to the tasks
UNIT = 1e-9  # of the values of words
CALIBRATION_FOLD = 4
CALIBRATION_ROWS = 20_000  # texts of that fold that the logistic fit may use
NEUTRAL = 1.5
BANDS = (1.5, 2.5, 3.5)  # of these the one that the calibration texts are likeliest under
PRIOR_WORDS = 5.0  # neutral words that every text is taken to have

_WORD = re.compile(r"[^\W\d_]+")


def _windows() -> Column:
    """Every letter of ``word`` and its end, each with the history before it."""
    marked = F.concat(F.lit(START), "word", F.lit(END))
    places = F.sequence(F.lit(2), F.length(marked))
    return F.transform(
        places,
        lambda i: F.substring(marked, F.greatest(F.lit(1), i - HISTORY), F.least(i, F.lit(HISTORY + 1))),
    )


def _history(node: str = "node") -> Column:
    return F.expr(f"left({node}, length({node}) - 1)")


def _entry(window: Column | str) -> Column:
    """The number under which a window is found."""
    return F.xxhash64(window)


def entries_of(word: str) -> list[int]:
    """``_entry`` of all windows of a word, as Spark computes them."""
    marked = (START + word + END).encode()
    bounds = [i for i, b in enumerate(marked) if b & 0xC0 != 0x80] + [len(marked)]
    return [
        xxhash.xxh64_intdigest(marked[bounds[max(0, i - HISTORY)] : bounds[i + 1]], seed=42)
        for i in range(1, len(bounds) - 1)
    ]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that hold each word, by class; added up over a batch before they are exchanged."""
    for batch in batches:
        totals: list[Counter] = [Counter(), Counter()]
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            totals[toxic].update(set(_WORD.findall((text or "").lower())))
        keys = list(totals[0].keys() | totals[1].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.string()),
                pa.array([totals[0][k] for k in keys], pa.int64()),
                pa.array([totals[1][k] for k in keys], pa.int64()),
            ],
            names=["word", "ordinary", "toxic"],
        )


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a batch that hold each word."""
    for batch in batches:
        found: Counter = Counter()
        for text in batch.column(0).to_pylist():
            found.update(set(_WORD.findall((text or "").lower())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"]
        )


@dataclass(frozen=True)
class Model:
    """The entries (a staged table of any size) and the logistic fit.

    ``entries`` has ``entry, value, heavy``: a whole number of ``UNIT``, and whether many words
    have the entry.  ``base`` is what every word begins with.  Without labels of both classes
    there are no entries.
    """

    entries: DataFrame | None
    base: int = 0
    weight: float = 1.0
    bias: float = 0.0
    neutral: float = NEUTRAL
    table: Broadcast | None = None  # the entries, if they measure small


def discounts(once: int, twice: int, thrice: int, four: int) -> tuple[float, float, float]:
    """What counts of one, two and more are lowered by, from how many things have each count.

    Where too little was counted for that, half a count is taken for each.
    """
    if not (once and twice and thrice):
        return 0.5, 1.0, 1.5
    y = once / (once + 2 * twice)
    raw = (1 - 2 * y * twice / once, 2 - 3 * y * thrice / twice, 3 - 4 * y * four / thrice)
    return tuple(min(max(d, 0.1), i - 0.1) for i, d in enumerate(raw, 1))


def _counted(count: Column, name: str) -> list[Column]:
    return [F.count_if(count == i).alias(f"{name}{i}") for i in (1, 2, 3, 4)]


def _lowered(count: Column, by: tuple[float, float, float]) -> Column:
    return F.when(count == 0, 0.0).when(count == 1, by[0]).when(count == 2, by[1]).otherwise(by[2])


def _backed_off(counts: DataFrame) -> DataFrame:
    """``node, p`` of the shared model at the longest of ``SHORTER``, from ``node, words``.

    ``words`` is how many different words hold a window.  An order has at most as many rows as
    there are strings of its length.
    """
    below = counts.groupBy(F.right("node", F.lit(1)).alias("node")).agg(F.sum("words").alias("words"))
    whole = below.agg(F.sum("words")).first()[0]
    below = below.select("node", (F.col("words") / whole).alias("p"))
    for width in sorted(SHORTER):
        order = counts.groupBy(F.right("node", F.lit(width + 1)).alias("node")).agg(F.sum("words").alias("words"))
        order = order.withColumn("history", _history())
        seen = order.agg(*_counted(F.col("words"), "n")).first()
        by = discounts(*seen)
        n = F.col("words")
        above = order.groupBy("history").agg(F.sum(n).alias("all"), F.sum(_lowered(n, by)).alias("rest"))
        joined = order.join(above, "history").withColumn("shorter", F.right("node", F.lit(1 if width == min(SHORTER) else min(SHORTER) + 1)))
        down = broadcast_if_small(staged(below, "toxicity-order").select(F.col("node").alias("shorter"), "p"))
        p = (n - _lowered(n, by)) / F.col("all") + F.col("rest") / F.col("all") * F.col("p")
        below = joined.join(down, "shorter").select("node", p.alias("p"))
    return below


def fit_counts(rows: DataFrame) -> Model:
    """The two models from ``text, toxic``; counts are taken over all rows."""
    spark = rows.sparkSession
    scratch = work_path(spark, "toxicity-counts")
    words = rows.mapInArrow(_count, "word string, ordinary long, toxic long")
    words = words.groupBy("word").agg(F.sum("ordinary").alias("o"), F.sum("toxic").alias("t"))
    nodes = (
        words.select(F.explode(_windows()).alias("node"), "o", "t")
        .groupBy("node")
        .agg(F.sum("o").alias("o"), F.sum("t").alias("t"), F.count("*").alias("words"))
        .withColumn("history", _history())
    )
    nodes.write.parquet(scratch)
    nodes = spark.read.schema(nodes.schema).parquet(scratch)
    o, t, both = F.col("o"), F.col("t"), F.col("o") + F.col("t")
    seen = nodes.agg(
        F.sum("o").alias("o"), F.sum("t").alias("t"),
        F.sum(F.when(F.col("history") == START, F.col("words"))).alias("words"),
        *_counted(o, "o"), *_counted(t, "t"), *_counted(both, "s"),
    ).first()
    if not seen["o"] or not seen["t"]:
        remove_folder(spark, scratch)
        return Model(None)
    by = {c: discounts(*[seen[f"{c}{i}"] for i in (1, 2, 3, 4)]) for c in "ots"}
    above = nodes.groupBy("history").agg(
        F.sum("o").alias("po"), F.sum("t").alias("pt"), F.sum("words").alias("held"),
        *[F.sum(_lowered(n, by[c])).alias(f"r{c}") for c, n in (("o", o), ("t", t), ("s", both))],
    )
    width = max(SHORTER) + 1
    lower = broadcast_if_small(staged(_backed_off(nodes), "toxicity-order").withColumnRenamed("node", "shorter"), 64, 2_000_000)
    ps = F.col("po") + F.col("pt")
    shared = (both - _lowered(both, by["s"])) / ps + F.col("rs") / ps * F.col("p")

    def rest(c: str) -> Column:
        """What a class gives to the shared model after a history."""
        return F.when(F.col(f"p{c}") > 0, F.col(f"r{c}") / F.col(f"p{c}")).otherwise(1.0)

    def given(c: str) -> Column:
        own = (F.col(c) - _lowered(F.col(c), by[c])) / F.col(f"p{c}")
        return F.when(F.col(f"p{c}") > 0, own).otherwise(0.0) + rest(c) * shared

    unseen = F.log(rest("t") / rest("o"))
    heavy = F.lit(HEAVY * (seen["words"] or 0))
    letters = nodes.join(above, "history").withColumn("shorter", F.right("node", F.lit(width))).join(lower, "shorter")
    worth = above.select("history", unseen.alias("after"))
    following = worth.select(F.col("history").alias("next"), F.col("after").alias("then"))
    letters = letters.withColumn("next", F.right("node", F.lit(HISTORY))).join(following, "next", "left")
    value = F.log(given("t") / given("o")) - unseen + F.coalesce("then", F.lit(0.0))
    entries = letters.select(
        _entry("node").alias("entry"), F.round(value / UNIT).cast("long").alias("value"), (F.col("words") >= heavy).alias("heavy")
    )
    kept = staged(entries.where("value <> 0"), "toxicity-entries")
    base = round(worth.where(F.col("history") == START).first()["after"] / UNIT)
    remove_folder(spark, scratch)
    return Model(kept, base, table=_table(kept))


def _beyond(ratio: int, neutral: int) -> int:
    """What of a word's ratio is more than neutral, in whole numbers of ``UNIT``."""
    return ratio - neutral if ratio > neutral else ratio + neutral if ratio < -neutral else 0


def evidence(words: DataFrame, model: Model) -> DataFrame:
    """``word, n, value`` for distinct ``word, n``: the ratio beyond what is neutral; words of 0 are left out.

    Entries of many words are joined by a broadcast, as few can be that.
    """
    parts = words.select("word", "n", F.explode(F.transform(_windows(), _entry)).alias("entry"))
    heavy = F.broadcast(model.entries.filter("heavy").drop("heavy"))  # (letters of a long word) / HEAVY rows at most
    others = model.entries.filter("not heavy").drop("heavy")
    found = parts.join(heavy, "entry").unionByName(parts.join(heavy, "entry", "left_anti").join(others, "entry"))
    found = found.drop("entry")
    found = found.unionByName(words.select("word", "n", F.lit(model.base).cast("long").alias("value")))
    ratio = found.select("word", "n", "value").groupBy("word", "n").agg(F.sum("value").alias("ratio"))
    neutral = F.lit(round(model.neutral / UNIT))
    beyond = F.signum("ratio").cast("long") * F.greatest(F.abs("ratio") - neutral, F.lit(0))
    return ratio.select("word", "n", beyond.alias("value")).filter("value <> 0")


def _table(entries: DataFrame) -> Broadcast | None:
    """Sorted entries and their values for every task, unless there are more than ``SHIPPED``."""
    if not 0 < entries.count() <= SHIPPED:
        return None
    table = entries.select("entry", "value").toArrow()
    entry, value = table["entry"].to_numpy().view(np.uint64), table["value"].to_numpy()
    order = np.argsort(entry)
    return entries.sparkSession.sparkContext.broadcast((entry[order], value[order]))


def _shipped(docs: DataFrame, model: Model, columns: list[str], bands: tuple[float, ...]) -> DataFrame:
    """``_ratios`` with the whole model in every task: one pass over the texts for all bands."""
    kept, base, neutral = model.table, model.base, [round(b / UNIT) for b in bands]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, values = kept.value
        known: list[dict[str, int]] = [{} for _ in neutral]

        def learn(words: list[str]) -> None:
            listed = [entries_of(w) for w in words]
            sizes = np.array([len(x) for x in listed])
            flat = np.array([e for x in listed for e in x], np.uint64)
            place = np.minimum(np.searchsorted(entries, flat), len(entries) - 1)
            found = np.where(entries[place] == flat, values[place], 0)
            totals = np.add.reduceat(found, np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            for values_of, band in zip(known, neutral, strict=True):
                values_of.update((w, _beyond(base + v, band)) for w, v in zip(words, totals.tolist(), strict=True))

        for batch in batches:
            ratios = []
            for text in batch.column(0).to_pylist():
                words = _WORD.findall(text.lower()) if text else []
                new = [w for w in dict.fromkeys(words) if w not in known[0]]
                for at in range(0, len(new), 20_000):
                    learn(new[at : at + 20_000])
                ratios.append([sum(map(of.__getitem__, words)) * UNIT / (len(words) + PRIOR_WORDS) for of in known])
                if len(known[0]) > 500_000:  # what was looked up can be looked up again
                    for of in known:
                        of.clear()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(ratios, pa.list_(pa.float64()))], names=[*batch.schema.names[1:], "ratios"]
            )

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select("text", *columns).mapInArrow(run, schema + ", ratios array<double>")


def _ratios(docs: DataFrame, model: Model, columns: list[str], bands: tuple[float, ...]) -> DataFrame:
    """``columns, ratios``: per band, the mean log ratio of the words of each whole text."""
    if model.entries is None:
        return docs.select(*columns, F.array(*[F.lit(0.0) for _ in bands]).alias("ratios"))
    if model.table is not None:
        return _shipped(docs, model, columns, bands)
    docs = docs.select("text", *columns, F.monotonically_increasing_id().alias("row"))
    found = None
    for k, band in enumerate(bands):
        one = _joined(docs, replace(model, neutral=band), [*columns, "row"]).withColumnRenamed("ratio", f"ratio{k}")
        found = one if found is None else found.join(one.select("row", f"ratio{k}"), "row")
    return found.select(*columns, F.array(*[f"ratio{k}" for k in range(len(bands))]).alias("ratios"))


def _joined(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns, ratio`` with a model of any size: its entries are joined with the distinct words.

    ``columns`` end with ``row``, which is unique.

    Frequent words are looked up where the texts lie; the others, of which none is
    frequent, are joined with their values and summed per row.
    """
    words = staged(
        docs.select("text").mapInArrow(_vocabulary, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "toxicity-words",
    )
    total = words.agg(F.sum("n")).first()[0] or 0
    values = staged(evidence(words, model), "toxicity-evidence")
    frequent = F.col("n") >= COMMON * total
    common = words.filter(frequent).join(values.drop("n"), "word", "left").fillna(0, ["value"]).toPandas()  # 1 / COMMON rows at most
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(common["word"], common["value"].tolist(), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            own, sizes, names, times = [], [], [], []
            for text in batch.column(0).to_pylist():
                found = _WORD.findall(text.lower()) if text else []
                got = list(map(known.get, found))
                rare = Counter(w for w, v in zip(found, got, strict=True) if v is None)
                own.append(int(sum(filter(None, got))))
                sizes.append(len(found))
                names.append(list(rare))
                times.append(list(rare.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array(own, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.list_(pa.string())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                names=[*batch.schema.names[1:], "own", "size", "rare", "times"],
            )

    keyed = docs.select("text", *columns)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    schema += ", own long, size long, rare array<string>, times array<long>"
    texts = staged(keyed.mapInArrow(run, schema), "toxicity-texts")
    rare = (
        texts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x"))
        .select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
        .join(values.filter(~frequent).select("word", "value"), "word")
        .groupBy("row")
        .agg(F.sum(F.col("value") * F.col("times")).alias("more"))
    )
    total = F.col("own") + F.coalesce("more", F.lit(0))
    return texts.join(rare, "row", "left").select(*columns, (total * UNIT / (F.col("size") + PRIOR_WORDS)).alias("ratio"))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Weight and bias of a slightly regularised logistic fit, by Newton steps."""
    scale = x.std() or 1.0
    a = np.stack([x / scale, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) + 0.05 * w * [1, 0]
        curve = (a * (p * (1 - p))[:, None]).T @ a + np.diag([0.05, 1e-9])
        move = np.linalg.solve(curve, slope)
        w -= np.clip(move, -5, 5)
        if abs(move).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Models and calibration from labelled texts outside the held-out fold.

    Of one fold ``CALIBRATION_ROWS`` texts at most, those with the smallest hashes of
    their ids, are kept for the logistic fit, so that the models have not seen them;
    counts come from all the others.
    """
    marks = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = staged(marks.filter(fold() != 0), "toxicity-labels")
    texts = docs.select("doc_id", "text")
    chosen = staged(
        marks.filter(fold() == CALIBRATION_FOLD)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(CALIBRATION_ROWS),
        "toxicity-calibration",
    )
    learned = broadcast_if_small(marks.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti"))
    model = fit_counts(texts.join(learned, "doc_id").select("text", "toxic"))
    best = None
    seen = _ratios(texts.join(F.broadcast(chosen), "doc_id"), model, ["doc_id", "toxic"], BANDS).toPandas()
    seen = seen.sort_values(["doc_id", "toxic"], kind="stable")  # the fit adds up in one order
    y = seen["toxic"].to_numpy(float)
    for k, band in enumerate(BANDS if len(set(y)) == 2 else ()):
        x = np.array([r[k] for r in seen["ratios"]])
        weight, bias = _logistic(x, y)
        p = 1 / (1 + np.exp(-np.clip(x * weight + bias, -30, 30)))
        loss = -np.mean(np.log(np.where(y == 1, p, 1 - p)))
        if best is None or loss < best[0]:
            best = loss, replace(model, neutral=band, weight=weight, bias=bias)
    return best[1] if best else replace(model, weight=10.0, bias=-1.0)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted, ratio`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read.  A null or empty text
    has the ratio 0 and the score that goes with it; repeated rows are scored alike.
    Without labels of both classes all ratios are 0.  An empty table gives no rows.
    """
    marked = docs.select("doc_id", "text", (fold() == 0).alias("held_out"))
    found = _ratios(marked, model, ["doc_id", "held_out"], (model.neutral,))
    found = found.select("doc_id", "held_out", F.col("ratios")[0].alias("ratio"))
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("ratio") * model.weight + model.bias))))
    return found.withColumn("score", score).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "ratio"
    )

"""Quality rules learned as a decision list.

Statistics of a text are compared with thresholds.  Sequential covering learns which
conjunctions of such comparisons mark rejected texts: a rule grows by the condition of
the highest information gain, is pruned on rows that it was not grown on, and is kept
if nearly all rows that it covers there are rejected ones; the rows it covers are set
aside and the next rule is grown.  The list is emitted as an ordered CASE expression.

DataFrame operations only: every step of the learning is one aggregation over all
labelled statistics, of which the driver sees counts per statistic and threshold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.inputs import fold, split_words
from tidemark.session import staged

MIN_WORDS = 50
SYMBOLS = "[#*$%&|<>]"
CUTS = 32  # steps between quantiles of a statistic; thresholds lie half-way between them
MAX_CONDITIONS = 3
PRECISION = 0.95  # rejected share among the pruning rows that a rule covers
SUPPORT = 5  # rejected pruning rows that a rule covers at least
PRUNE_FOLD = 4

_HAS_WORD = "[^\\x20\\x09-\\x0D]"


def _removed(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and counts over the whole text of every row; a null text is empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        "doc_id",
        split_words(text).alias("w"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(_HAS_WORD)).alias("lines"),
        _removed(text, SYMBOLS).cast("long").alias("n_symbols"),
        _removed(text, "\\p{Lu}").cast("long").alias("n_capitals"),
        _removed(text, "[!?]").cast("long").alias("n_marks"),
    )
    starts = F.sequence(F.lit(0), F.size("w") - 3)
    window = F.transform(
        starts,
        lambda i: F.struct(
            F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")
        ),
    )
    # equal windows stand side by side after sorting
    base = base.withColumn("s", F.when(F.size("w") >= 3, F.sort_array(window)))
    repeated = F.transform(
        "s",
        lambda x, k: F.when(
            (F.get("s", k - 1)["h"] == x["h"]) | (F.get("s", k + 1)["h"] == x["h"]), x["i"]
        ),
    )
    base = base.withColumn("r", F.sort_array(F.filter(repeated, lambda i: i.isNotNull())))
    covered = F.aggregate(
        F.transform("r", lambda i, k: F.least(F.lit(3), F.coalesce(F.get("r", k + 1) - i, F.lit(3)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return base.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_capitals",
        "n_marks",
    )


def statistics() -> dict[str, Column]:
    """What a condition may compare, from ``counts``; doubles, never null."""

    def share(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.lit(1), F.col(b))

    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": share("word_chars", "n_words"),
        "symbols_a_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
        "capital_share": share("n_capitals", "word_chars"),
        "marks_a_word": share("n_marks", "n_words"),
        "words_a_line": share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = statistics()[self.statistic]
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    if not p:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


@dataclass(frozen=True)
class Candidate:
    """A condition with what it covers of the growing and of the pruning rows."""

    gain: float
    condition: Condition
    grown: tuple[int, int]
    pruned: tuple[int, int]


def _candidates(rows: DataFrame, cuts: dict[str, list[float]]) -> list[Candidate]:
    """Conditions by falling gain, from counts by statistic and threshold."""
    found = (
        rows.select(F.posexplode("bins").alias("k", "bin"), "bad", "prune")
        .groupBy("k", "bin", "prune")
        .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
        .collect()
    )
    out = []
    for k, (name, edges) in enumerate(cuts.items()):
        own = [[[0, 0] for _ in range(len(edges) + 1)] for _ in range(2)]
        for r in found:
            if r["k"] == k:
                own[r["prune"]][r["bin"]] = [r["p"], r["n"]]
        all_of = [tuple(sum(x[j] for x in part) for j in (0, 1)) for part in own]
        if not all(all_of[0]):
            continue
        below = [(0, 0), (0, 0)]
        for j, cut in enumerate(edges):
            below = [(x[0] + part[j][0], x[1] + part[j][1]) for x, part in zip(below, own, strict=True)]
            over = [(a[0] - x[0], a[1] - x[1]) for a, x in zip(all_of, below, strict=True)]
            for above, covered in ((False, below), (True, over)):
                gain = _gain(*covered[0], *all_of[0])
                if gain > 1e-9:
                    out.append(Candidate(gain, Condition(name, above, cut), *covered))
    return sorted(out, key=lambda c: -c.gain)


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Thresholds by statistic, half-way between neighbouring quantiles.

    Quantiles, the least and the largest value are those of the rejected and of the
    accepted growing rows, of all values and of those that are not 0.
    """
    quantiles = [i / CUTS for i in range(CUTS + 1)]
    kinds = [(F.col("bad") == bad, some) for bad in (0, 1) for some in (False, True)]
    wanted = [
        F.percentile_approx(F.when(kind & (v != 0 if some else F.lit(True)), v), quantiles, 10_000).alias(f"{k}_{j}")
        for k, v in statistics().items()
        for j, (kind, some) in enumerate(kinds)
    ]
    found = rows.filter(~F.col("prune")).agg(*wanted).first()
    out = {}
    for k in statistics():
        values = sorted({x for j in range(len(kinds)) for x in found[f"{k}_{j}"] or []})
        out[k] = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
    return out


def _binned(rows: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    def below(value: Column, own: list[float]) -> Column:
        if not own:
            return F.lit(0)
        return F.size(F.filter(F.array(*map(F.lit, own)), lambda c: c < value))

    return rows.withColumn("bins", F.array(*[below(v, cuts[k]) for k, v in statistics().items()]))


def _passes(p: int, n: int) -> bool:
    return p >= SUPPORT and p >= PRECISION * (p + n)


def _grown(rows: DataFrame, cuts: dict[str, list[float]], first: Candidate) -> Rule | None:
    """The rule that begins with a condition, grown and pruned; None if no front of it passes."""
    rule: Rule = (first.condition,)
    negatives = first.grown[1]
    while negatives and len(rule) < MAX_CONDITIONS:
        step = next(iter(_candidates(rows.filter(~F.col("prune") & holds(rule)), cuts)), None)
        if step is None:
            break
        rule, negatives = (*rule, step.condition), step.grown[1]
    fronts = [rule[: k + 1] for k in range(len(rule))]
    sums = [
        F.sum(F.when(holds(x), v).otherwise(0)).alias(f"{s}{k}")
        for k, x in enumerate(fronts)
        for s, v in (("p", F.col("bad")), ("n", 1 - F.col("bad")))
    ]
    seen = rows.filter("prune").agg(*sums).first()
    scored = [((seen[f"p{k}"] or 0), (seen[f"n{k}"] or 0), x) for k, x in enumerate(fronts)]
    good = [(p, x) for p, n, x in scored if _passes(p, n)]
    return max(good, key=lambda g: (g[0], -len(g[1])))[1] if good else None


def _next_rule(rows: DataFrame) -> Rule | None:
    """A rule for the rows that are left.

    The best first condition of each statistic and direction is tried by falling gain;
    if none grows into a rule that passes, so is every single condition.
    """
    cuts = _cuts(rows)
    rows = staged(_binned(rows, cuts), "quality-bins")
    candidates = _candidates(rows, cuts)
    firsts: dict[tuple[str, bool], Candidate] = {}
    for c in candidates:
        firsts.setdefault((c.condition.statistic, c.condition.above), c)
    for first in firsts.values():
        if rule := _grown(rows, cuts, first):
            return rule
    single = [c for c in candidates if _passes(*c.pruned) and _passes(*c.grown)]
    return (max(single, key=lambda c: c.pruned[0]).condition,) if single else None


def learn(labelled: DataFrame) -> list[Rule]:
    """An ordered list of rules for the rejected rows of ``labelled``.

    ``labelled`` has the columns of ``counts`` and ``quality`` (0: rejected).  Rows of the
    held-out fold take no part; one fold prunes, the others grow.  Rules are added until
    none passes; each covers ``SUPPORT`` rejected pruning rows or more, so that the list
    ends.  Without rejected or without accepted rows it is empty.
    """
    rows = labelled.filter((fold() != 0) & F.col("quality").isin(0, 1)).select(
        "*", (1 - F.col("quality")).cast("int").alias("bad"), (fold() == PRUNE_FOLD).alias("prune")
    )
    rows = staged(rows, "quality-statistics")
    rules: list[Rule] = []
    while rule := _next_rule(rows):
        rules.append(rule)
        rows = rows.filter(~holds(rule))
    return rules


def decision_list(rules: list[Rule]) -> Column:
    """The first rule that holds, as text; null if none does."""
    if not rules:
        return F.lit(None).cast("string")
    out = F
    for rule in rules:
        out = out.when(holds(rule), " and ".join(map(str, rule)))
    return out.otherwise(None)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, base verdict, ``kept`` and the rejecting ``rule`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` (distinct, not null) and ``text``, ``labels`` ``doc_id`` and
    ``quality``; other columns are not read, labels that are neither 0 nor 1 are skipped and of
    clashing ones the rejecting counts.  A null
    or empty text has no words and fails the base.  An empty table gives no rows.
    Equal three-word windows are found by 64-bit hashes within one text.
    """
    found = staged(counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "quality-counts")
    # where the labels of a document clash, one that rejects it counts
    marks = labels.select("doc_id", "quality").where("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rules = learn(found.join(marks, "doc_id"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        found.withColumn("base_failed", failed)
        .withColumn("rule", decision_list(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )

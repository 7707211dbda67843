"""Benchmark decontamination with a distributed positional inverted index.

The index stores the postings (term, document, position) of every token of the training
documents that occurs in a benchmark.  A benchmark item is cut into windows of
consecutive words.  For each window the lists of its two rarest terms are intersected
after adjusting for their offsets: an equal start is a candidate phrase, a start within
a few words is a proximity match.  Candidate phrases are then compared in full.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_if_small
from tidemark.session import staged

WINDOW = 10
SLOP = 5

# ASCII other than letters and digits; upper case is lowered after the split
_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words with A-Z lowered and other letters left alone; a null text has none."""
    parts = F.array_remove(F.split(F.coalesce(text, F.lit("")), _SEPARATORS), "")
    return F.transform(
        parts,
        lambda w: F.when(F.length(w) == F.octet_length(w), F.lower(w)).otherwise(
            F.translate(w, _UPPER, _LOWER)
        ),
    )


def _phrase(terms: Column) -> Column:
    """A window's identity: a digest of its words, which hold no blank."""
    return F.md5(F.array_join(terms, " "))


def windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``item_id, window_id, terms``: an item of fewer words than ``width`` is one window."""
    items = benchmark.select(F.col("item_id"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - width + 1))
    return items.select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("terms")
    ).select("item_id", _phrase(F.col("terms")).alias("window_id"), "terms")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term_id, doc_id, pos``: where the given ``term, term_id`` occur, stored once."""
    tokens = docs.select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    found = tokens.join(broadcast_if_small(terms), "term").select("term_id", "doc_id", "pos")
    return staged(found, "postings")


def _rarest(found: DataFrame, index: DataFrame, terms: DataFrame) -> DataFrame:
    """``window_id, n_terms, first, second``: the two rarest terms of each window.

    A window with a term that no document holds cannot occur and is left out.
    """
    lists = index.groupBy("term_id").agg(F.count("*").alias("df")).join(terms, "term_id")
    one = found.select("window_id", "terms").dropDuplicates(["window_id"])
    return (
        one.select("window_id", F.size("terms").alias("n_terms"), F.posexplode("terms").alias("off", "term"))
        .join(lists, "term")
        .groupBy("window_id", "n_terms")
        .agg(F.sort_array(F.collect_list(F.struct("df", "off", "term_id"))).alias("t"))
        .filter(F.size("t") == F.col("n_terms"))
        .select("window_id", "n_terms", F.get("t", F.lit(0)).alias("first"), F.get("t", F.lit(1)).alias("second"))
    )


def candidates(index: DataFrame, rarest: DataFrame, slop: int = SLOP) -> DataFrame:
    """``doc_id, window_id, n_terms, start, gap`` from the intersected lists.

    ``gap`` is how far the second term is from its place: 0 for a phrase candidate.
    Positions are put in stretches of ``slop + 1`` so that the nearness is an equality of
    keys; a term repeated through a document meets only its neighbourhood.
    """
    lead = rarest.select(
        F.col("first.term_id").alias("term_id"),
        F.col("first.off").alias("off"),
        F.col("second.term_id").alias("next_term"),
        F.col("second.off").alias("next_off"),
        "window_id",
        "n_terms",
    )
    starts = (
        index.join(broadcast_if_small(lead), "term_id")
        .withColumn("start", F.col("pos") - F.col("off"))
        .filter("start >= 0")
        .select("doc_id", "window_id", "n_terms", "start", "next_term", (F.col("start") + F.col("next_off")).alias("due"))
    )
    alone = starts.filter("next_term IS NULL").select(
        "doc_id", "window_id", "n_terms", "start", F.lit(0).alias("gap")
    )
    step = slop + 1
    pairs = starts.filter("next_term IS NOT NULL").withColumn(
        "stretch", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda k: F.floor(F.col("due") / step) + k))
    )
    wanted = rarest.select(F.col("second.term_id").alias("term_id")).distinct()
    second = index.join(broadcast_if_small(wanted), "term_id", "left_semi").select(
        F.col("doc_id"),
        F.col("term_id").alias("next_term"),
        F.floor(F.col("pos") / step).alias("stretch"),
        F.col("pos").alias("at"),
    )
    near = (
        pairs.join(second, ["doc_id", "next_term", "stretch"])
        .withColumn("gap", F.col("at") - F.col("due"))
        .filter(F.abs("gap") <= slop)
        .select("doc_id", "window_id", "n_terms", "start", "gap")
    )
    return alone.union(near)


def matches(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, slop: int = SLOP):
    """Two frames: phrase hits by document, and proximity matches.

    The first has a row for every document: ``doc_id, n_words, hits`` with the exact
    ``start, n_terms, window_id`` of each window that occurs.  The second has
    ``doc_id, window_id, gap`` for windows whose two rarest terms are near their places.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = staged(windows(benchmark, width), "benchmark-windows")
    # ids of terms are hashes; terms that share one would only add candidates
    terms = staged(
        found.select(F.explode("terms").alias("term")).distinct().withColumn("term_id", F.xxhash64("term")),
        "benchmark-terms",
    )
    index = postings(docs, terms)
    rarest = staged(_rarest(found, index, terms), "benchmark-rarest")
    near = staged(candidates(index, rarest, slop), "phrase-candidates")
    exact = (
        near.filter("gap = 0")
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("start", "n_terms", "window_id")).alias("c"))
        .withColumnRenamed("doc_id", "id")
    )
    text = docs.join(exact, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", words(F.col("text")).alias("w"), "c"
    )
    hits = F.filter("c", lambda c: _phrase(F.slice("w", c["start"] + 1, c["n_terms"])) == c["window_id"])
    return staged(text.select("doc_id", F.size("w").cast("long").alias("n_words"), hits.alias("hits")), "phrase-hits"), near, found


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near`` per document.

    ``docs`` needs ``doc_id`` (distinct, not null) and ``text``, ``benchmark`` ``item_id``
    and ``text``; other columns are not read.  A null or empty text has no words; an
    item without words has no window.  Repeated items and windows count once per item.
    With an empty benchmark nothing is contaminated; an empty table gives no rows.
    ``n_near`` counts the windows with a proximity match and no phrase match.
    """
    hits, near, found = matches(docs, benchmark, width, slop)
    covered = F.flatten(
        F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["n_terms"] - 1))
    )
    hit = hits.filter(F.size("hits") > 0)
    counted = hit.select("doc_id", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    phrases = hit.select("doc_id", F.explode("hits").alias("h")).select("doc_id", F.col("h.window_id").alias("window_id")).distinct()
    items = (
        phrases.join(found.select("window_id", F.col("item_id").cast("string").alias("item")).distinct(), "window_id")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    close = (
        near.select("doc_id", "window_id").distinct()
        .join(phrases, ["doc_id", "window_id"], "left_anti")
        .groupBy("doc_id")
        .agg(F.count("*").alias("n_near"))
    )
    nothing = F.array().cast("array<string>")
    return (
        hits.select("doc_id", "n_words")
        .join(counted, "doc_id", "left")
        .join(items, "doc_id", "left")
        .join(close, "doc_id", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(F.coalesce("items", nothing)).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.coalesce("items", nothing), ","), 256).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark."""
    bad = contamination(docs, benchmark, width).filter("contaminated").select("doc_id")
    return docs.join(bad, "doc_id", "left_anti")


# The same in DuckDB without the proximity column, which follows document frequencies.
SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT item_id, least(10, len(w)) AS n,
         array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM bw
), dw AS (
  SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lengths WHERE len(w) >= n)
), hits AS (SELECT doc_id, item_id, s, dw.n FROM dw JOIN bw ON dw.phrase = bw.phrase AND dw.n = bw.n
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit > 0, FALSE) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

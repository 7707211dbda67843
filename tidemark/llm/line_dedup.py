"""Line dedup by overlapping windows of three lines.

Lines with a word are hashed in windows of three consecutive ones.  Windows that occur
before, in a smaller document or further up in the same one, are repeats; the lines
that repeats cover go, together with blank lines between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged

WINDOW = 3

_BLANKS = " \t\x0b\x0c\r"
_HAS_WORD = "[^\\x20\\x09-\\x0D]"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _marked(text: Column) -> Column:
    """``at, line`` of the lines with a word; blanks at both ends do not count."""
    numbered = F.transform(
        _lines(text), lambda line, i: F.struct(i.alias("at"), F.btrim(line, F.lit(_BLANKS)).alias("line"))
    )
    return F.filter(numbered, lambda x: x["line"].rlike(_HAS_WORD))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc_id, first, last``: line ranges of windows that occurred before.

    The key is a pair of 64-bit hashes.  The earliest place of a key is found by a
    minimum that is combined before the exchange; a window repeated in a third of the
    documents then meets it in a join whose large side Spark may split.
    """
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _marked(F.col("text")).alias("m"))

    def window(k: Column) -> Column:
        rows = [F.get("m", k + j) for j in range(WINDOW)]
        texts = [row["line"] for row in rows]
        return F.struct(
            F.xxhash64(*texts).alias("h1"),
            F.xxhash64(F.lit(17), *reversed(texts)).alias("h2"),
            rows[0]["at"].alias("first"),
            rows[-1]["at"].alias("last"),
        )

    starts = F.sequence(F.lit(0), F.size("m") - WINDOW)
    windows = lines.filter(F.size("m") >= WINDOW).select(
        "doc_id", F.explode(F.transform(starts, window)).alias("w")
    ).select("doc_id", "w.*")
    earliest = staged(
        windows.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "first")).alias("origin"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("h1", "h2", "origin"),
        "line-windows",
    )
    return (
        windows.join(earliest, ["h1", "h2"])
        .filter(F.struct("doc_id", "first") > F.col("origin"))
        .select("doc_id", "first", "last")
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with what is left of ``text``, and ``n_lines``, ``n_removed``.

    ``docs`` needs ``doc_id`` (distinct, not null) and ``text``.  All other columns stay as they
    are; of columns with the names of the added ones, only the added ones are kept.  A
    null text stays null, a text of fewer than three lines with a word is unchanged.
    An empty table gives no rows.
    """
    covered = (
        repeated_windows(docs)
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("first", "last")).alias("__ranges"))
        .withColumnRenamed("doc_id", "__id")
    )
    lines = _lines(F.col("text"))
    gone = F.array_distinct(
        F.flatten(F.transform("__ranges", lambda r: F.sequence(r["first"], r["last"])))
    )
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("__lines"), i)), "\n")
    none = F.col("__ranges").isNull()
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return (
        docs.select(*[F.col(f"`{c}`") for c in own])
        .join(covered, F.col("doc_id") == F.col("__id"), "left")
        .withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"))
        .withColumn("__lines", F.when(~none, lines))
        .withColumn("n_removed", F.when(none, 0).otherwise(F.size(gone)).cast("long"))
        .withColumn("text", F.when(none, F.col("text")).otherwise(kept))
        .select(*[F.col(f"`{c}`") for c in own], "n_lines", "n_removed")
    )


# The same in DuckDB: windows compare by their lines.
SQL = r"""
WITH lines AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), numbered AS (
  SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS raw FROM lines
), marked AS (
  SELECT doc_id, pos, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
  FROM numbered WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')
), windows AS (
  SELECT doc_id, pos AS first, lead(pos, 2) OVER w AS last, line AS a,
         lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c
  FROM marked WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, first) AS place
  FROM windows WHERE last IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS pos FROM ranked WHERE place > 1
), left_over AS (
  SELECT n.doc_id, string_agg(n.raw, chr(10) ORDER BY n.pos) FILTER (WHERE g.pos IS NULL) AS kept,
         count(g.pos) AS n_removed
  FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.pos = g.pos GROUP BY n.doc_id
)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(l) END AS n_lines, n_removed,
       CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text
FROM lines JOIN left_over USING (doc_id)
"""

"""Secret scans with corpus-wide ownership frequency.

Patterns find candidate spans.  The value of each candidate is hashed, and over the
whole corpus it is counted in how many repositories and by how many owners it occurs.
A value of many owners is a copied example; one of a single owner that looks random is
a credential that may be live.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged

# Kinds in the order in which spans at one place are listed: the pattern, the group that
# holds the value, and the least length of that value.
BASE = {
    "assign": (
        "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    # a run is maximal, so asking for its least length at once finds the same spans
    "access": ("AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),
}
MORE = {
    "vendor": (
        "(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk[-_](?:live_)?[A-Za-z0-9]{20,}"
        "|AIza[A-Za-z0-9_-]{30,}|eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,})",
        0,
        1,
    ),
}
KINDS = {**BASE, **MORE}
COPIED_OWNERS = 3  # owners from which a value counts as a copied example
MIXED = 8  # distinct characters of a value that looks random

_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def _spans(text: Column, kind: str) -> Column:
    """Spans of one kind in code points, from the pieces between the matches."""
    pattern, group, least = KINDS[kind]
    rank = list(KINDS).index(kind)
    found = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("size"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    nothing = F.array().cast(_SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["size"], F.lit(0))
        span = F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            x["value"].alias("value"),
        )
        keep = F.length(x["value"]) >= least
        return F.struct(
            end.alias("at"),
            F.when(keep, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).cast(_SPAN).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), nothing.alias("out"))
    spans = F.aggregate(found, start, step)["out"]
    return F.when(text.rlike(pattern), spans).otherwise(nothing)


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def scanned(docs: DataFrame, repository: str, owner: str) -> DataFrame:
    """``doc_id, repository, owner, base, more`` with the spans of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.concat(*[_spans(text, k) for k in BASE]).alias("base"),
        F.concat(*[_spans(text, k) for k in MORE]).alias("more"),
    )


def ownership(found: DataFrame) -> DataFrame:
    """``hash, n_repositories, n_owners, verdict`` of every candidate value.

    Counts are distinct and made in two steps, so a value that a third of the corpus
    holds is one row per task before it is exchanged.
    """
    values = found.select(
        "repository", "owner", F.explode(F.concat("base", "more")).alias("s")
    ).select(
        F.md5("s.value").alias("hash"),
        "repository",
        "owner",
        (F.size(F.array_distinct(F.split("s.value", ""))) >= MIXED).alias("mixed"),
    )
    kept = values.groupBy("hash", "owner", "repository").agg(F.first("mixed").alias("mixed"))
    by_owner = kept.groupBy("hash", "owner").agg(F.count("*").alias("n"), F.first("mixed").alias("mixed"))
    return (
        by_owner.groupBy("hash")
        .agg(
            F.sum("n").alias("n_repositories"),
            F.count("*").alias("n_owners"),
            F.first("mixed").alias("mixed"),
        )
        .withColumn(
            "verdict",
            F.when(F.col("n_owners") >= COPIED_OWNERS, "copied")
            .when((F.col("n_owners") == 1) & F.col("mixed"), "live")
            .otherwise("unclear"),
        )
        .drop("mixed")
    )


def secrets(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """Spans of every row of ``docs`` and how widely their values are owned.

    Columns: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_copied, n_live``.
    ``docs`` needs ``doc_id`` (distinct, not null), ``text`` and the two columns named;
    other columns are not read.  A null text is empty, a null owner or repository is
    one of its own named ''.  Repeated values of a document count once.  An empty
    table gives no rows.
    """
    found = staged(scanned(docs, repository, owner), "secret-spans")
    spread = staged(ownership(found), "secret-owners")
    held = found.select(
        "doc_id",
        F.explode(F.array_distinct(F.transform(F.concat("base", "more"), lambda s: F.md5(s["value"])))).alias("hash"),
    )
    judged = (
        held.join(spread, "hash")
        .groupBy("doc_id")
        .agg(
            F.sum((F.col("verdict") == "copied").cast("long")).alias("n_copied"),
            F.sum((F.col("verdict") == "live").cast("long")).alias("n_live"),
        )
    )

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.join(judged, "doc_id", "left").select(
        "doc_id",
        *[number(k) for k in BASE],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "more")).alias("spans"),
        F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
    )


def sql() -> str:
    """The query over ``documents`` in DuckDB; values compare as they are, not by hash."""
    parts = []
    for rank, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        quoted = pattern.replace("'", "''")
        parts.append(
            f"""SELECT doc_id, owner, {rank} AS rank, '{kind}' AS kind, {least} AS least,
    list_transform(string_split_regex(t, '{quoted}'), lambda x: length(x)) AS gaps,
    list_transform(regexp_extract_all(t, '{quoted}', 0), lambda x: length(x)) AS sizes,
    regexp_extract_all(t, '{quoted}', {group}) AS vals FROM d"""
        )
    base = ", ".join(f"'{k}'" for k in BASE)
    counts = ",\n  ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
k AS ({" UNION ALL ".join(parts)}),
s AS (SELECT *, unnest(range(1, len(sizes) + 1)) AS i FROM k WHERE len(sizes) > 0),
placed AS (
  SELECT doc_id, owner, rank, kind, vals[i] AS value, sizes[i] AS size,
    CAST(list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1:i - 1]), 0) AS BIGINT) AS start
  FROM s WHERE length(vals[i]) >= least),
owners AS (SELECT value, count(DISTINCT owner) AS n_owners,
    len(list_distinct(string_split(value, ''))) >= {MIXED} AS mixed FROM placed GROUP BY value),
held AS (SELECT DISTINCT doc_id, value FROM placed),
judged AS (SELECT doc_id, count(*) FILTER (WHERE n_owners >= {COPIED_OWNERS}) AS n_copied,
    count(*) FILTER (WHERE n_owners = 1 AND mixed) AS n_live
  FROM held JOIN owners USING (value) GROUP BY doc_id),
listed AS (SELECT doc_id, {counts},
  string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, rank)
    FILTER (WHERE kind IN ({base})) AS base,
  string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, rank) AS spans
  FROM placed GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_copied, 0) AS n_copied, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN judged USING (doc_id)"""

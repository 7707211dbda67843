"""Dependencies of tables over any number of layers.

Each round joins the dependencies with the tables that the round before found, and writes out
what that reaches, so that a long chain leaves no long plan.  There are as many rounds as the
longest chain has links.  What is not joined along the dependencies is brought together by
grouping, and the size of a file of ids never decides on a broadcast: few bytes are many ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_if_small, union_all
from tidemark.session import staged


def dependency_edges(process_config: DataFrame) -> DataFrame:
    """``table_id, upstream``, one row per distinct dependency; an unreadable id is null."""
    parts = process_config.select("table_id", F.explode(F.split("depends_on_table_ids", ",")).alias("part"))
    parts = parts.where(F.trim("part") != "")
    return parts.select("table_id", F.trim("part").try_cast("bigint").alias("upstream")).distinct()


def levels(tables: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``table_id, level`` of the tables that can be loaded in some order, and the edges that are left.

    Level 0 needs nothing; any other is one above its highest upstream.  Tables behind a
    cycle, or behind an upstream that is no table, never get one.
    """
    tables = staged(tables.select("table_id").distinct(), "tables")
    marked = staged(_marked(tables, edges), "dependencies")
    placed = _peeled(*_linked(tables, marked)).where("not lost").select("table_id", "level")
    done = placed.select(F.col("table_id").alias("upstream")).hint("merge")
    return placed, marked.join(done, "upstream", "left_anti").select("table_id", "upstream")


def cycles(tables: DataFrame, edges: DataFrame) -> DataFrame:
    """``table_id`` of the tables that lie on a cycle, or on a way from one cycle to another."""
    tables = staged(tables.select("table_id").distinct(), "tables")
    starts, links = _linked(tables, staged(_marked(tables, edges), "dependencies"))
    return _circular(tables, links, _peeled(starts, links))


def blocked(edges: DataFrame, causes: DataFrame) -> DataFrame:
    """``table_id, hops``: everything downstream of ``causes`` (``table_id``), these at 0 hops.

    A table is reported with the least number of hops and is not followed again, so a
    cycle ends the search like any other way.
    """
    reached = frontier = staged(causes.select("table_id").distinct().withColumn("hops", F.lit(0)), "blocked")
    hops = 0
    while not frontier.isEmpty():
        hops += 1
        following = edges.join(_sized(frontier.select(F.col("table_id").alias("upstream"))), "upstream")
        following = following.select("table_id", F.lit(hops).alias("hops"))
        reached = staged(reached.unionByName(following).groupBy("table_id").agg(F.min("hops").alias("hops")), "blocked")
        frontier = reached.where(F.col("hops") == hops)
    return reached


def readiness(tables: DataFrame, edges: DataFrame, finished: DataFrame) -> DataFrame:
    """``table_id, level, in_cycle, hops_to_cause, is_ready`` per table.

    Ready is a table all of whose upstream tables, however far up, are among ``finished``
    (``table_id``).  Causes that keep others waiting are unfinished tables, upstream ids
    that are no table or not readable, and cycles; ``hops_to_cause`` is the number of steps to the nearest
    upstream cause, 1 for a direct one, and ``level`` is null behind a cycle or an unknown id.
    """
    tables = staged(tables.select("table_id").distinct(), "tables")
    marked = staged(_marked(tables, edges), "dependencies")
    starts, links = _linked(tables, marked)
    placed = _peeled(starts, links)
    circular = staged(_circular(tables, links, placed), "cycles")
    causes = staged(_without(tables, finished).union(circular).distinct(), "causes")
    direct = marked.join(_sized(causes.withColumnRenamed("table_id", "upstream")), "upstream", "left_semi")
    # an unknown or unreadable id joins nothing: its tables are a step from a cause themselves
    waiting = direct.select("table_id").union(marked.where("not known").select("table_id"))
    hops = blocked(marked, waiting).withColumn("hops", F.col("hops") + 1)
    found = [
        tables.withColumn("listed", F.lit(True)),
        placed.where("not lost").drop("lost"),
        circular.withColumn("in_cycle", F.lit(True)),
        hops,
    ]
    return (
        _stacked(found)
        .groupBy("table_id")
        .agg(
            F.max("level").alias("level"),
            F.coalesce(F.bool_or("in_cycle"), F.lit(False)).alias("in_cycle"),
            F.min("hops").alias("hops_to_cause"),
            F.min("hops").isNull().alias("is_ready"),
            F.bool_or("listed").alias("listed"),
        )
        .where("listed")
        .drop("listed")
    )


def _sized(df: DataFrame) -> DataFrame:
    """``df`` for a join: broadcast if it measures small, else shuffled, also if its file is small."""
    checked = broadcast_if_small(df)
    return df.hint("merge") if checked is df else checked


def _stacked(frames: list[DataFrame]) -> DataFrame:
    """The frames under one another; columns that one has not are null."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def _without(tables: DataFrame, others: DataFrame) -> DataFrame:
    """``table_id`` of the tables that are not among ``others``, both combined before they are shuffled."""
    both = tables.select("table_id", F.lit(False).alias("other")).union(others.select("table_id", F.lit(True)))
    tables_only = F.bool_or("other").alias("other")
    return both.groupBy("table_id").agg(tables_only).where("not other").select("table_id")


def _marked(tables: DataFrame, edges: DataFrame) -> DataFrame:
    """``table_id, upstream, known``: the edges, and whether the upstream is a table."""
    upstream = tables.select(F.col("table_id").alias("upstream"), F.lit(True).alias("known"))
    marked = edges.select("table_id", "upstream").join(_sized(upstream), "upstream", "left")
    return marked.select("table_id", "upstream", F.col("known").isNotNull().alias("known"))


def _linked(tables: DataFrame, marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``table_id, needs, lost`` per table, and these with every edge between two tables.

    ``needs`` counts the edges to tables; ``lost`` says that an upstream is no table.
    """
    needs = marked.select("table_id", F.col("known").cast("bigint").alias("needs"), (~F.col("known")).alias("lost"))
    starts = _stacked([tables.withColumn("listed", F.lit(True)), needs]).groupBy("table_id").agg(
        F.coalesce(F.sum("needs"), F.lit(0)).alias("needs"),
        F.coalesce(F.bool_or("lost"), F.lit(False)).alias("lost"),
        F.bool_or("listed").alias("listed"),
    )
    starts = staged(starts.where("listed").drop("listed"), "needs")
    links = marked.where("known").select("table_id", "upstream").join(_sized(starts), "table_id")
    return starts, staged(links, "links")


def _peeled(starts: DataFrame, links: DataFrame) -> DataFrame:
    """``table_id, level, lost`` of all tables but those behind a cycle.

    A table is found in the round after the last table that it needs; only tables that some
    but not all are found for are carried along.  ``lost``: an upstream, however far up, is no table.
    """
    frontier = starts.where("needs = 0")
    found, partly, level = [frontier.select("table_id", F.lit(0).alias("level"), "lost")], None, 0
    while not frontier.isEmpty():
        free = _sized(frontier.select(F.col("table_id").alias("upstream"), F.col("lost").alias("behind")))
        had = links.join(free, "upstream").select(
            "table_id", "needs", F.lit(1).cast("bigint").alias("had"), (F.col("lost") | F.col("behind")).alias("lost")
        )
        had = had if partly is None else union_all([had, partly])
        had = had.groupBy("table_id").agg(
            F.max("needs").alias("needs"), F.sum("had").alias("had"), F.bool_or("lost").alias("lost")
        )
        had = staged(had, "found")
        frontier, partly = had.where("had = needs"), had.where("had < needs")
        level += 1
        found.append(frontier.select("table_id", F.lit(level).alias("level"), "lost"))
    return union_all(found)


def _circular(tables: DataFrame, links: DataFrame, placed: DataFrame) -> DataFrame:
    """``table_id`` of the tables that are left when those before no cycle are taken off, too."""
    stuck = staged(_without(tables, placed), "stuck")
    behind = links.join(_sized(stuck.withColumnRenamed("table_id", "upstream")), "upstream", "left_semi")
    turned = behind.select(F.col("upstream").alias("table_id"), F.col("table_id").alias("upstream"), F.lit(True).alias("known"))
    return _without(stuck, _peeled(*_linked(stuck, turned)))

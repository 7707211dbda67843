"""Connected components of an edge table, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """``node, component`` for edges ``a, b``: the smallest node that is reachable.

    Alternating large-star and small-star rounds: every round links each node to the
    smallest neighbour, so that stars remain.  The minimum per node is combined before
    the exchange and written, so the join that brings it to the edges is a plain one, in
    which Spark may split a hub's edges over tasks.  Each round is written to the shared
    work folder, which ends its lineage.  Nodes without an edge are absent.
    """
    edges = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    edges = staged(edges, "edges")
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        # large star: larger neighbours of a node go to its smallest neighbour
        large = (
            both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = staged(large.filter("a <> b").distinct(), "large-stars")
        # small star: a node and its smaller neighbours go to the smallest of them
        low = staged(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
        )
        edges = staged(small.filter("a <> b").distinct(), "edges")
        state = edges.agg(
            F.count("*"), F.expr("sum(xxhash64(a, b) % 1000000007)"), F.sum(F.col("a") - F.col("b"))
        ).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
    raise RuntimeError("components did not settle")

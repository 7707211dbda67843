"""Readiness of tables over all layers of their dependencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import dependencies
from tidemark.plans.inputs import table
from tidemark.plans.registry import query

RUN_DT = "1998-06-01"

# Upstream lists over the part keys: two lower keys, and now and then the next key, which
# together with that one's reference back makes a cycle; some name no table or are no number.
_LAYERS_SQL = """WITH RECURSIVE keyed AS (SELECT p_partkey AS k, p_size AS s, max(p_partkey) OVER () AS top FROM part),
layers AS (
  SELECT k AS table_id, concat_ws(', ',
    CASE WHEN k % 7 <> 0 THEN CAST(k // 2 AS VARCHAR) END,
    CASE WHEN k > 10 AND k % 3 = 0 THEN CAST((k * 7 + s) % k AS VARCHAR) END,
    CASE WHEN k % 211 = 0 THEN CAST(least(k + 1, top) AS VARCHAR) WHEN k % 211 = 1 THEN CAST(k - 1 AS VARCHAR) END,
    CASE WHEN k % 331 = 5 THEN 'no number' WHEN k % 331 = 6 THEN '-5' END) AS depends_on_table_ids
  FROM keyed),
edges AS (
  SELECT DISTINCT table_id, TRY_CAST(trim(part) AS BIGINT) AS upstream
  FROM layers, unnest(string_split(depends_on_table_ids, ',')) AS s(part) WHERE trim(part) <> ''),
"""


def _layers(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("s"))
    top = parts.agg(F.max("k")).first()[0] or 0
    k, text = F.col("k"), "string"
    listed = F.concat_ws(
        ", ",
        F.when(k % 7 != 0, F.expr("k div 2").cast(text)),
        F.when((k > 10) & (k % 3 == 0), F.expr("(k * 7 + s) % k").cast(text)),
        F.when(k % 211 == 0, F.least(k + 1, F.lit(top)).cast(text)).when(k % 211 == 1, (k - 1).cast(text)),
        F.when(k % 331 == 5, "no number").when(k % 331 == 6, "-5"),
    )
    return parts.select(k.alias("table_id"), listed.alias("depends_on_table_ids"))


_WAYS_SQL = """reach(a, b) AS (
  SELECT table_id, upstream FROM edges WHERE upstream IS NOT NULL
  UNION SELECT r.a, e.upstream FROM reach r JOIN edges e ON e.table_id = r.b WHERE e.upstream IS NOT NULL),
circular AS (SELECT a AS table_id FROM reach WHERE a = b),
in_cycle AS (
  SELECT table_id FROM circular UNION
  SELECT r.a FROM reach r JOIN circular c ON r.b = c.table_id
  WHERE EXISTS (SELECT 1 FROM reach w JOIN circular d ON w.a = d.table_id WHERE w.b = r.a)),
"""


@query(
    _LAYERS_SQL
    + _WAYS_SQL
    + """hopeless AS (
  SELECT table_id FROM edges WHERE upstream IS NULL OR upstream NOT IN (SELECT table_id FROM layers)
  UNION SELECT table_id FROM in_cycle),
placeable AS (
  SELECT table_id FROM layers WHERE table_id NOT IN (SELECT table_id FROM hopeless)
    AND table_id NOT IN (SELECT a FROM reach WHERE b IN (SELECT table_id FROM hopeless))),
ways(table_id, level) AS (
  SELECT table_id, 0 FROM placeable WHERE table_id NOT IN (SELECT table_id FROM edges)
  UNION SELECT e.table_id, w.level + 1 FROM ways w JOIN edges e ON e.upstream = w.table_id
  WHERE e.table_id IN (SELECT table_id FROM placeable))
SELECT table_id, CAST(max(level) AS INTEGER) AS level FROM ways GROUP BY table_id"""
)
def dependency_levels(spark, sf_dir):
    """The layer of every table that can be loaded in some order."""
    layers = _layers(spark, sf_dir)
    return dependencies.levels(layers, dependencies.dependency_edges(layers))[0]


@query(_LAYERS_SQL + _WAYS_SQL.rstrip().rstrip(",") + "\nSELECT table_id FROM in_cycle")
def dependency_cycles(spark, sf_dir):
    """Tables that wait for themselves."""
    layers = _layers(spark, sf_dir)
    return dependencies.cycles(layers, dependencies.dependency_edges(layers))


@query(
    _LAYERS_SQL
    + _WAYS_SQL
    + f"""done AS (
  SELECT DISTINCT l_partkey AS table_id FROM lineitem
  WHERE l_returnflag <> 'R' AND CAST(l_shipdate AS DATE) < DATE '{RUN_DT}'),
causes AS (
  SELECT table_id FROM layers WHERE table_id NOT IN (SELECT table_id FROM done)
  UNION SELECT upstream FROM edges WHERE upstream IS NOT NULL AND upstream NOT IN (SELECT table_id FROM layers)
  UNION SELECT table_id FROM in_cycle),
blocked(table_id, hops) AS (
  SELECT table_id, 1 FROM edges WHERE upstream IS NULL OR upstream IN (SELECT table_id FROM causes)
  UNION SELECT e.table_id, b.hops + 1 FROM blocked b JOIN edges e ON e.upstream = b.table_id WHERE b.hops < 40),
nearest AS (SELECT table_id, min(hops) AS hops FROM blocked GROUP BY table_id)
SELECT l.table_id, c.table_id IS NOT NULL AS in_cycle, CAST(n.hops AS INTEGER) AS hops_to_cause, n.hops IS NULL AS is_ready
FROM layers l LEFT JOIN (SELECT DISTINCT table_id FROM in_cycle) c ON c.table_id = l.table_id
LEFT JOIN nearest n ON n.table_id = l.table_id"""
)
def transitive_readiness(spark, sf_dir):
    """Whether everything upstream of a table has finished, however many layers up."""
    layers = _layers(spark, sf_dir)
    finished = table(spark, sf_dir, "lineitem").where(
        (F.col("l_returnflag") != "R") & (F.col("l_shipdate").cast("date") < F.lit(RUN_DT).cast("date"))
    ).select(F.col("l_partkey").alias("table_id"))
    found = dependencies.readiness(layers, dependencies.dependency_edges(layers), finished)
    return found.drop("level")

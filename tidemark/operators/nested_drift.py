"""Drift below the top level, and columns that were renamed."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.drift import Finding, find_drift

SKETCH = 256  # smallest value hashes that stand for a column
LEAST_OVERLAP = 0.5


def leaves(kind: T.DataType, path: str = "") -> Iterator[tuple[str, T.DataType]]:
    """Every place of a type with its path: ``a.b`` in a struct, ``a[]`` in an array, ``a{}`` and ``a{key}`` in a map."""
    if path:
        yield path, kind
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from leaves(f.dataType, f"{path}.{f.name}" if path else f.name)
    elif isinstance(kind, T.ArrayType):
        yield from leaves(kind.elementType, f"{path}[]")
    elif isinstance(kind, T.MapType):
        yield from leaves(kind.keyType, f"{path}{{key}}")
        yield from leaves(kind.valueType, f"{path}{{}}")


def _shape(kind: T.DataType) -> str:
    """A type by itself; what lies below it is compared on its own."""
    return kind.typeName() if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else kind.simpleString()


def find_nested_drift(source: T.StructType, target: T.StructType) -> list[Finding]:
    """NEW, MISSING and TYPE_CHANGED at any depth; names compare without case.

    Only the topmost difference of a branch is reported: not the fields of a struct that is itself new.
    """
    here = {path.lower(): (path, kind) for path, kind in leaves(source)}
    there = {path.lower(): (path, kind) for path, kind in leaves(target)}
    found = []
    for event, ones, others in (("NEW", here, there), ("MISSING", there, here)):
        found += [Finding(p, k.simpleString(), event) for key, (p, k) in ones.items() if key not in others]
    found += [
        Finding(here[key][0], here[key][1].simpleString(), "TYPE_CHANGED")
        for key in here.keys() & there.keys()
        if _shape(here[key][1]) != _shape(there[key][1])
    ]
    tops = {f.column.lower() for f in found}

    def covered(path: str) -> bool:
        return any(path.lower().startswith(top) and path.lower() != top and path[len(top)] in ".[{" for top in tops)

    return sorted((f for f in found if not covered(f.column)), key=lambda f: (f.event, f.column))


def bottom_hashes(df: DataFrame, columns: Sequence[str], size: int = SKETCH) -> DataFrame:
    """``column, hash``: the ``size`` smallest hashes of the distinct values of each column.

    Two such sketches merge, and compare as the sets they stand for.  Distinct hashes are
    made map-side, and no more than ``size`` of a column leave a task.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.xxhash64(F.col(f"`{c}`").cast("string")).alias("hash"), F.col(f"`{c}`").isNull().alias("empty")) for c in columns]))
    hashes = df.select(pairs.alias("p")).where("NOT p.empty").select("p.column", "p.hash").distinct()
    smallest = Window.partitionBy("column").orderBy("hash")
    return hashes.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= size).drop("place")


def overlap(a: Sequence[int], b: Sequence[int], size: int = SKETCH) -> float:
    """Estimated Jaccard similarity of the sets that two sketches stand for."""
    both = sorted(set(a) | set(b))[:size]
    return sum(h in set(a) and h in set(b) for h in both) / len(both) if both else 0.0


def find_renames(
    source: DataFrame, target: DataFrame, least: float = LEAST_OVERLAP
) -> list[tuple[str, str, float]]:
    """``(missing, new, overlap)``: top-level columns of one type that carry the same values under a new name.

    Of the columns that are missing and those that are new, the most alike are paired
    first; each is used once.  The driver sees ``SKETCH`` numbers per such column.
    """
    findings = find_drift(source.schema, target.schema)
    gone = [f for f in findings if f.event == "MISSING"]
    came = [f for f in findings if f.event == "NEW"]
    if not gone or not came:
        return []
    sketches: dict[tuple[str, str], list[int]] = {}
    for side, df, columns in (("gone", target, gone), ("came", source, came)):
        for r in bottom_hashes(df, [f.column for f in columns]).collect():
            sketches.setdefault((side, r["column"]), []).append(r["hash"])
    scored = [
        (overlap(sketches.get(("gone", g.column), []), sketches.get(("came", c.column), [])), g.column, c.column)
        for g in gone for c in came if g.data_type == c.data_type
    ]
    pairs, used = [], set()
    for score, g, c in sorted(scored, key=lambda x: (-x[0], x[1], x[2])):
        if score >= least and not used & {("gone", g), ("came", c)}:
            pairs.append((g, c, score))
            used |= {("gone", g), ("came", c)}
    return pairs


def with_renames(df: DataFrame, renames: Sequence[tuple[str, str, float]]) -> DataFrame:
    """``df`` with the new columns under the names the target has for them."""
    return df.withColumnsRenamed({new: missing for missing, new, _ in renames})

"""Whitening against a dense eigendecomposition of all vectors at once."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import eigen, whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute_force(rows, components=16):
    """The contract in exact integers and numpy's own solver; signs are free."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [tuple(math.floor(64.0 * float(np.float32(c))) + 1_000_000 for c in v) for _, v in good]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[float(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for (i, _), v in zip(good, x):
        exact = [n * c - s for c, s in zip(v, sums)]
        z = (np.array(exact, float) / n) @ vectors / np.sqrt(values)
        out.append((i, sum(e * e for e in exact), z))
    return n, out, values / values.sum() if components >= len(sums) else values / np.trace(y.T @ y / n)


def collected(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.vec_id, {})[r.component] = r
    return found


def compare(rows, found):
    n, wanted, explained = brute_force(rows)
    assert len(found) == len(wanted)
    signs = None
    for i, deviation, z in wanted:
        got = [found[i][c + 1] for c in range(len(z))]
        assert all((r.n, r.deviation) == (n, deviation) for r in got)
        mine = np.array([r.whitened for r in got])
        if signs is None:
            signs = np.zeros(len(z))
        clear = (signs == 0) & (np.abs(z) > 1e-3)
        signs[clear] = np.sign(mine[clear] * z[clear])
        assert np.allclose(np.where(signs == 0, np.abs(mine), mine * signs), np.where(signs == 0, np.abs(z), z), atol=1e-7)
        assert np.allclose([r.explained for r in got], explained, rtol=1e-6)
        assert got[0].identity_error < 1e-6


def test_query_against_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    compare(rows, collected(whitening.whitened(table)))


def test_malformed_rows_copies_and_clashing_columns(spark):
    draws = np.random.default_rng(5)
    rows = [(i, [float(v) for v in draws.normal(0, [3, 2, 1, 0.5, 0.25])]) for i in range(200)]
    hot = [(1000 + i, [0.5, 0.25, 1.0, 2.0, 4.0]) for i in range(100)]
    bad = [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0]), (2002, [float("nan")] * 5), (2003, [float("inf")] * 5), (2004, [1.0]), (2005, [])]
    df = spark.createDataFrame(rows + hot + bad, SCHEMA).repartition(7)
    df = df.withColumns({c: F.lit("mine") for c in ("x", "n", "component", "i", "whitened")})
    compare(rows + hot, collected(whitening.whitened(df)))


def test_null_and_repeated_ids_keep_their_rows(spark):
    rows = [(None, [1.0, 2.0]), (None, [2.0, 1.0]), (3, [0.0, 0.0]), (3, [0.0, 0.0])]
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA))
    assert got.groupBy("vec_id").count().orderBy("vec_id").collect() == [(None, 4), (3, 4)]
    assert got.first().n == 3


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)], [(1, [])]])
def test_nothing_to_learn_gives_no_rows(spark, rows):
    assert whitening.whitened(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_flat_directions_have_no_component(spark):
    rows = [(i, [float(i), float(2 * i), 7.0]) for i in range(50)]
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA))
    assert [r[0] for r in got.select("component").distinct().collect()] == [1]
    assert abs(got.first().explained - 1) < 1e-12


def test_deviation_is_exact_or_refused():
    big = np.array([[1 << 31, 1 << 31]])
    assert whitening._squared(np.array([[3_000_000_000, 5]]))[0] == 9_000_000_000_000_000_025
    with pytest.raises(OverflowError):
        whitening._squared(big)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("kind", ["random", "clustered", "diagonal", "equal", "low rank", "graded"])
def test_eigenpairs(n, kind):
    draws = np.random.default_rng(n)
    q = np.linalg.qr(draws.normal(size=(n, n)))[0]
    values = {
        "random": draws.uniform(0, 5, n), "clustered": np.repeat([4.0, 4.0 + 1e-12, 1.0], n)[:n],
        "diagonal": np.arange(n, 0, -1.0), "equal": np.full(n, 2.0),
        "low rank": np.where(np.arange(n) < 3, 5.0, 0.0), "graded": 10.0 ** -np.arange(n),
    }[kind]
    matrix = np.diag(values) if kind == "diagonal" else (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = eigen.leading(matrix, 16)
    wanted = np.sort(values)[::-1][:16]
    norm = wanted[0]
    assert np.allclose(found, wanted, atol=1e-13 * norm * n)
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-11)
    assert np.max(np.abs(matrix @ vectors - vectors * found)) < 1e-12 * norm * n

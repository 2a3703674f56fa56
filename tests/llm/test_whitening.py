import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmill.llm import whitening
from starmill.llm.queries import op13_whitening


def brute(vectors, counted=False, components=16):
    """Fit weight, whole numbers per vector, components as columns, eigenvalues, mean, trace."""
    x = np.floor(np.asarray(vectors, "float64") * 64).astype("int64") + 1_000_000
    rows, copies = np.unique(x, axis=0, return_counts=True)
    weights = copies if counted else np.ones(len(rows), "int64")
    mean = (rows * weights[:, None]).sum(axis=0) / weights.sum()
    apart = rows - mean
    spread = (apart * weights[:, None]).T @ apart / weights.sum()
    values, axes = np.linalg.eigh(spread)
    return weights, rows, x, mean, values[::-1][:components], axes[:, ::-1][:, :components], np.trace(spread)


def compare(found, ids, vectors, counted=False):
    weights, rows, x, mean, values, axes, trace = brute(vectors, counted)
    n = int(weights.sum())
    sums = [int(s) for s in (rows * weights[:, None]).sum(axis=0)]
    assert {r["n"] for r in found} == {n}
    by_id = {r["vec_id"]: r for r in found}
    assert len(found) == len(ids)
    assert max(r["identity_error"] for r in found) < 1e-9
    signs = None
    for i, one in zip(ids, x, strict=True):
        row = by_id[i]
        assert int(row["deviation"]) == sum((n * int(v) - s) ** 2 for v, s in zip(one, sums, strict=True))
        expected = (one - mean) @ axes / np.sqrt(values)
        signs = np.sign(np.array(row["whitened"]) * expected) if signs is None else signs
        np.testing.assert_allclose(np.array(row["whitened"]) * signs, expected, rtol=1e-6, atol=1e-8)
        np.testing.assert_allclose(row["explained"], values / trace, rtol=1e-9)


@pytest.mark.parametrize("counted", [False, True])
def test_equals_brute_force(spark, counted):
    random = np.random.default_rng(3)
    vectors = random.normal(size=(300, 20)) * np.linspace(0.2, 3, 20)
    vectors[200:] = vectors[7]
    docs = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    compare(whitening.whiten(docs, counted=counted).collect(), range(300), vectors, counted)


def test_the_registered_query_on_the_tables(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    found = op13_whitening(spark, sf_dir).collect()
    assert len(found) == 16 * len(rows)
    ids, vectors = [r["vec_id"] for r in rows], [r["embedding"] for r in rows]
    weights, _, x, mean, values, axes, trace = brute(vectors)
    place = {i: p for p, i in enumerate(ids)}
    first = {r["component"]: r for r in found if r["vec_id"] == ids[0]}
    expected = (x - mean) @ axes / np.sqrt(values)
    signs = [np.sign(first[c + 1]["whitened"] * expected[0, c]) for c in range(16)]
    for r in found:
        assert r["n"] == len(weights)
        assert math.isclose(r["whitened"] * signs[r["component"] - 1], expected[place[r["vec_id"]], r["component"] - 1], rel_tol=1e-6, abs_tol=1e-8)
        assert math.isclose(r["explained"], values[r["component"] - 1] / trace, rel_tol=1e-9)
        assert r["identity_error"] < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, 1.0, -2.0], [0.25, 3.0, 1.0], [7.0, -1.5, 0.0], [1.0, 1.0, 1.0], [2.0, 0.0, 9.0]]
    rows = [(i, v) for i, v in enumerate(good)]
    rows += [(0, good[0]), (None, good[1])]
    rows += [(10, None), (11, []), (12, [nan, 1.0, 2.0]), (13, [inf, 1.0, 2.0]), (14, [None, 1.0, 2.0]), (15, [1.0]), (16, [1e300, 0.0, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    docs = docs.withColumns({c: F.lit(c) for c in ("x", "digest", "copies", "n", "whitened", "weight", "deviation")})
    found = whitening.whiten(docs).collect()
    assert sorted(r["vec_id"] for r in found if r["vec_id"] is not None) == [0, 0, 1, 2, 3, 4]
    assert {r["n"] for r in found} == {5} and {len(r["whitened"]) for r in found} == {3}
    null = next(r for r in found if r["vec_id"] is None)
    assert null["whitened"] == next(r for r in found if r["vec_id"] == 1)["whitened"]


def test_no_variation_has_no_components(spark):
    kinds = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(rows, kinds)).collect() == []
    flat = spark.createDataFrame([(i, [float(i), 1.0, 0.0]) for i in range(4)], kinds)
    assert {len(r["whitened"]) for r in whitening.whiten(flat).collect()} == {1}


def test_exact_beyond_64_bits():
    x = np.array([[1 << 40, 5], [3, 1 << 41]])
    sums = np.array([1 << 60, 12345], object)
    expected = [sum((1000 * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    assert [int(v) for v in whitening._deviations(x, 1000, sums).to_pylist()] == expected


def test_a_vector_of_a_third_of_all_rows(spark):
    random = np.random.default_rng(5)
    vectors = random.normal(size=(900, 6))
    vectors[::3] = vectors[0]
    docs = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = whitening.whiten(docs).collect()
    compare(found, range(900), vectors)

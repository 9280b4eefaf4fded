import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinlake.llm import whitening as wh

from conftest import SF_SMALL

INF = float("inf")


def brute(x):
    n = len(x)
    sums = [sum(int(v) for v in column) for column in x.T]
    centred = x - np.array([s / n for s in sums])
    covariance = centred.T @ centred / n
    e, q = np.linalg.eigh(covariance)
    e, q = e[::-1], q[:, ::-1]
    deviations = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return centred, e, q, np.trace(covariance), deviations


def products_of(x):
    def product(q, p):
        u, earlier = x @ q, np.stack(p, 1) if p else np.zeros((x.shape[1], 0))
        return (x @ earlier).T @ u, float(u @ u), x.T @ u

    return product


@pytest.mark.parametrize("name", ["noise", "ties", "rank", "decay", "flat", "single"])
def test_bidiagonalisation_equals_the_svd(name):
    rng = np.random.default_rng(1)
    x = {"noise": lambda: rng.standard_normal((300, 40)), "ties": lambda: np.vstack([np.eye(12) * 3] * 5), "rank": lambda: rng.standard_normal((90, 3)) @ rng.standard_normal((3, 20)),
         "decay": lambda: rng.standard_normal((900, 80)) * 0.5 ** np.arange(80), "flat": lambda: np.linalg.qr(rng.standard_normal((60, 10)))[0], "single": lambda: rng.standard_normal((50, 1))}[name]()
    x = x - x.mean(0)
    vectors, sigma, steps = wh.bidiagonalise(products_of(x), x.shape[1], min(8, x.shape[1]), float((x**2).sum()))
    k = min(8, x.shape[1])
    exact = np.linalg.svd(x, compute_uv=False)
    assert np.abs(sigma[:k] - exact[:k]).max() < 1e-12 * exact[0]
    assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() < 1e-13
    for v, s in zip(vectors.T[:k], sigma):  # a true eigenvector, also where eigenvalues are equal
        assert np.linalg.norm(x.T @ (x @ v) - s**2 * v) < 1e-12 * exact[0] ** 2
    assert steps < x.shape[1] or name != "decay"


def test_query(spark):
    rows = wh.op11_embedding_whitening(spark, SF_SMALL).collect()
    source = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").sort("vec_id").collect()
    x = np.array([[math.floor(1024 * float(v)) + 100_000 for v in r["embedding"]] for r in source])
    centred, e, q, trace, deviations = brute(x)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == 8 * len(source)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-10
    for c in range(8):
        own = np.array([got[r["vec_id"], c + 1]["whitened"] for r in source])
        want = centred @ q[:, c] / math.sqrt(e[c])
        assert np.abs(own * np.sign(own @ want) - want).max() < 1e-9
        assert abs(got[source[0]["vec_id"], c + 1]["explained"] / (e[c] / trace) - 1) < 1e-10
    for r, deviation in zip(source, deviations):
        assert got[r["vec_id"], 5]["deviation"] == deviation and got[r["vec_id"], 5]["n"] == len(source)


def whiten(spark, rows, kind="array<double>"):
    df = spark.createDataFrame([(*r, "clash") for r in rows], f"vec_id long, embedding {kind}, x string")
    return wh.whiten(df.select("vec_id", wh.whole_numbers(F.col("embedding")).alias("x"))).collect()


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.standard_normal(4).tolist()) for i in range(40)]
    good += [(None, [0.5, 0.25, -1.0, 2.0]), (3, [0.5, 0.25, -1.0, 2.0]), (3, [0.5, 0.25, -1.0, 2.0]), (77, [9.0e3, 0.0, 0.0, -1.0])]
    bad = [(90, None), (91, [1.0, None, 2.0, 3.0]), (92, [math.nan, 0.0, 0.0, 0.0]), (93, [INF, 0.0, 0.0, 0.0]), (94, [0.0, 0.0, 0.0, -INF]), (95, []), (96, [1.0, 2.0])]
    rows = whiten(spark, good + bad)
    x = np.array([[math.floor(1024 * v) + 100_000 for v in e] for _, e in good])
    _, e, _, trace, deviations = brute(x)
    assert len(rows) == 4 * len(good) and {r["n"] for r in rows} == {len(good)}
    assert sorted(str(r["vec_id"]) for r in rows if r["component"] == 1) == sorted(str(i) for i, _ in good)
    assert rows[0]["identity_error"] < 1e-4
    first = {r["component"]: r["explained"] for r in rows}
    assert all(abs(first[c + 1] / (e[c] / trace) - 1) < 1e-4 for c in range(4))
    assert sorted({r["deviation"] for r in rows}) == sorted(set(deviations))


def test_large_values_and_no_variance(spark):
    huge = whiten(spark, [(1, [1e13, 0.0]), (2, [-3e300, 1.0]), (3, [0.0, 5.0]), (4, [1.0, 5.0])])
    assert {r["deviation"] for r in huge} == {None}
    assert whiten(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert whiten(spark, [(1, [1.0, 2.0])]) == []
    line = whiten(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(10)])  # rank 1
    assert {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-4


def test_empty_table(spark):
    assert whiten(spark, []) == []
    assert whiten(spark, [(1, None), (2, [])]) == []

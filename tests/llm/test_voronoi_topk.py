import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinlake.llm import voronoi_topk as vt


def brute(rows, k):
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, asked = [], set()
    for q, v in ok:
        if q % 100 or (q, tuple(v)) in asked:
            continue
        asked.add((q, tuple(v)))
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def search(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = df.filter("vec_id is not null").select(
        F.col("vec_id").alias("id"), vt.whole_vector(F.col("embedding")).alias("v"), (F.col("vec_id") % 100 == 0).alias("is_query"))
    return sorted(tuple(r) for r in vt.top_k(vectors.filter("v is not null"), **options).collect())


@pytest.mark.parametrize("options", [{}, {"k": 3, "pivot_count": 5, "group_queries": 2, "block_rows": 40}])
def test_equals_brute_force(spark, options):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(6, 8)) * 3
    rows = [(i, (centers[i % 6] + rng.normal(size=8) * 0.1).tolist()) for i in range(600)]
    rows += [(1000 + i, [0.5] * 8) for i in range(50)]  # ties
    rows += [(2000, [0.5] * 8), (2000, [0.5] * 8), (2101, [0.5] * 8), (2101, [0.5] * 8)]  # repeated rows
    rows += [(3000, None), (3100, [1.0, None]), (3200, [float("nan")] * 8), (3300, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(4000, [1.0, 2.0]), (4001, [3.0, -1.0]), (4100, []), (4101, []), (4200, [2.0**40, 2.0**39]), (4300, [0.0] * 8)]
    assert search(spark, rows, **options) == brute(rows, options.get("k", 10))


def test_empty_and_no_queries(spark):
    assert search(spark, []) == []
    assert search(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert search(spark, [(100, [1.0])]) == []


def test_large_finite_values_and_clashing_columns(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(3).astype("float32").tolist()) for i in range(1, 40)]
    rows += [(0, [1.0, 2.0, -1.0]), (100, [1e13, 0.0, 0.0]), (41, [1e13, 1.0, 0.0]), (42, [-3e38, 0.0, 1.0]), (43, [3e38, 3e38, 3e38]), (200, [0.0, 0.0, 0.0]),
             (300, [1e9, -1e9, 5.0]), (44, [1e9, 1e9, 0.0])]
    held = [(q, r, v, max(-(2**63), min(2**63 - 1, s))) for q, r, v, s in brute(rows, 50)]
    want = []
    for q in sorted({h[0] for h in held}):
        own = sorted((-s, v) for a, _, v, s in held if a == q)[:10]
        want += [(q, n + 1, v, -s) for n, (s, v) in enumerate(own)]
    df = spark.createDataFrame([(*r, 1, "x", True) for r in rows], "vec_id long, embedding array<float>, score int, cell string, is_query boolean")
    vectors = df.select(F.col("vec_id").alias("id"), vt.whole_vector(F.col("embedding")).alias("v"), (F.col("vec_id") % 100 == 0).alias("is_query"))
    got = sorted(tuple(r) for r in vt.top_k(vectors.filter("v is not null"), k=10, group_queries=2, block_rows=7).collect())
    assert got == want
    assert {v for q, _, v, _ in got if q == 0} >= {41, 100}

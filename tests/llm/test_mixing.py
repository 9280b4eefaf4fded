import hashlib
import math
import random

import pytest

from clinlake.llm import mixing as mx


def test_raking_meets_targets_and_budget(spark):
    cells = spark.createDataFrame(
        [("a", "en", "prose", 900.0), ("a", "de", "prose", 50.0), ("b", "en", "short", 30.0), ("b", "de", "prose", 20.0),
         (None, "en", "prose", 40.0), (None, "de", "short", 60.0)], "source string, lang string, topic string, tokens double")
    targets = {d: mx.target_shares(cells, d, 0.5) for d in mx.DIMENSIONS}
    raked = mx.rake(cells, targets, 60)
    chances = mx.calibrate(raked, 0.5).collect()
    for d in mx.DIMENSIONS:
        want = {r[d]: r["share"] for r in targets[d].collect()}
        for key, share in want.items():
            assert sum(r["weight"] for r in chances if r[d] == key) == pytest.approx(share, abs=1e-4)
    total = sum(r["tokens"] for r in chances)
    assert sum(r["tokens"] * r["probability"] for r in chances) == pytest.approx(total / 2)
    for r in chances:
        assert r["factor"] * r["probability"] * r["tokens"] == pytest.approx(r["weight"] * total)


def test_given_targets_are_scaled_to_what_occurs(spark):
    cells = spark.createDataFrame([("a", 10.0), ("b", 30.0)], "source string, tokens double")
    given = spark.createDataFrame([("a", 0.5), ("b", 0.25), ("absent", 0.25)], "source string, share double")
    raked = {r["source"]: r["weight"] for r in mx.rake(cells, {"source": given}, 4).collect()}
    assert raked == pytest.approx({"a": 2 / 3, "b": 1 / 3})


def test_edge_rows(spark):
    data = [(1, "a b c", "s", "en", 9.0), (1, "a b c", "s", "en", 9.0), (None, "x y", None, None, 9.0), (2, None, "s", "en", 9.0),
            (3, "", "empty source", "xx", 9.0), (4, "w " * 50_000, "s", "de", 9.0), (5, "a | b", "t", "en", 9.0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, lang string, weight double")
    out = mx.mix(docs, budget=1.0).collect()
    # with the whole budget every document that has tokens is taken, repeated rows included
    assert sorted(str(r["doc_id"]) for r in out) == sorted(["1", "1", "None", "4", "5"] + ["2"])
    assert {r["doc_id"]: r["topic"] for r in out if r["doc_id"]} == {1: "short", 2: "short", 4: "long", 5: "table"}
    half = [r["doc_id"] for r in mx.mix(docs, budget=0.4).collect()]
    assert half.count(1) in (0, 2)
    assert mx.mix(docs.limit(0)).collect() == []


def test_uniform_is_the_md5(spark):
    from pyspark.sql import functions as F

    got = spark.range(5).select(mx.uniform(F.col("id")).alias("u")).collect()
    want = [int(hashlib.md5(f"{mx.SEED}{i}".encode()).hexdigest()[:13], 16) / 2**52 for i in range(5)]
    assert [r["u"] for r in got] == want


def shares(rows, dim):
    out = {}
    for r in rows:
        out[r[dim]] = out.get(r[dim], 0) + r["weight"]
    return out


def test_conflicting_targets_give_the_least_divergence(spark):
    """Each source has one language: source and language targets cannot both be met."""
    cells = spark.createDataFrame([("a", "en", "prose", 900.0), ("b", "en", "prose", 100.0), ("c", "en", "short", 100.0), ("d", "de", "prose", 400.0)],
                                  "source string, lang string, topic string, tokens double")
    targets = {d: mx.target_shares(cells, d, 0.5) for d in mx.DIMENSIONS}
    raked = mx.rake(cells, targets)
    rows = raked.collect()
    want = {d: {r[d]: r["share"] for r in targets[d].collect()} for d in mx.DIMENSIONS}

    def divergence(weights):
        total = 0.0
        for i, d in enumerate(mx.DIMENSIONS):
            sums = {}
            for key, w in weights.items():
                sums[key[i]] = sums.get(key[i], 0) + w
            total += sum(t * math.log(t / sums[k]) for k, t in want[d].items())
        return total

    found = {(r["source"], r["lang"], r["topic"]): r["weight"] for r in rows}
    assert sum(found.values()) == pytest.approx(1)
    least = divergence(found)
    rnd = random.Random(2)
    for _ in range(2000):  # no weights near by are better
        moved = {k: w * math.exp(rnd.gauss(0, 0.02)) for k, w in found.items()}
        scale = sum(moved.values())
        assert divergence({k: w / scale for k, w in moved.items()}) >= least - 1e-9
    left = {(r["dimension"], r["category"]): r for r in mx.remaining_errors(raked, targets).collect()}
    assert len(left) == 4 + 2 + 2
    for (d, k), r in left.items():
        assert r["target"] == pytest.approx(want[d][k]) and r["share"] == pytest.approx(shares(rows, d)[k])
        assert r["error"] == pytest.approx(r["share"] - r["target"])
    assert max(abs(r["error"]) for r in left.values()) > 0.01  # the conflict shows


def test_slow_targets_are_raked_to_the_tolerance(spark):
    cells = spark.createDataFrame([("a", "en", "p", 1000.0), ("a", "de", "p", 1.0), ("b", "en", "p", 1.0), ("b", "de", "p", 900.0), ("b", "de", "q", 5.0)],
                                  "source string, lang string, topic string, tokens double")
    given = {"source": [("a", 0.7), ("b", 0.3)], "lang": [("en", 0.35), ("de", 0.65)], "topic": [("p", 0.9), ("q", 0.1)]}
    targets = {d: spark.createDataFrame(rows, f"{d} string, share double") for d, rows in given.items()}
    left = mx.remaining_errors(mx.rake(cells, targets), targets).collect()
    assert max(abs(r["error"]) for r in left) < 1e-8

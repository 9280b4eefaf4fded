"""Global order, interval join and bitmap counts against plain versions."""

import datetime as dt
import random

from pyspark.sql import functions as F

from clinlake.operators.distinct import distinct_from_bitmaps, key_bitmaps, numbered_keys
from clinlake.operators.intervals import within_days
from clinlake.operators.ordering import globally_ranked


def test_rank_over_many_partitions_is_the_sorted_order(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice([None, "a", "b", "hot", "hot", "hot"])) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, v string").repartition(7)
    out = globally_ranked(df, [F.desc_nulls_last("v"), F.asc("id")], "place", partitions=13)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan
    got = {r["place"]: (r["id"], r["v"]) for r in out.collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, tuple(-ord(c) for c in (r[1] or "")), r[0]))
    assert [got[i + 1] for i in range(len(rows))] == want
    assert globally_ranked(df.limit(0), [F.asc("id")]).collect() == []


def test_interval_join_equals_all_pairs_and_splits_a_hot_key(spark):
    rnd = random.Random(6)
    day = lambda: dt.date(1969, 12, 1) + dt.timedelta(rnd.randint(0, 400))  # noqa: E731 - on both sides of day zero
    events = [(i, rnd.choice(["hot", "hot", f"p{i % 40}", None]), rnd.choice([None, day(), day(), day()])) for i in range(3000)]
    marks = [(rnd.choice(["hot", f"p{i % 50}", None]), rnd.choice([None, day(), day()])) for i in range(60)]
    e = spark.createDataFrame(events, "id long, k string, at date")
    m = spark.createDataFrame(marks, "k string, mark date")
    for days in (0, 3, 30):
        got = sorted(r["id"] for r in within_days(e, m, "k", "at", "mark", days, salt_by=["id"]).collect())
        assert got == [i for i, k, at in events if k and at and any(k == o and t and abs((at - t).days) <= days for o, t in marks)]
    plan = within_days(e, m, "k", "at", "mark", 3)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert within_days(e.limit(0), m, "k", "at", "mark", 3).count() == 0 == within_days(e, m.limit(0), "k", "at", "mark", 3).count()


def test_bitmap_counts_roll_up_exactly(spark):
    rnd = random.Random(7)
    facts = [(i, rnd.choice([None, f"p{rnd.randint(0, 70_000)}"]), rnd.choice(["x", "hot", "hot", None]), rnd.randint(1, 3), rnd.randint(1, 12)) for i in range(20_000)]
    df = spark.createDataFrame(facts, "id long, k string, g string, y int, m int")
    numbers = numbered_keys(df, "k")
    assert numbers.count() == len({k for _, k, *_ in facts if k})
    state = key_bitmaps(df, numbers, "k", ["g", "y", "m"], salt_by=["id"]).cache()
    for by in (["g", "y", "m"], ["g", "y"], ["y"], []):
        sets = {}
        for _, k, g, y, m in facts:
            if k:
                sets.setdefault(tuple({"g": g, "y": y, "m": m}[c] for c in by), set()).add(k)
        got = {tuple(r[c] for c in by): r["distinct_keys"] for r in distinct_from_bitmaps(state, by).collect()}
        assert got == {key: len(own) for key, own in sets.items()}
    state.unpersist()


def test_a_bitmap_is_built_whole_in_one_task(spark):
    """No sparse bitmap leaves a task to be merged: facts are reduced to distinct numbers first."""
    facts = spark.range(2000).selectExpr("id", "cast(id % 500 as string) AS k", "id % 3 AS g")
    state = key_bitmaps(facts, numbered_keys(facts, "k"), "k", ["g"], salt_by=["id"])
    plan = state._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    built = plan.index("bitmap_construct_agg")
    assert "Exchange" not in plan[built:plan.rindex("bitmap_construct_agg")]
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert "partial_bitmap" in plan and plan.count("Exchange hashpartitioning(g") == 2

"""Physical-plan properties that matter at scale."""

import pytest

import __spark_entry__ as entry
from clinlake.plans.queries import QUERIES

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if "roundtrip" not in n and not n.startswith("run_")
                                        and n not in ("row_count_reconciliation", "table_lifecycle", "csv_mixed_headers")))
def test_no_cross_products(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns(spark):
    df = entry.queries()["scan_parquet_project"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "l_orderkey" in plan and "l_quantity" not in plan and "l_tax" not in plan


def test_filter_reaches_scan(spark):
    from pyspark.sql import functions as F
    from clinlake.sources import standins

    df = standins.table(spark, SF_SMALL, "orders").filter(F.col("o_orderpriority").isin("1-URGENT"))
    assert "PushedFilters: [IsNotNull(o_orderpriority), In(o_orderpriority" in _plan(df) or \
        "PushedFilters: [In(o_orderpriority" in _plan(df) or "EqualTo(o_orderpriority" in _plan(df)


def test_denominators_stay_in_plan(spark):
    # share-of-total uses a scalar subquery, not a driver-side count
    plan = _plan(entry.queries()["hospitalization_workload"](spark, SF_SMALL))
    assert "Subquery" in plan


def test_dedup_and_summaries_combine_before_the_shuffle(spark):
    # hot keys leave each map task as one partial-aggregate row
    for name, partial in (("dedup_primary_key", "partial_min"), ("summary_per_key", "partial_count")):
        plan = _plan(entry.queries()[name](spark, SF_SMALL))
        assert partial in plan, name


@pytest.mark.parametrize("name,scans", [("clean_patients", 3), ("clean_encounters", 2)])
def test_keyed_dedup_reads_each_source_once(spark, name, scans):
    plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == scans
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Window [") == 1


def test_hot_key_leaves_each_task_as_one_row(spark):
    """A key with two thirds of the rows: the limit before the shuffle keeps one row of it in each task."""
    from pyspark.sql import functions as F

    from clinlake.operators.dedup import dedup_deterministic

    rows = spark.range(0, 40_000, 1, 4).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 300).cast("string"))).alias("k"),
        (F.col("id") * 7919 % 40_009).alias("v"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a plan that can be walked
    try:
        out = dedup_deterministic(rows, ["k"])
        got = {r["k"]: r["v"] for r in out.collect()}
        todo, written = [out._jdf.queryExecution().executedPlan()], []
        while todo:
            node = todo.pop()
            if node.nodeName() == "Exchange":
                written.append(node.metrics().apply("shuffleRecordsWritten").value())
            todo += [node.children().apply(i) for i in range(node.children().size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert got == {r["k"]: r["v"] for r in rows.groupBy("k").agg(F.min("v").alias("v")).collect()}
    assert len(written) == 1
    assert 0 < written[0] <= 4 * 101


def test_master_joins_add_no_shuffle_without_broadcast(spark):
    """At scale the per-patient joins are sort-merge joins; their inputs are
    already hash-partitioned on patient_id by the summaries that produce them;
    the patients come from their cleaning, which shuffles on the key's hash."""
    import sys
    import os

    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from fixtures import small_world

    from clinlake.plans import silver

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        p, e, c, o = small_world(spark)
        m = silver.clinical_master(silver.clean_patients(p), silver.clean_encounters(e),
                                   silver.clean_conditions(c), silver.clean_observations(o))
        m.write.format("noop").mode("overwrite").save()
        plan = _plan(m)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    summaries = plan.split("condition_count")[0]
    assert "BroadcastHashJoin" not in plan and plan.count("LeftOuter") == 3, plan
    assert summaries


@pytest.mark.parametrize("how", ["semi", "inner"])
def test_hot_key_in_a_fact_join_is_split(spark, how):
    """A key holding two thirds of the facts, joined with an aggregated key side
    (which Spark's skew handling leaves alone): no task gets the whole key."""
    from pyspark.sql import functions as F

    from clinlake.operators.cohort import join_facts, restrict_to

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(30000).select(
            F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 50).cast("string")))
            .alias("patient_id"),
            F.col("id").alias("fact"),
        )
        keys = facts.groupBy("patient_id").agg(F.max("fact").alias("last"))
        out = restrict_to(facts, keys) if how == "semi" else join_facts(facts, keys)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert sum(sizes) == 30000 and max(sizes) < 12_000, sizes

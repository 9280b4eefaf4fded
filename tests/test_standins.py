"""The stand-in entities carry the dirt the cleaning steps exist for."""

from pyspark.sql import functions as F

from clinlake.sources import standins

from conftest import SF_ORACLE


def test_standins_contain_edge_cases(spark):
    p = standins.bronze_patients(spark, SF_ORACLE)
    e = standins.bronze_encounters(spark, SF_ORACLE)
    c = standins.bronze_conditions(spark, SF_ORACLE)
    o = standins.bronze_observations(spark, SF_ORACLE)
    assert p.filter(F.col("id") != F.trim("id")).count() > 0  # padded ids
    assert p.filter(F.col("id") == "NULL").count() > 0
    assert p.groupBy(F.trim("id")).count().filter("count > 1").count() > 0  # duplicated patient id
    assert p.filter(F.col("gender") == "").count() > 0 and p.filter(F.col("gender") == " f ").count() > 0
    assert p.filter(F.col("birthdate").isNull()).count() > 0
    assert p.filter(F.col("zip").startswith("0")).count() > 0  # leading zeros to keep
    assert e.filter(F.col("stop_time").isNull()).count() > 0
    assert e.filter(F.col("stop_time") < F.col("start_time")).count() > 0  # negative stays
    assert e.filter(F.col("patient") == "null").count() > 0
    assert c.filter(F.col("encounter").isNull()).count() > 0
    # (no exact duplicate conditions occur in this data; the natural-key dedup is
    # covered by the hand-made fixture in test_silver.py)
    assert o.filter(F.col("encounter").isNull()).count() == o.count()
    # the cohort has members admitted only through observations
    s = {k: v for k, v in standins.bronze_tables(spark, SF_ORACLE).items()}
    coded = c.filter(F.col("code").isin(*standins.STANDIN_SPEC.cohort.condition_codes)).select("patient").distinct()
    obs_only = o.filter(F.upper("value").rlike(standins.STANDIN_SPEC.cohort.value_pattern)).select("patient").distinct()
    assert obs_only.join(coded, "patient", "left_anti").count() > 0
    assert len(s) == 4


def test_condition_lines_are_narrow_when_they_are_joined(spark):
    """Lines are joined without their times and numbers, and repeated only afterwards."""
    plan = standins.bronze_conditions(spark, SF_ORACLE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode") < plan.index("Join")  # above it
    below = plan[plan.index("Join"):]
    assert "to_date" in below or "cast(l_shipdate" in below

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from clinlake.plans import silver

from fixtures import D, T, conditions, observations, patients, small_world


def _clean(spark):
    p, e, c, o = small_world(spark)
    return (silver.clean_patients(p), silver.clean_encounters(e), silver.clean_conditions(c),
            silver.clean_observations(o))


def test_clean_patients_dedup_is_deterministic(spark):
    p, *_ = small_world(spark)
    first = silver.clean_patients(p).filter("patient_id = 'p2'").collect()
    again = silver.clean_patients(p.orderBy(F.rand(7)).repartition(3)).filter("patient_id = 'p2'").collect()
    assert len(first) == 1 and first == again
    assert first[0]["first_name"] == "Bob"  # 'Bob' < 'Bobby'
    ids = sorted(r[0] for r in silver.clean_patients(p).select("patient_id").collect())
    assert ids == ["p1", "p2", "p3", "p4"]  # 'NULL' id dropped, ' p2 ' trimmed


def test_clean_patients_types_and_gender(spark):
    p, *_ = small_world(spark)
    cp = silver.clean_patients(p)
    types = dict(cp.dtypes)
    assert types["birthdate"] == "date" and types["lat"] == "decimal(10,6)"
    assert types["healthcare_expenses"] == "decimal(12,2)"
    g = dict((r[0], r[1]) for r in cp.select("patient_id", "gender").collect())
    assert g == {"p1": "Female", "p2": "Male", "p3": None, "p4": "Female"}


def test_clean_encounters_requires_both_ids(spark):
    _, ce, _, _ = _clean(spark)
    assert sorted(r[0] for r in ce.select("encounter_id").collect()) == ["e1", "e2", "e3"]
    assert dict(ce.dtypes)["encounter_start"] == "timestamp_ntz"


def test_clean_conditions_dedup_and_null_encounter(spark):
    _, _, cc, _ = _clean(spark)
    p2 = cc.filter("patient_id = 'p2' AND condition_code = '840539006'").count()
    assert p2 == 1  # duplicate with stop_date NULL on both collapses
    assert cc.filter("encounter_id IS NULL").count() == 0


def test_clean_observations_flexible_names(spark):
    recs = [{"PATIENT": " p1 ", "Encounter": None, "Start": T(2020, 1, 1), "CODE": "c", "Description": "d", "VALUE": "v"}]
    o = observations(spark, recs, cols=("PATIENT", "Encounter", "Start", "CODE", "Description", "VALUE"))
    out = silver.clean_observations(o).collect()
    assert [tuple(r) for r in out] == [("p1", None, dt.datetime(2020, 1, 1), "c", "d", "v")]
    no_time = silver.clean_observations(o.drop("Start"))
    assert no_time.collect()[0]["observation_time"] is None
    assert dict(no_time.dtypes)["observation_time"] == "timestamp_ntz"


def test_positive_observation_rule(spark):
    vals = ["Positive", "Not detected", "Nonreactive", "Negative", None]
    recs = [{"patient": f"p{i}", "value": v, "date": T(2020, 1, 1)} for i, v in enumerate(vals)]
    recs.append({"patient": "p9", "value": "Negative", "description": "Result positive", "date": T(2020, 1, 1)})
    o = silver.clean_observations(observations(spark, recs))
    got = sorted(r[0] for r in silver.cohort_from_observations(o).collect())
    assert got == ["p0", "p1", "p2", "p9"]


def test_master_semantics(spark):
    cp, ce, cc, co = _clean(spark)
    m = silver.clinical_master(cp, ce, cc, co)
    assert len(m.columns) == 32
    by_id = {r["patient_id"]: r for r in m.collect()}
    # p9 is coded but has no patient row; p4 enters by positive observation
    assert sorted(by_id) == ["p1", "p2", "p3", "p4"]
    assert by_id["p1"]["encounter_count"] == 2
    assert by_id["p1"]["total_claim_cost_sum"] == Decimal("100.50")
    assert by_id["p1"]["last_encounter_time"] == dt.datetime(2020, 3, 10)
    assert by_id["p3"]["encounter_count"] == 0 and by_id["p3"]["total_claim_cost_sum"] == Decimal("0.00")
    assert by_id["p3"]["last_encounter_time"] is None
    assert by_id["p4"]["observation_count"] == 1
    assert by_id["p2"]["condition_count"] == 2


def test_master_without_observations_has_same_schema(spark):
    cp, ce, cc, co = _clean(spark)
    with_obs = silver.clinical_master(cp, ce, cc, co)
    without = silver.clinical_master(cp, ce, cc, None)
    assert with_obs.schema == without.schema
    rows = {r["patient_id"]: r for r in without.collect()}
    assert sorted(rows) == ["p1", "p2", "p3"]
    assert all(r["observation_count"] == 0 and r["last_observation_time"] is None for r in rows.values())


def test_master_keys_unique_on_skewed_input(spark):
    # one patient holding most facts must still give one master row
    pats = patients(spark, [{"id": "hot", "birthdate": D(1960, 1, 1)}, {"id": "cold", "birthdate": D(1970, 1, 1)}])
    encs = spark.range(5000).select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("id"),
        F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz").alias("start_time"),
        F.lit(None).cast("timestamp_ntz").alias("stop_time"),
        F.when(F.col("id") < 4990, F.lit("hot")).otherwise(F.lit("cold")).alias("patient"),
        *[F.lit(None).cast("string").alias(c) for c in ("organization", "provider", "payer", "encounterclass", "code", "description")],
        F.lit(Decimal("1.00")).cast("decimal(12,2)").alias("base_encounter_cost"),
        F.lit(Decimal("1.00")).cast("decimal(12,2)").alias("total_claim_cost"),
        F.lit(None).cast("decimal(12,2)").alias("payer_coverage"),
        F.lit(None).cast("string").alias("reasoncode"),
        F.lit(None).cast("string").alias("reasondescription"),
    )
    conds = conditions(spark, [
        {"patient": "hot", "encounter": "e1", "start_date": D(2020, 1, 1), "code": "840539006"},
        {"patient": "cold", "encounter": "e4999", "start_date": D(2020, 1, 1), "code": "840539006"},
    ])
    m = silver.clinical_master(silver.clean_patients(pats), silver.clean_encounters(encs), silver.clean_conditions(conds))
    got = {r["patient_id"]: (r["encounter_count"], r["total_claim_cost_sum"]) for r in m.collect()}
    assert got == {"hot": (4990, Decimal("4990.00")), "cold": (10, Decimal("10.00"))}


def test_dedup_plans_agree_and_run_nothing_when_built(spark):
    from clinlake.operators.dedup import dedup_deterministic, first_per_key
    from clinlake.sources import standins

    from conftest import SF_SMALL

    li = standins.table(spark, SF_SMALL, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup(None)
    split, whole = dedup_deterministic(li, keys), first_per_key(li, keys)
    assert tracker.getJobIdsForGroup(None) == before
    assert sorted(tuple(r) for r in split.collect()) == sorted(tuple(r) for r in whole.collect())
    with_null = spark.createDataFrame([(None, "b"), (None, "a"), (1, "z")], "k int, v string")
    assert sorted(dedup_deterministic(with_null, ["k"]).collect(), key=repr) == \
        sorted(first_per_key(with_null, ["k"]).collect(), key=repr)

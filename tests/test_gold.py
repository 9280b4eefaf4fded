import datetime as dt
from decimal import Decimal

from clinlake.plans import gold, silver
from clinlake.specs import SymptomSpec

from fixtures import small_world


def _world(spark):
    p, e, c, o = small_world(spark)
    cp, ce, cc, co = (silver.clean_patients(p), silver.clean_encounters(e), silver.clean_conditions(c),
                      silver.clean_observations(o))
    return silver.clinical_master(cp, ce, cc, co), cp, ce, cc


def test_symptoms_outcomes(spark):
    m, _, _, cc = _world(spark)
    out = [tuple(r) for r in gold.symptoms_outcomes(m, cc).collect()]
    # Fever starts the day before the index date (out); Cough on it and Sepsis after it (in).
    # p4 (observation-only) is in the survivor denominator but never a numerator.
    assert out == [("Cough", False, 1, 1, 100.0), ("Sepsis", False, 1, 1, 100.0)]
    pop = {r["is_survivor"]: r["total_group_population"] for r in
           gold.survivor_cohort(m).groupBy("is_survivor").count().withColumnRenamed("count", "total_group_population").collect()}
    assert pop == {True: 3, False: 1}


def test_mortality_demographics(spark):
    m, *_ = _world(spark)
    assert [tuple(r) for r in gold.mortality_demographics(m).collect()] == [("61-70", "Female", 1)]


def test_hospitalization_workload(spark):
    m, _, ce, _ = _world(spark)
    out = [tuple(r) for r in gold.hospitalization_workload(m, ce).collect()]
    # e1 stays 23:00 -> 01:00 next day = 1 day; e2 has no stop and is ignored by the mean
    assert out == [("Hospital admission", 1, 1.0, 25.0), ("ICU admission", 2, 4.0, 50.0)]


def test_mortality_by_demographics(spark):
    m, *_ = _world(spark)
    out = {(r[0], r[1]): tuple(r[2:]) for r in gold.mortality_by_demographics(m, dt.date(2024, 12, 31)).collect()}
    assert out == {
        ("65+", "Female"): (1, 1, 100.0),
        ("19-34", "Male"): (1, 0, 0.0),
        ("Unknown", None): (1, 0, 0.0),
        ("0-18", "Female"): (1, 0, 0.0),
    }


def test_pathway_summary(spark):
    m, _, ce, cc = _world(spark)
    row = gold.pathway_summary(m, ce, cc).collect()
    # p2 is ICU-only: counted in both icu_cases and home_isolation_cases
    assert [tuple(r) for r in row] == [(4, 3, 1, 2, 1, 3, 1)]


def test_pathway_summary_empty_master(spark):
    m, _, ce, cc = _world(spark)
    row = gold.pathway_summary(m.limit(0), ce, cc).collect()
    assert [tuple(r) for r in row] == [(0, None, None, None, None, None, None)]


def test_revenue_and_weekly_trend(spark):
    _, cp, ce, cc = _world(spark)
    rev = sorted(tuple(r) for r in gold.revenue_monthly(ce, cp).collect())
    assert rev == [
        (dt.date(2020, 3, 1), None, Decimal("100.50"), None, 2),
        (dt.date(2020, 4, 1), None, Decimal("20.00"), None, 1),
    ]
    wk = sorted(gold.weekly_trend(cc, cp).collect(), key=lambda r: r[0])
    assert [tuple(r) for r in wk] == [
        (dt.date(2020, 2, 24), "Female", 1),
        (dt.date(2020, 3, 30), "Male", 1),
        (dt.date(2020, 4, 27), None, 1),
    ]


def test_global_summary_on_empty_input(spark):
    from clinlake.operators.summaries import global_summary

    _, _, ce, _ = _world(spark)
    row = global_summary(ce.limit(0), "n", sums={"cost": ("total_claim_cost", "decimal(38,2)")},
                         earliest={"first": "encounter_start"}).collect()
    assert [tuple(r) for r in row] == [(0, None, None)]
    full = global_summary(ce, "n", sums={"cost": ("total_claim_cost", "decimal(38,2)")}).collect()[0]
    assert (full["n"], full["cost"]) == (3, Decimal("120.50"))


def test_pathway_reads_bronze_facts(spark):
    from fixtures import D, conditions as bronze_conditions, small_world

    m, *_ = _world(spark)
    _, e, c, _ = small_world(spark)
    extra = bronze_conditions(spark, [{"patient": " p3 ", "encounter": None, "start_date": D(2020, 5, 2),
                                       "code": "v", "description": "Mechanical ventilation"}])
    enc, cond = gold.pathway_inputs_from_bronze(e, c.unionByName(extra))
    row = gold.pathway_summary(m, enc, cond).collect()[0]
    # the condition has no encounter (Silver drops it) but still flags p3; the padded id still matches
    assert row["ventilation_cases"] == 2


def test_symptom_onsets_searches_a_text_no_more_than_it_must(spark):
    """The keyword pattern is met in the filter and once more for what it lets through."""
    c = spark.createDataFrame([("p", None, None, "x", "Gizmo")], "patient_id string, encounter_id string, condition_start_date date, "
                              "condition_code string, condition_description string")
    plan = gold.symptom_onsets(c, symptom_spec=SymptomSpec(filter_pattern="gizmo|rod", labels=(("A", "gizmo"), ("B", "rod"))))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("gizmo|rod") == 2

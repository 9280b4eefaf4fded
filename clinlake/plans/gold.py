"""Gold layer: analytic tables over the clinical master and Silver facts.

Skew rule used throughout: facts are aggregated to (patient, group) before
they meet the per-patient tables, so no join ever sees more than a handful of
rows for one patient however many facts that patient has, and every shuffle
carries map-side-combined partial aggregates instead of raw rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from clinlake.functions.labels import (
    any_like,
    clinical_age_band,
    decade_age_band,
    first_match_label,
    flag,
    percent,
)
from clinlake.functions.identifiers import normalize_identifier
from clinlake.functions.temporal import stay_days, year_age
from clinlake.operators.rates import rate_against_groups, share_of_total
from clinlake.operators.summaries import any_flags_per_key
from clinlake.specs import AdmissionSpec, CohortSpec, PathwaySpec, SymptomSpec


def survivor_cohort(master: DataFrame) -> DataFrame:
    """(patient_id, is_survivor): survivor = no death date."""
    return master.select("patient_id", F.col("patient_deathdate").isNull().alias("is_survivor"))


def index_dates(conditions: DataFrame, spec: CohortSpec = CohortSpec()) -> DataFrame:
    """First coded-diagnosis date per patient."""
    return (
        conditions.filter(F.col("condition_code").isin(*spec.condition_codes))
        .groupBy("patient_id")
        .agg(F.min("condition_start_date").alias("covid_diagnosis_date"))
    )


def labelled_conditions(conditions: DataFrame, spec: SymptomSpec = SymptomSpec()) -> DataFrame:
    """Conditions matching the keyword filter, with their first-match label."""
    desc = F.col("condition_description")
    return conditions.filter(desc.rlike(f"(?i)({spec.filter_pattern})")).withColumn(
        "condition_category", first_match_label(desc, spec.labels)
    )


def symptom_onsets(
    conditions: DataFrame,
    cohort_spec: CohortSpec = CohortSpec(),
    symptom_spec: SymptomSpec = SymptomSpec(),
) -> DataFrame:
    """(patient_id, condition_category, last_start, covid_diagnosis_date) in one pass.

    One aggregate over the conditions that are either coded or match the
    keyword filter, at (patient, category) grain: the earliest coded start and
    the latest labelled start. A per-patient window (at most one row per
    category plus one) then spreads the patient's first coded date over the
    patient's category rows.
    """
    desc = F.col("condition_description")
    start = F.col("condition_start_date")
    coded = F.col("condition_code").isin(*cohort_spec.condition_codes)
    keyword = F.coalesce(desc.rlike(f"(?i)({symptom_spec.filter_pattern})"), F.lit(False))
    # each text is searched once: what a row is comes first, all else reads these columns
    judged = conditions.select(
        "patient_id", start.alias("__start"), coded.alias("__coded"),
        F.when(keyword, F.struct(first_match_label(desc, symptom_spec.labels).alias("category"))).alias("__match"),
    )
    keyword = F.col("__match").isNotNull()
    per_group = (
        judged.filter(F.col("__coded") | keyword)
        .groupBy("patient_id", F.col("__match.category").alias("condition_category"))
        .agg(
            F.min(F.when(F.col("__coded"), F.col("__start"))).alias("first_coded"),
            F.max(F.when(keyword, F.col("__start"))).alias("last_start"),
        )
    )
    by_patient = Window.partitionBy("patient_id")
    return (
        per_group.withColumn("covid_diagnosis_date", F.min("first_coded").over(by_patient))
        .filter(F.col("condition_category").isNotNull())
        .select("patient_id", "condition_category", "last_start", "covid_diagnosis_date")
    )


def symptoms_outcomes(
    master: DataFrame,
    conditions: DataFrame,
    cohort_spec: CohortSpec = CohortSpec(),
    symptom_spec: SymptomSpec = SymptomSpec(),
) -> DataFrame:
    """Share of survivors / non-survivors with each symptom on or after diagnosis.

    A patient counts for a category when any labelled condition of that
    category starts on or after the patient's first coded diagnosis, i.e.
    when the latest start date in the category is >= the index date (both
    come from one aggregate, ``symptom_onsets``). Denominators are
    whole-master populations per survivor flag, so members admitted only by
    observation lower the rate.
    """
    people = survivor_cohort(master)
    population = people.groupBy("is_survivor").agg(F.count(F.lit(1)).alias("total_group_population"))
    qualifying = (
        symptom_onsets(conditions, cohort_spec, symptom_spec)
        .filter(F.col("last_start") >= F.col("covid_diagnosis_date"))
        .join(people, "patient_id")
    )
    # (patient, category) is unique here, so a row count is a distinct-patient count.
    counts = qualifying.groupBy("condition_category", "is_survivor").agg(
        F.count(F.lit(1)).alias("patient_count")
    )
    return (
        rate_against_groups(
            counts, population, on="is_survivor", count_col="patient_count",
            population_col="total_group_population", rate_as="rate_percentage",
        )
        .select("condition_category", "is_survivor", "patient_count", "total_group_population", "rate_percentage")
        .orderBy("condition_category", "is_survivor")
    )


def mortality_demographics(master: DataFrame) -> DataFrame:
    """Deaths by decade band of age at death (calendar years) and gender."""
    dead = master.filter(F.col("patient_deathdate").isNotNull())
    age = year_age(F.col("patient_deathdate"), F.col("patient_birthdate"))
    return (
        dead.withColumn("Age_Range", decade_age_band(age, F.col("patient_birthdate")))
        .groupBy("Age_Range", "gender")
        .agg(F.count("patient_id").alias("mortality_count"))
        .orderBy("Age_Range", "gender")
    )


def hospitalization_workload(
    master: DataFrame,
    encounters: DataFrame,
    spec: AdmissionSpec = AdmissionSpec(),
) -> DataFrame:
    """Per admission description: cohort patients, mean stay (days), share of the cohort.

    Stays are summed per (description, patient) first; the mean over all
    stays is then sum / count, which equals the mean over the raw rows.
    """
    stays = (
        encounters.filter(F.col("encounter_code").isin(*spec.encounter_codes))
        .withColumn("stay", stay_days(F.col("encounter_stop"), F.col("encounter_start")))
        .groupBy("encounter_description", "patient_id")
        .agg(F.sum("stay").alias("stay_sum"), F.count("stay").alias("stay_n"))
    )
    # master has one row per patient_id, so an inner join keeps each group once
    members = stays.join(master.select("patient_id"), "patient_id")
    per_desc = members.groupBy("encounter_description").agg(
        F.count(F.lit(1)).alias("patient_count"),
        F.round(F.try_divide(F.sum("stay_sum").cast("double"), F.sum("stay_n").cast("double")), 2).alias(
            "avg_length_of_stay_days"
        ),
    )
    return share_of_total(per_desc, master, "patient_count", "percentage").orderBy("encounter_description")


def mortality_by_demographics(master: DataFrame, as_of: _dt.date | Column | None = None) -> DataFrame:
    """Patients, deaths and mortality rate by clinical age band and gender.

    Age is at death, else at ``as_of`` (default: today), in calendar years.
    """
    ref = F.current_date() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    birth = F.col("patient_birthdate")
    death = F.col("patient_deathdate")
    age = F.when(death.isNotNull(), year_age(death, birth)).otherwise(F.year(ref) - F.year(birth))
    return (
        master.withColumn("age_group", clinical_age_band(age))
        .groupBy("age_group", "gender")
        .agg(
            F.count("patient_id").alias("total_covid_patients"),
            F.sum(flag(death.isNotNull())).cast("bigint").alias("total_deaths"),
        )
        .withColumn("mortality_rate_percent", percent(F.col("total_deaths"), F.col("total_covid_patients")))
    )


def pathway_inputs_from_bronze(encounters: DataFrame, conditions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bronze encounters / conditions as pathway inputs.

    The care-pathway counts read the Bronze facts, so rows that Silver drops
    (e.g. a condition without an encounter) still set a patient's flags. Only
    the patient key is normalized, so padded ids still match the master.
    """
    enc = encounters.select(
        normalize_identifier(F.col("patient")).alias("patient_id"),
        F.col("encounterclass").cast("string").alias("encounter_class"),
    )
    cond = conditions.select(
        normalize_identifier(F.col("patient")).alias("patient_id"),
        F.col("description").cast("string").alias("condition_description"),
    )
    return enc, cond


def pathway_flags(
    master: DataFrame,
    encounters: DataFrame,
    conditions: DataFrame,
    spec: PathwaySpec = PathwaySpec(),
) -> DataFrame:
    """One row per cohort patient with 0/1 care-pathway flags.

    ``encounters`` needs (patient_id, encounter_class) and ``conditions``
    (patient_id, condition_description): Silver tables, or Bronze ones via
    ``pathway_inputs_from_bronze``.
    """
    enc = any_flags_per_key(
        encounters,
        ["patient_id"],
        {
            "hospitalized_flag": flag(any_like(F.col("encounter_class"), spec.inpatient)),
            "icu_flag": flag(any_like(F.col("encounter_class"), spec.icu)),
        },
    )
    vent = any_flags_per_key(
        conditions,
        ["patient_id"],
        {"vent_flag": flag(any_like(F.col("condition_description"), spec.ventilation))},
    )
    died = F.col("patient_deathdate").isNotNull()
    seen = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("hospitalized_flag", "icu_flag", "vent_flag")}
    patients = master.select("patient_id", "patient_deathdate")
    for flags in (enc, vent):
        patients = patients.join(flags, "patient_id", "left")
    return patients.select(
        "patient_id",
        flag(died).alias("is_dead"),
        flag(~died).alias("is_recovered"),
        *[value.alias(c) for c, value in seen.items()],
        flag(seen["hospitalized_flag"] == 0).alias("home_isolation_flag"),
    )


def pathway_summary(
    master: DataFrame,
    encounters: DataFrame,
    conditions: DataFrame,
    spec: PathwaySpec = PathwaySpec(),
) -> DataFrame:
    """One row: cases, home isolation, hospitalized, ICU, ventilation, recovered, deaths.

    Home isolation means "never hospitalized", so an ICU-only patient counts
    in both ICU and home isolation. On an empty master: count 0, sums NULL.
    """
    flags = pathway_flags(master, encounters, conditions, spec)

    def total(c: str) -> Column:
        return F.sum(c).cast("bigint")

    return flags.agg(
        F.count("patient_id").alias("total_covid_cases"),
        total("home_isolation_flag").alias("home_isolation_cases"),
        total("hospitalized_flag").alias("hospitalized_cases"),
        total("icu_flag").alias("icu_cases"),
        total("vent_flag").alias("ventilation_cases"),
        total("is_recovered").alias("recovered_cases"),
        total("is_dead").alias("death_cases"),
    )


def revenue_monthly(encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """Monthly claim revenue, payer coverage and encounter count by patient state.

    Encounters are reduced to (patient, month) before joining the patient's
    state, then rolled up to (month, state).
    """
    per_patient = (
        encounters.withColumn("month", F.trunc(F.to_date("encounter_start"), "month"))
        .groupBy("patient_id", "month")
        .agg(
            F.sum("total_claim_cost").alias("revenue"),
            F.sum("payer_coverage").alias("coverage"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    return (
        per_patient.join(patients.select("patient_id", "state"), "patient_id")
        .groupBy("month", "state")
        .agg(
            F.sum("revenue").cast("decimal(38,2)").alias("total_claim_cost"),
            F.sum("coverage").cast("decimal(38,2)").alias("payer_coverage"),
            F.sum("n").cast("bigint").alias("encounter_count"),
        )
    )


def weekly_trend(conditions: DataFrame, patients: DataFrame, spec: CohortSpec = CohortSpec()) -> DataFrame:
    """New cases per week (Monday start) of first coded diagnosis, by gender."""
    first = index_dates(conditions, spec).filter(F.col("covid_diagnosis_date").isNotNull())
    return (
        first.join(patients.select("patient_id", "gender"), "patient_id")
        .withColumn("week_start", F.to_date(F.date_trunc("week", F.col("covid_diagnosis_date"))))
        .groupBy("week_start", "gender")
        .agg(F.count(F.lit(1)).alias("new_cases"))
    )

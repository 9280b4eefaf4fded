"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

They run the library's operators over the stand-in entities derived from the
driver's parquet tables (``sources.standins``), over whole tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinlake import schemas
from clinlake.functions import (
    any_like,
    as_date,
    as_decimal,
    as_string,
    as_timestamp,
    clinical_age_band,
    decade_age_band,
    flag,
    normalize_gender,
    normalize_identifier,
    percent,
    stay_days,
    year_age,
)
from clinlake.operators import (
    dedup_rows,
    dedup_rows_split,
    dedup_split,
    distinct_keys,
    first_per_key,
    join_facts,
    rate_against_groups,
    restrict_to,
    share_of_total,
)
from clinlake.operators import history
from clinlake.operators.distinct import distinct_from_bitmaps, key_bitmaps, numbered_keys
from clinlake.operators.intervals import within_days
from clinlake.operators.ordering import globally_ranked
from clinlake.operators.checks import ContentCheck, reconcile, table_profile
from clinlake.plans import gold, ingest, medallion, silver
from clinlake.session import scratch_path
from clinlake.sources import catalog, files, standins
from clinlake.sources.standins import STANDIN_SPEC

# Reference day for ages of living patients in the registered query, so that
# results do not change with the calendar (the library default is today).
AS_OF = _dt.date(2024, 12, 31)


class _LazyTables(dict):
    """Cleaned stand-in tables, each built on first access (plan building
    costs driver time, so unused tables are never built)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._builders = {
            "patients": lambda: silver.clean_patients(standins.bronze_patients(spark, sf_dir)),
            "encounters": lambda: silver.clean_encounters(standins.bronze_encounters(spark, sf_dir)),
            "conditions": lambda: silver.clean_conditions(standins.bronze_conditions(spark, sf_dir)),
            "observations": lambda: silver.clean_observations(standins.bronze_observations(spark, sf_dir)),
        }

    def __missing__(self, key: str) -> DataFrame:
        value = self[key] = self._builders[key]()
        return value


def silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _LazyTables(spark, sf_dir)


def master_of(s: dict[str, DataFrame], with_observations: bool = True) -> DataFrame:
    return silver.clinical_master(
        s["patients"], s["encounters"], s["conditions"],
        s["observations"] if with_observations else None,
        STANDIN_SPEC.cohort,
    )


# --- Silver ------------------------------------------------------------------
def q_clean_patients(spark, sf_dir):
    return silver.clean_patients(standins.bronze_patients(spark, sf_dir))


def q_clean_encounters(spark, sf_dir):
    return silver.clean_encounters(standins.bronze_encounters(spark, sf_dir))


def q_clean_conditions(spark, sf_dir):
    return silver.clean_conditions(standins.bronze_conditions(spark, sf_dir))


def q_clean_observations(spark, sf_dir):
    return silver.clean_observations(standins.bronze_observations(spark, sf_dir))


def q_cohort_union(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    return silver.cohort(s["conditions"], s["observations"], STANDIN_SPEC.cohort)


def q_clinical_master(spark, sf_dir):
    return master_of(silver_tables(spark, sf_dir), with_observations=True)


def q_clinical_master_no_observations(spark, sf_dir):
    return master_of(silver_tables(spark, sf_dir), with_observations=False)


# --- Gold ----------------------------------------------------------------------
def q_symptoms_outcomes(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    return gold.symptoms_outcomes(master_of(s), s["conditions"], STANDIN_SPEC.cohort, STANDIN_SPEC.symptoms)


def q_mortality_demographics(spark, sf_dir):
    return gold.mortality_demographics(master_of(silver_tables(spark, sf_dir)))


def q_hospitalization_workload(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    return gold.hospitalization_workload(master_of(s), s["encounters"], STANDIN_SPEC.admissions)


def q_mortality_by_demographics(spark, sf_dir):
    return gold.mortality_by_demographics(master_of(silver_tables(spark, sf_dir)), AS_OF)


def q_pathway_summary(spark, sf_dir):
    enc, cond = gold.pathway_inputs_from_bronze(
        standins.bronze_encounters(spark, sf_dir), standins.bronze_conditions(spark, sf_dir)
    )
    return gold.pathway_summary(master_of(silver_tables(spark, sf_dir)), enc, cond, STANDIN_SPEC.pathway)


def q_revenue_monthly_region(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    return gold.revenue_monthly(s["encounters"], s["patients"])


def q_weekly_trend(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    return gold.weekly_trend(s["conditions"], s["patients"], STANDIN_SPEC.cohort)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_patients": q_clean_patients,
    "clean_encounters": q_clean_encounters,
    "clean_conditions": q_clean_conditions,
    "clean_observations": q_clean_observations,
    "cohort_union": q_cohort_union,
    "clinical_master": q_clinical_master,
    "clinical_master_no_observations": q_clinical_master_no_observations,
    "symptoms_outcomes": q_symptoms_outcomes,
    "mortality_demographics": q_mortality_demographics,
    "hospitalization_workload": q_hospitalization_workload,
    "mortality_by_demographics": q_mortality_by_demographics,
    "pathway_summary": q_pathway_summary,
    "revenue_monthly_region": q_revenue_monthly_region,
    "weekly_trend": q_weekly_trend,
}


# --- operator-level queries -------------------------------------------------------
def q_scan_parquet_project(spark, sf_dir):
    li = standins.table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        as_decimal(li, "l_extendedprice", 12, 2).alias("extended_price"),
        as_date(li, "l_shipdate").alias("ship_date"),
        as_string(li, "l_returnflag").alias("return_flag"),
    ).withColumn("ship_year", F.year("ship_date"))


def q_rename_by_map(spark, sf_dir):
    """Source columns under their CSV header names (literal names in the oracle)."""
    to_headers = {name: header for header, name in schemas.ENCOUNTERS_RENAME.items()}
    return files.rename_columns(standins.bronze_encounters(spark, sf_dir), {**to_headers, "not_there": "X"})


def _shifted_observations(spark, sf_dir, time_names: dict[str, str]):
    """Observations with names in other cases, and other time columns."""
    b = standins.bronze_observations(spark, sf_dir)
    times = [F.date_add(F.to_date("date"), days).alias(name) for name, days in time_names.items()]
    return b.select(F.col("patient").alias("PATIENT"), F.col("encounter").alias("Encounter"), *times, F.col("code").alias("CODE"),
                    F.col("description").alias("Description"), F.col("value").alias("VALUE"))


def q_flexible_projection(spark, sf_dir):
    """No ``date``: the time comes from START, not from Start_Date."""
    return silver.clean_observations(_shifted_observations(spark, sf_dir, {"Start_Date": 9, "START": 1}))


def q_flexible_projection_no_time(spark, sf_dir):
    return silver.clean_observations(_shifted_observations(spark, sf_dir, {}))


def q_normalize_identifier(spark, sf_dir):
    b = standins.bronze_encounters(spark, sf_dir)
    return b.select(F.col("id").alias("encounter_id"), F.col("patient").alias("raw_patient"),
                    normalize_identifier(F.col("patient")).alias("patient_id"))


def q_normalize_gender(spark, sf_dir):
    b = standins.bronze_patients(spark, sf_dir)
    return b.select(F.col("ssn"), F.col("gender").alias("raw_gender"), normalize_gender(F.col("gender")).alias("gender"))


def q_try_parse_dates(spark, sf_dir):
    o = standins.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    texts = o.select(
        k,
        F.when(k % 7 == 0, F.concat(F.year("o_orderdate").cast("string"), F.lit("-13-45")))
        .otherwise(F.to_date("o_orderdate").cast("string")).alias("date_text"),
        F.when(k % 11 == 0, F.lit("not a time")).otherwise(F.col("o_orderdate").cast("string")).alias("time_text"),
    )
    return texts.select(
        "o_orderkey", "date_text", "time_text",
        as_date(texts, "date_text").alias("parsed_date"),
        as_timestamp(texts, "time_text").alias("parsed_time"),
    )


def q_filter_keys_and_codes(spark, sf_dir):
    e = silver_tables(spark, sf_dir)["encounters"]
    return e.filter(
        F.col("patient_id").isNotNull()
        & F.col("encounter_code").isin(*STANDIN_SPEC.admissions.encounter_codes)
        & F.col("encounter_stop").isNull()
    ).select("encounter_id", "patient_id", "encounter_code", "encounter_start")


def q_filter_text_patterns(spark, sf_dir):
    o = silver_tables(spark, sf_dir)["observations"]
    return o.filter(silver.positive_observation(STANDIN_SPEC.cohort)).select(
        "patient_id", "observation_time", "observation_value"
    )


def q_symptom_labels(spark, sf_dir):
    c = silver_tables(spark, sf_dir)["conditions"]
    return gold.labelled_conditions(c, STANDIN_SPEC.symptoms).select(
        "patient_id", "encounter_id", "condition_start_date", "condition_description", "condition_category"
    )


def q_pathway_patterns(spark, sf_dir):
    e = silver_tables(spark, sf_dir)["encounters"]
    p = STANDIN_SPEC.pathway
    return e.select(
        "encounter_id",
        flag(any_like(F.col("encounter_class"), p.inpatient)).alias("is_hospitalized"),
        flag(any_like(F.col("encounter_class"), p.icu)).alias("is_icu"),
    )


def q_filter_on_or_after_index(spark, sf_dir):
    c = silver_tables(spark, sf_dir)["conditions"]
    idx = gold.index_dates(c, STANDIN_SPEC.cohort)
    return (
        join_facts(c, idx)
        .filter(F.col("condition_start_date") >= F.col("covid_diagnosis_date"))
        .select("patient_id", "encounter_id", "condition_code", "condition_start_date", "covid_diagnosis_date")
    )


def q_dedup_primary_key(spark, sf_dir):
    """D1 as one keyed minimum over all rows."""
    return first_per_key(standins.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_dedup_primary_key_split(spark, sf_dir):
    """D1 with unique keys passing by an anti join on their hash."""
    return dedup_split(standins.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_dedup_natural_key(spark, sf_dir):
    return dedup_rows(standins.bronze_conditions(spark, sf_dir))


def q_dedup_natural_key_split(spark, sf_dir):
    """D2 with unique rows passing by an anti join on their hash."""
    return dedup_rows_split(standins.bronze_conditions(spark, sf_dir))


def q_distinct_ids(spark, sf_dir):
    return distinct_keys(silver_tables(spark, sf_dir)["encounters"], "patient_id")


def q_semi_join_cohort(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    members = silver.cohort(s["conditions"], s["observations"], STANDIN_SPEC.cohort)
    return restrict_to(s["encounters"], members).select("encounter_id", "patient_id", "encounter_start")


def q_inner_join_named_keys(spark, sf_dir):
    raw = standins.bronze_encounters(spark, sf_dir)
    master = master_of(silver_tables(spark, sf_dir)).select("patient_id", "gender")
    facts = raw.select(normalize_identifier(F.col("patient")).alias("patient_id"),
                       F.col("id").alias("encounter_id"), "encounterclass", "start_time")
    return join_facts(facts, master).select("encounter_id", "patient_id", "encounterclass", "gender")


def q_left_join_summaries(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    return (
        s["patients"].select("patient_id")
        .join(silver.encounter_summary(s["encounters"]), "patient_id", "left")
        .join(silver.condition_summary(s["conditions"]), "patient_id", "left")
        .fillna(0, subset=["encounter_count", "condition_count"])
        .select("patient_id", "encounter_count", "total_claim_cost_sum", "condition_count", "last_condition_date")
    )


def q_summary_per_key(spark, sf_dir):
    return silver.encounter_summary(silver_tables(spark, sf_dir)["encounters"])


def q_group_rate_by_population(spark, sf_dir):
    s = silver_tables(spark, sf_dir)
    people = gold.survivor_cohort(master_of(s))
    population = people.groupBy("is_survivor").agg(F.count(F.lit(1)).alias("population"))
    with_enc = people.join(distinct_keys(s["encounters"], "patient_id"), "patient_id")
    counts = with_enc.groupBy("is_survivor").agg(F.count(F.lit(1)).alias("patients_with_encounters"))
    return rate_against_groups(counts, population, "is_survivor", "patients_with_encounters", "population",
                               "rate_percentage")


def q_cohort_rate(spark, sf_dir):
    master = master_of(silver_tables(spark, sf_dir))
    counts = master.groupBy("state").agg(F.count(F.lit(1)).alias("patient_count"))
    return share_of_total(counts, master, "patient_count", "percentage")


def q_ratio_within_group(spark, sf_dir):
    master = master_of(silver_tables(spark, sf_dir))
    dead = F.col("patient_deathdate").isNotNull()
    return (
        master.groupBy("state")
        .agg(F.count("patient_id").alias("patients"), F.sum(flag(dead)).cast("bigint").alias("deaths"))
        .withColumn("death_rate_percent", percent(F.col("deaths"), F.col("patients")))
    )


def q_any_flag_per_key(spark, sf_dir):
    enc, cond = gold.pathway_inputs_from_bronze(
        standins.bronze_encounters(spark, sf_dir), standins.bronze_conditions(spark, sf_dir)
    )
    return gold.pathway_flags(master_of(silver_tables(spark, sf_dir)), enc, cond, STANDIN_SPEC.pathway)


def q_global_summary(spark, sf_dir):
    from clinlake.operators.summaries import global_summary

    return global_summary(
        silver_tables(spark, sf_dir)["encounters"], "encounter_count",
        sums={"total_claim_cost": ("total_claim_cost", "decimal(38,2)")},
        earliest={"first_encounter_start": "encounter_start"},
        latest={"last_encounter_stop": "encounter_stop"},
    )


def q_avg_stay(spark, sf_dir):
    e = silver_tables(spark, sf_dir)["encounters"]
    return e.groupBy("encounter_class").agg(
        F.count(F.lit(1)).alias("encounters"),
        F.round(F.avg(stay_days(F.col("encounter_stop"), F.col("encounter_start"))), 2).alias("avg_stay_days"),
    )


def q_age_bands(spark, sf_dir):
    master = master_of(silver_tables(spark, sf_dir))
    birth, death = F.col("patient_birthdate"), F.col("patient_deathdate")
    age = F.when(death.isNotNull(), year_age(death, birth)).otherwise(F.year(F.lit(AS_OF)) - F.year(birth))
    return master.select(
        "patient_id",
        age.alias("age"),
        decade_age_band(age, birth).alias("decade_band"),
        clinical_age_band(age).alias("clinical_band"),
    )


def q_parquet_roundtrip(spark, sf_dir):
    """Patients written as Parquet under the shared checkpoint folder, read back."""
    path = scratch_path(spark, "raw-patients")
    files.write_parquet(standins.bronze_patients(spark, sf_dir), path)
    return files.read_parquet(spark, path)


def q_csv_roundtrip(spark, sf_dir):
    """Patients through CSV and back. With default CSV options an empty text
    field and a missing one are both read as NULL (as in the source ingest)."""
    path = scratch_path(spark, "csv-patients")
    files.write_csv(standins.bronze_patients(spark, sf_dir), path, entity="patients")
    return files.read_csv(spark, path, "patients")


def _zoned(name: str, key: str) -> str:
    """A time as text: with ``Z``, with an offset of two hours, or plain, by key."""
    local = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    return (f"CASE CAST({key} AS BIGINT) % 3 WHEN 0 THEN concat({local.format(name)}, 'Z')"
            f" WHEN 1 THEN concat({local.format(f'{name} + INTERVAL 2 HOURS')}, '+02:00') ELSE {local.format(name)} END")


def q_csv_roundtrip_encounters(spark, sf_dir):
    """Encounters through CSV and back, their times written with and without offsets
    (converted to the session zone, UTC here)."""
    path = scratch_path(spark, "csv-encounters")
    b = standins.bronze_encounters(spark, sf_dir)
    files.write_csv(b.withColumns({c: F.expr(_zoned(c, "id")) for c in ("start_time", "stop_time")}), path, entity="encounters")
    return files.read_csv(spark, path, "encounters")


def q_csv_mixed_headers(spark, sf_dir):
    """Conditions from files of two headers: one in other order and case, without STOP."""
    path = scratch_path(spark, "csv-conditions")
    b = standins.bronze_conditions(spark, sf_dir)
    own = F.pmod(F.length("description"), F.lit(2)) == 0
    files.write_csv(b.filter(own), path, entity="conditions")
    other = b.filter(~own).select(F.col("description").alias("Description"), F.col("code").alias("code"), F.col("encounter").alias("Encounter"),
                                  F.col("start_date").alias("Start"), F.col("patient").alias("PATIENT"))
    files.write_csv(other, path, mode="append")
    return files.read_csv(spark, path, "conditions")


def _dirty_encounters(spark, sf_dir) -> str:
    """Encounters as CSV with times and amounts that are none; the folder."""
    path = scratch_path(spark, "csv-dirty")
    b = standins.bronze_encounters(spark, sf_dir)
    number = F.col("id").cast("bigint")
    dirty = {
        "start_time": F.when(number % 13 == 0, "soon").otherwise(F.col("start_time").cast("string")),
        "stop_time": F.when(number % 19 == 0, "2024-02-30T10:00:00").otherwise(F.col("stop_time").cast("string")),
        "total_claim_cost": F.when(number % 17 == 0, "n/a, see \"note\"").otherwise(F.col("total_claim_cost").cast("string")),
    }
    files.write_csv(b.withColumns(dirty), path, entity="encounters")
    return path


def q_csv_dirty_values(spark, sf_dir):
    """What is left of a dirty CSV: values that do not fit are NULL."""
    return files.read_csv(spark, _dirty_encounters(spark, sf_dir), "encounters")


def q_csv_rejected_values(spark, sf_dir):
    """The values of a dirty CSV that did not fit, with their rows (S1, Q1)."""
    lost = files.rejected_values(spark, _dirty_encounters(spark, sf_dir), "encounters")
    return lost.select(F.get_json_object("record", "$.id").alias("id"), F.get_json_object("record", "$.reasoncode").alias("reasoncode"),
                       "column_name", "value", "wanted")


def _scratch_namespace(spark) -> str:
    root = scratch_path(spark, "tables")
    ns = "clinlake_" + root.rsplit("-", 1)[-1]
    catalog.ensure_namespace(spark, ns, location=root)
    return ns


def _kept(spark, few_rows: DataFrame, *namespaces: str) -> DataFrame:
    """A result of a few rows, after which its scratch namespaces go."""
    out = spark.createDataFrame(few_rows.collect(), few_rows.schema)
    for ns in namespaces:
        spark.sql(f"DROP NAMESPACE IF EXISTS {ns} CASCADE")
    return out


def q_table_roundtrip(spark, sf_dir):
    """The master written as a catalog table in a fresh namespace located under
    the shared checkpoint folder, then resolved and read back."""
    ns = _scratch_namespace(spark)
    master = master_of(silver_tables(spark, sf_dir))
    catalog.write_table(master, f"{ns}.covid_clinical_master")
    return catalog.resolve_table(spark, f"{ns}.covid_clinical_master")


def q_row_count_reconciliation(spark, sf_dir):
    """Observed rows of a master table write vs a read-back count."""
    ns = _scratch_namespace(spark)
    n = catalog.write_table(master_of(silver_tables(spark, sf_dir)), f"{ns}.covid_clinical_master")
    return _kept(spark, reconcile(spark, f"{ns}.covid_clinical_master", n, label="covid_clinical_master"), ns)


def q_ranked_members(spark, sf_dir):
    """Members by claimed cost, highest first, with their place in the whole order (O1)."""
    members = master_of(silver_tables(spark, sf_dir)).select("patient_id", "state", "total_claim_cost_sum")
    return globally_ranked(members, [F.desc("total_claim_cost_sum"), F.asc("patient_id")], "cost_rank")


def q_encounters_near_diagnosis(spark, sf_dir):
    """Encounters that start at most 30 days before or after any coded diagnosis of their patient (J4)."""
    s = silver_tables(spark, sf_dir)
    coded = s["conditions"].filter(F.col("condition_code").isin(*STANDIN_SPEC.cohort.condition_codes))
    events = s["encounters"].select("encounter_id", "patient_id", "encounter_start")
    return within_days(events, coded, "patient_id", "encounter_start", "condition_start_date", 30, salt_by=["encounter_id"])


def q_distinct_patients_rollup(spark, sf_dir):
    """Distinct patients by description and month, by description and year, and by year,
    from one state of bitmaps (A5)."""
    s = silver_tables(spark, sf_dir)
    facts = _landed(spark, s["encounters"].select(
        "encounter_id", "patient_id", "encounter_description", F.year("encounter_start").alias("year"), F.month("encounter_start").alias("month")), "facts")
    numbers = numbered_keys(facts.select("patient_id"), "patient_id")
    state = key_bitmaps(facts, numbers, "patient_id", ["encounter_description", "year", "month"], salt_by=["encounter_id"])
    path = scratch_path(spark, "bitmaps")
    files.write_parquet(state, path)
    state = files.read_parquet(spark, path)
    none = {"encounter_description": F.lit(None).cast("string"), "month": F.lit(None).cast("int")}
    monthly = distinct_from_bitmaps(state, ["encounter_description", "year", "month"], "patients")
    yearly = distinct_from_bitmaps(state, ["encounter_description", "year"], "patients").withColumn("month", none["month"])
    total = distinct_from_bitmaps(state, ["year"], "patients").withColumns(none)
    return monthly.unionByName(yearly).unionByName(total)


def q_content_reconciliation(spark, sf_dir):
    """The master's content as observed on the way out and as read back (C4)."""
    ns = _scratch_namespace(spark)
    master = master_of(silver_tables(spark, sf_dir))
    content = ContentCheck("covid_clinical_master", master.columns)
    catalog.write_table(content.observed(master), f"{ns}.covid_clinical_master", check=content.check)
    return _kept(spark, content.compare(spark.table(f"{ns}.covid_clinical_master")), ns)


def _id_number(column: str):
    return F.coalesce(F.col(column).cast("bigint"), F.lit(0))


def q_table_refresh(spark, sf_dir):
    """Patients written, refreshed with other rows and then with other columns; what each reader sees (K4)."""
    ns = _scratch_namespace(spark)
    patients = standins.bronze_patients(spark, sf_dir).select("id", "ssn", "city", "zip")
    name, seen = f"{ns}.patients", []
    for step, df in (("first", patients), ("other rows", patients.filter("zip < '01000'")),
                     ("other columns", patients.select("city", "ssn").filter("city != 'City1'"))):
        catalog.write_table(df, name)
        seen.append(spark.table(name).groupBy("city").agg(F.count(F.lit(1)).alias("rows"), F.max("ssn").alias("last_ssn"))
                    .withColumns({"step": F.lit(step), "columns": F.lit(len(spark.table(name).columns))}).collect())
    return _kept(spark, spark.createDataFrame([r for rows in seen for r in rows], "city string, rows long, last_ssn string, step string, columns int"), ns)


def q_partition_overwrite(spark, sf_dir):
    """Encounters partitioned by year; a second load replaces two years and leaves the others (K5)."""
    ns = _scratch_namespace(spark)
    encounters = standins.bronze_encounters(spark, sf_dir).select("id", "start_time", "total_claim_cost", F.year("start_time").alias("start_year"))
    catalog.overwrite_partitions(encounters, f"{ns}.encounters", ["start_year"])
    again = encounters.filter(F.col("start_year").isin(1994, 1996) & (_id_number("id") % 10 != 0))
    amended = (F.col("total_claim_cost") + 100).cast("decimal(12,2)")
    catalog.overwrite_partitions(again.withColumn("total_claim_cost", amended), f"{ns}.encounters", ["start_year"])
    return spark.table(f"{ns}.encounters")


def _landed(spark, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back, for several uses."""
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _recorded(spark, ns: str, snapshots: list[DataFrame]) -> str:
    for load, snapshot in enumerate(snapshots, 1):
        history.record_load(snapshot, f"{ns}.bronze", load)
    return f"{ns}.bronze"


def q_bronze_as_of(spark, sf_dir):
    """Three loads of conditions, each snapshot as it was (E3): rows leave, change, return and repeat."""
    c = _landed(spark, standins.bronze_conditions(spark, sf_dir), "conditions")
    number = _id_number("encounter")
    second = c.filter(number % 7 != 0).withColumn("description", F.when(number % 3 == 0, F.upper("description")).otherwise(F.col("description")))
    name = _recorded(spark, _scratch_namespace(spark), [c.filter(number % 5 != 0), second, c.unionByName(c.filter(number % 11 == 0))])
    loads = [history.as_of(spark, name, n).withColumn("load", F.lit(n).cast("bigint")) for n in (1, 2, 3)]
    return loads[0].unionByName(loads[1]).unionByName(loads[2])


def q_bronze_changes(spark, sf_dir):
    """The keyed change sets of the second and third of three loads of encounters (E3)."""
    e = standins.bronze_encounters(spark, sf_dir)
    number = _id_number("id")
    cost = F.when(number % 3 == 0, (F.col("total_claim_cost") + 10).cast("decimal(12,2)")).otherwise(F.col("total_claim_cost"))
    name = _recorded(spark, _scratch_namespace(spark), [e.filter(number % 5 != 0), e.filter(number % 7 != 0).withColumn("total_claim_cost", cost), e])
    found = [history.changes(spark, name, n, ["id"]).withColumn("load", F.lit(n).cast("bigint")) for n in (2, 3)]
    return found[0].unionByName(found[1])


def q_table_lifecycle(spark, sf_dir):
    """Tables listed before and after one is dropped, with their type and provider (C2, C3/F12, K7)."""
    ns = _scratch_namespace(spark)
    for name, df in (("patients", standins.bronze_patients(spark, sf_dir)), ("conditions", standins.bronze_conditions(spark, sf_dir))):
        catalog.write_table(df, f"{ns}.{name}")

    def state(step: str) -> DataFrame:
        parts = []
        for r in catalog.list_tables(spark, ns).collect():
            facts = {d["col_name"]: d["data_type"] for d in catalog.describe_table(spark, f"{ns}.{r['tableName']}", ("Type", "Provider")).collect()}
            rows = spark.table(f"{ns}.{r['tableName']}").agg(F.count(F.lit(1)).alias("rows"))
            parts.append(rows.select(F.lit(step).alias("step"), F.lit(r["tableName"]).alias("table_name"), F.lit(facts["Type"]).alias("type"),
                                     F.lower(F.lit(facts["Provider"])).alias("provider"), "rows"))
        return spark.createDataFrame([row for p in parts for row in p.collect()], "step string, table_name string, type string, provider string, rows long")

    before = state("written")
    catalog.drop_table(spark, f"{ns}.conditions")
    return _kept(spark, before.unionByName(state("dropped")), ns)


def q_table_profile(spark, sf_dir):
    """Rows and columns of every Bronze and Silver stand-in table, one plan."""
    b = standins.bronze_tables(spark, sf_dir)
    s = silver_tables(spark, sf_dir)
    tables = {("bronze", k): v for k, v in b.items()}
    tables.update({("silver", k): s[k] for k in ("patients", "encounters", "conditions", "observations")})
    tables[("silver", "covid_clinical_master")] = master_of(s)
    return table_profile(tables)


QUERIES.update(
    {
        "scan_parquet_project": q_scan_parquet_project,
        "rename_by_map": q_rename_by_map,
        "flexible_projection": q_flexible_projection,
        "flexible_projection_no_time": q_flexible_projection_no_time,
        "normalize_identifier": q_normalize_identifier,
        "normalize_gender": q_normalize_gender,
        "try_parse_dates": q_try_parse_dates,
        "filter_keys_and_codes": q_filter_keys_and_codes,
        "filter_text_patterns": q_filter_text_patterns,
        "symptom_labels": q_symptom_labels,
        "pathway_patterns": q_pathway_patterns,
        "filter_on_or_after_index": q_filter_on_or_after_index,
        "dedup_primary_key": q_dedup_primary_key,
        "dedup_primary_key_split": q_dedup_primary_key_split,
        "dedup_natural_key": q_dedup_natural_key,
        "dedup_natural_key_split": q_dedup_natural_key_split,
        "distinct_ids": q_distinct_ids,
        "semi_join_cohort": q_semi_join_cohort,
        "inner_join_named_keys": q_inner_join_named_keys,
        "left_join_summaries": q_left_join_summaries,
        "summary_per_key": q_summary_per_key,
        "group_rate_by_population": q_group_rate_by_population,
        "cohort_rate": q_cohort_rate,
        "ratio_within_group": q_ratio_within_group,
        "any_flag_per_key": q_any_flag_per_key,
        "global_summary": q_global_summary,
        "avg_stay": q_avg_stay,
        "age_bands": q_age_bands,
        "parquet_roundtrip": q_parquet_roundtrip,
        "csv_roundtrip": q_csv_roundtrip,
        "csv_roundtrip_encounters": q_csv_roundtrip_encounters,
        "csv_mixed_headers": q_csv_mixed_headers,
        "table_lifecycle": q_table_lifecycle,
        "table_roundtrip": q_table_roundtrip,
        "row_count_reconciliation": q_row_count_reconciliation,
        "ranked_members": q_ranked_members,
        "encounters_near_diagnosis": q_encounters_near_diagnosis,
        "distinct_patients_rollup": q_distinct_patients_rollup,
        "content_reconciliation": q_content_reconciliation,
        "table_refresh": q_table_refresh,
        "partition_overwrite": q_partition_overwrite,
        "bronze_as_of": q_bronze_as_of,
        "bronze_changes": q_bronze_changes,
        "csv_dirty_values": q_csv_dirty_values,
        "csv_rejected_values": q_csv_rejected_values,
        "table_profile": q_table_profile,
    }
)


# --- ingestion and the whole medallion run ------------------------------------------
def _medallion(spark, sf_dir, stages: tuple[str, ...], observations: bool = True):
    """Land the stand-ins and run the given stages in a scratch configuration."""
    root = scratch_path(spark, "q15")
    csv_paths, obs_path = standins.land_sources(spark, sf_dir, root)
    cfg = medallion.scratch_config(spark, root, csv_paths=csv_paths, observations_raw=obs_path if observations else None,
                                   spec=STANDIN_SPEC, as_of=AS_OF, drop_read=True)
    return cfg, medallion.run_medallion(spark, cfg, stages)


def q_raw_to_bronze(spark, sf_dir):
    """CSV landing of the three entities, Raw Parquet, then Bronze tables (Q3)."""
    cfg, _ = _medallion(spark, sf_dir, ("raw", "bronze"), observations=False)
    profile = table_profile({("bronze", t): spark.table(f"{cfg.bronze_ns}.{t}") for t in ingest.ENTITIES})
    return _kept(spark, profile, cfg.bronze_ns, cfg.silver_ns, cfg.gold_ns)


def q_medallion_run(spark, sf_dir):
    """CSV landing files -> Raw -> Bronze -> Silver -> Gold; rows per table (Q15)."""
    cfg, counts = _medallion(spark, sf_dir, ("raw", "bronze", "silver", "gold"))
    return _kept(spark, counts, cfg.bronze_ns, cfg.silver_ns, cfg.gold_ns)


def _table_of_run(layer: str, name: str, observations: bool = True) -> Callable[[SparkSession, str], DataFrame]:
    """A query for the rows of one table as a medallion run wrote it."""
    last = ("raw", "bronze", "silver", "gold").index(layer) + 1

    def query(spark, sf_dir):
        cfg, _ = _medallion(spark, sf_dir, ("raw", "bronze", "silver", "gold")[:last], observations)
        medallion.keep_only(spark, cfg, ns := getattr(cfg, f"{layer}_ns"), name)
        return spark.table(f"{ns}.{name}")

    return query


QUERIES.update({
    "raw_to_bronze": q_raw_to_bronze,
    "medallion_run": q_medallion_run,
    "run_bronze_encounters": _table_of_run("bronze", "encounters"),
    "run_silver_conditions": _table_of_run("silver", "conditions"),
    "run_master": _table_of_run("silver", "covid_clinical_master"),
    "run_master_no_observations": _table_of_run("silver", "covid_clinical_master", observations=False),
    "run_symptoms_outcomes": _table_of_run("gold", "symptoms_outcomes"),
    "run_pathway_summary": _table_of_run("gold", "covid_pathway_summary"),
    "run_revenue": _table_of_run("gold", "revenue_analysis"),
})

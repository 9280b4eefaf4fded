"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written in plain join-then-aggregate form, independent of the Spark plans
(which aggregate before joining), over the same stand-in definitions. Tables
``region nation customer supplier part orders lineitem events`` are the
driver's views.
"""

from __future__ import annotations

from clinlake.sources.standins import SQL as STANDIN_SQL, STANDIN_SPEC

SPEC = STANDIN_SPEC
AS_OF_SQL = "DATE '2024-12-31'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def norm(x: str) -> str:
    return f"CASE WHEN trim({x}) IN ('', 'NULL', 'null') THEN NULL ELSE trim({x}) END"


def gender(x: str) -> str:
    t = f"trim({x})"
    return (
        f"CASE WHEN upper({t}) = 'M' THEN 'Male' WHEN upper({t}) = 'F' THEN 'Female' "
        f"WHEN {t} IS NULL OR {t} = '' THEN NULL "
        f"ELSE upper(left({t}, 1)) || lower(substr({t}, 2)) END"
    )


def id_number(x: str) -> str:
    return f"coalesce(CAST({x} AS BIGINT), 0)"


def row_text(columns) -> str:
    """All values of a row as text, each with its length; NULL is ``-``."""
    parts = [f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in sorted(columns)]
    return " || ".join(parts)


def _order_all(cols) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


PATIENT_REST = [
    "birthdate", "deathdate", "ssn", "drivers", "passport", "prefix", "first_name", "last_name",
    "suffix", "maiden_name", "marital_status", "race", "ethnicity", "gender", "birthplace",
    "address", "city", "state", "county", "zip_code", "lat", "lon", "healthcare_expenses",
    "healthcare_coverage",
]
ENCOUNTER_REST = [
    "encounter_start", "encounter_stop", "patient_id", "organization_id", "provider_id", "payer_id",
    "encounter_class", "encounter_code", "encounter_description", "base_encounter_cost",
    "total_claim_cost", "payer_coverage", "reason_code", "reason_description",
]

MASTER_COLUMNS = [
    "patient_id", "patient_birthdate", "patient_deathdate", *PATIENT_REST[2:],
    "encounter_count", "last_encounter_time", "total_claim_cost_sum", "condition_count", "last_condition_date",
    "observation_count", "last_observation_time",
]

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "bronze_patients": (STANDIN_SQL["bronze_patients"], ()),
    "bronze_encounters": (STANDIN_SQL["bronze_encounters"], ()),
    "bronze_conditions": (STANDIN_SQL["bronze_conditions"], ()),
    "bronze_observations": (STANDIN_SQL["bronze_observations"], ()),
    "silver_patients": (
        f"""
SELECT * FROM (
  SELECT {norm('id')} AS patient_id, birthdate, deathdate, ssn, drivers, passport, prefix,
         "first" AS first_name, "last" AS last_name, suffix, maiden AS maiden_name,
         marital AS marital_status, race, ethnicity, {gender('gender')} AS gender, birthplace,
         address, city, state, county, zip AS zip_code, lat, lon, healthcare_expenses, healthcare_coverage
  FROM bronze_patients) t
WHERE patient_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY {_order_all(PATIENT_REST)}) = 1
""",
        ("bronze_patients",),
    ),
    "silver_encounters": (
        f"""
SELECT * FROM (
  SELECT {norm('id')} AS encounter_id, start_time AS encounter_start, stop_time AS encounter_stop,
         {norm('patient')} AS patient_id, {norm('organization')} AS organization_id,
         {norm('provider')} AS provider_id, {norm('payer')} AS payer_id,
         encounterclass AS encounter_class, code AS encounter_code, description AS encounter_description,
         base_encounter_cost, total_claim_cost, payer_coverage,
         reasoncode AS reason_code, reasondescription AS reason_description
  FROM bronze_encounters) t
WHERE encounter_id IS NOT NULL AND patient_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY encounter_id ORDER BY {_order_all(ENCOUNTER_REST)}) = 1
""",
        ("bronze_encounters",),
    ),
    "silver_conditions": (
        f"""
SELECT DISTINCT * FROM (
  SELECT {norm('patient')} AS patient_id, {norm('encounter')} AS encounter_id,
         start_date AS condition_start_date, stop_date AS condition_stop_date,
         code AS condition_code, description AS condition_description
  FROM bronze_conditions) t
WHERE patient_id IS NOT NULL AND encounter_id IS NOT NULL
""",
        ("bronze_conditions",),
    ),
    "silver_observations": (
        f"""
SELECT DISTINCT * FROM (
  SELECT {norm('patient')} AS patient_id, {norm('encounter')} AS encounter_id,
         CAST("date" AS TIMESTAMP) AS observation_time, code AS observation_code,
         description AS observation_description, "value" AS observation_value
  FROM bronze_observations) t
WHERE patient_id IS NOT NULL
""",
        ("bronze_observations",),
    ),
    "cohort_codes": (
        f"""
SELECT DISTINCT patient_id FROM silver_conditions
WHERE condition_code IN {in_list(SPEC.cohort.condition_codes)}
""",
        ("silver_conditions",),
    ),
    "cohort_obs": (
        f"""
SELECT DISTINCT patient_id FROM silver_observations
WHERE regexp_matches(upper(coalesce(observation_value, '')), {q(SPEC.cohort.value_pattern)})
   OR contains(upper(coalesce(observation_description, '')), {q(SPEC.cohort.description_text)})
""",
        ("silver_observations",),
    ),
    "cohort": (
        "SELECT patient_id FROM cohort_codes UNION SELECT patient_id FROM cohort_obs",
        ("cohort_codes", "cohort_obs"),
    ),
    "enc_summary": (
        """
SELECT patient_id, count(*) AS encounter_count, max(encounter_start) AS last_encounter_time,
       CAST(sum(coalesce(total_claim_cost, 0)) AS DECIMAL(18,2)) AS total_claim_cost_sum
FROM silver_encounters WHERE patient_id IN (SELECT patient_id FROM cohort) GROUP BY patient_id
""",
        ("silver_encounters", "cohort"),
    ),
    "cond_summary": (
        """
SELECT patient_id, count(*) AS condition_count, max(condition_start_date) AS last_condition_date
FROM silver_conditions WHERE patient_id IN (SELECT patient_id FROM cohort) GROUP BY patient_id
""",
        ("silver_conditions", "cohort"),
    ),
    "obs_summary": (
        """
SELECT patient_id, count(*) AS observation_count, max(observation_time) AS last_observation_time
FROM silver_observations WHERE patient_id IN (SELECT patient_id FROM cohort) GROUP BY patient_id
""",
        ("silver_observations", "cohort"),
    ),
    "master": (
        """
SELECT p.patient_id, p.birthdate AS patient_birthdate, p.deathdate AS patient_deathdate,
       p.ssn, p.drivers, p.passport, p.prefix, p.first_name, p.last_name, p.suffix, p.maiden_name,
       p.marital_status, p.race, p.ethnicity, p.gender, p.birthplace, p.address, p.city, p.state,
       p.county, p.zip_code, p.lat, p.lon, p.healthcare_expenses, p.healthcare_coverage,
       coalesce(e.encounter_count, 0) AS encounter_count, e.last_encounter_time,
       coalesce(e.total_claim_cost_sum, CAST(0 AS DECIMAL(18,2))) AS total_claim_cost_sum,
       coalesce(c.condition_count, 0) AS condition_count, c.last_condition_date,
       coalesce(o.observation_count, 0) AS observation_count, o.last_observation_time
FROM silver_patients p
JOIN cohort k ON p.patient_id = k.patient_id
LEFT JOIN enc_summary e ON p.patient_id = e.patient_id
LEFT JOIN cond_summary c ON p.patient_id = c.patient_id
LEFT JOIN obs_summary o ON p.patient_id = o.patient_id
""",
        ("silver_patients", "cohort", "enc_summary", "cond_summary", "obs_summary"),
    ),
}


def with_ctes(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][1]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    parts = [f"{n} AS ({CTES[n][0].strip()})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


MASTER_NO_OBS = """
SELECT p.patient_id, p.birthdate AS patient_birthdate, p.deathdate AS patient_deathdate,
       p.ssn, p.drivers, p.passport, p.prefix, p.first_name, p.last_name, p.suffix, p.maiden_name,
       p.marital_status, p.race, p.ethnicity, p.gender, p.birthplace, p.address, p.city, p.state,
       p.county, p.zip_code, p.lat, p.lon, p.healthcare_expenses, p.healthcare_coverage,
       coalesce(e.encounter_count, 0) AS encounter_count, e.last_encounter_time,
       coalesce(e.total_claim_cost_sum, CAST(0 AS DECIMAL(18,2))) AS total_claim_cost_sum,
       coalesce(c.condition_count, 0) AS condition_count, c.last_condition_date,
       CAST(0 AS BIGINT) AS observation_count, CAST(NULL AS TIMESTAMP) AS last_observation_time
FROM silver_patients p
JOIN cohort_codes k ON p.patient_id = k.patient_id
LEFT JOIN (SELECT patient_id, count(*) AS encounter_count, max(encounter_start) AS last_encounter_time,
                  CAST(sum(coalesce(total_claim_cost, 0)) AS DECIMAL(18,2)) AS total_claim_cost_sum
           FROM silver_encounters GROUP BY patient_id) e ON p.patient_id = e.patient_id
LEFT JOIN (SELECT patient_id, count(*) AS condition_count, max(condition_start_date) AS last_condition_date
           FROM silver_conditions GROUP BY patient_id) c ON p.patient_id = c.patient_id
"""


def _label_case(col: str) -> str:
    whens = " ".join(
        f"WHEN regexp_matches({col}, {q('(?i)(' + pat + ')')}) THEN {q(label)}" for label, pat in SPEC.symptoms.labels
    )
    return f"CASE {whens} ELSE {col} END"


SYMPTOMS_OUTCOMES = f"""
, people AS (SELECT patient_id, patient_deathdate IS NULL AS is_survivor FROM master),
pop AS (SELECT is_survivor, count(*) AS total_group_population FROM people GROUP BY is_survivor),
idx AS (SELECT patient_id, min(condition_start_date) AS covid_diagnosis_date FROM silver_conditions
        WHERE condition_code IN {in_list(SPEC.cohort.condition_codes)} GROUP BY patient_id),
filt AS (SELECT * FROM silver_conditions
         WHERE regexp_matches(condition_description, {q('(?i)(' + SPEC.symptoms.filter_pattern + ')')})),
post AS (SELECT p.patient_id, p.is_survivor, {_label_case('f.condition_description')} AS condition_category
         FROM people p JOIN idx i ON p.patient_id = i.patient_id JOIN filt f ON p.patient_id = f.patient_id
         WHERE f.condition_start_date >= i.covid_diagnosis_date),
agg AS (SELECT condition_category, is_survivor, count(DISTINCT patient_id) AS patient_count
        FROM post GROUP BY condition_category, is_survivor)
SELECT a.condition_category, a.is_survivor, a.patient_count, pop.total_group_population,
       round(a.patient_count / pop.total_group_population * 100, 2) AS rate_percentage
FROM agg a JOIN pop ON a.is_survivor = pop.is_survivor
"""

MORTALITY_DEMOGRAPHICS = """
SELECT CASE WHEN patient_birthdate IS NULL THEN 'Unknown'
            WHEN age <= 10 THEN '0-10' WHEN age <= 20 THEN '11-20' WHEN age <= 30 THEN '21-30'
            WHEN age <= 40 THEN '31-40' WHEN age <= 50 THEN '41-50' WHEN age <= 60 THEN '51-60'
            WHEN age <= 70 THEN '61-70' WHEN age <= 80 THEN '71-80' ELSE '80+' END AS "Age_Range",
       gender, count(patient_id) AS mortality_count
FROM (SELECT *, CAST(year(patient_deathdate) - year(patient_birthdate) AS INTEGER) AS age
      FROM master WHERE patient_deathdate IS NOT NULL) d
GROUP BY 1, 2
"""

HOSPITALIZATION_WORKLOAD = f"""
SELECT encounter_description,
       count(DISTINCT patient_id) AS patient_count,
       round(avg(date_diff('day', CAST(encounter_start AS DATE), CAST(encounter_stop AS DATE))), 2) AS avg_length_of_stay_days,
       round(count(DISTINCT patient_id) / (SELECT count(*) FROM master) * 100, 2) AS percentage
FROM silver_encounters
WHERE encounter_code IN {in_list(SPEC.admissions.encounter_codes)}
  AND patient_id IN (SELECT patient_id FROM master)
GROUP BY encounter_description
"""

MORTALITY_BY_DEMOGRAPHICS = f"""
SELECT age_group, gender, count(patient_id) AS total_covid_patients,
       CAST(sum(CASE WHEN patient_deathdate IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS total_deaths,
       round(sum(CASE WHEN patient_deathdate IS NOT NULL THEN 1 ELSE 0 END) / count(patient_id) * 100, 2)
         AS mortality_rate_percent
FROM (SELECT *, CASE WHEN age <= 18 THEN '0-18' WHEN age <= 34 THEN '19-34' WHEN age <= 49 THEN '35-49'
                     WHEN age <= 64 THEN '50-64' WHEN age >= 65 THEN '65+' ELSE 'Unknown' END AS age_group
      FROM (SELECT *, CASE WHEN patient_deathdate IS NOT NULL THEN year(patient_deathdate) - year(patient_birthdate)
                           ELSE year({AS_OF_SQL}) - year(patient_birthdate) END AS age FROM master) a) b
GROUP BY age_group, gender
"""


def _like_any(col: str, patterns) -> str:
    return " OR ".join(f"lower({col}) LIKE {q(p)}" for p in patterns)


PATHWAY_SUMMARY = f"""
, cp AS (SELECT patient_id, CASE WHEN patient_deathdate IS NOT NULL THEN 1 ELSE 0 END AS is_dead,
               CASE WHEN patient_deathdate IS NULL THEN 1 ELSE 0 END AS is_recovered FROM master),
enc AS (SELECT cp.patient_id,
               max(CASE WHEN {_like_any('e.encounterclass', SPEC.pathway.inpatient)} THEN 1 ELSE 0 END) AS hospitalized_flag,
               max(CASE WHEN {_like_any('e.encounterclass', SPEC.pathway.icu)} THEN 1 ELSE 0 END) AS icu_flag
        FROM bronze_encounters e JOIN cp ON {norm('e.patient')} = cp.patient_id GROUP BY cp.patient_id),
vent AS (SELECT cp.patient_id,
                max(CASE WHEN {_like_any('c.description', SPEC.pathway.ventilation)} THEN 1 ELSE 0 END) AS vent_flag
         FROM bronze_conditions c JOIN cp ON {norm('c.patient')} = cp.patient_id GROUP BY cp.patient_id),
mp AS (SELECT cp.patient_id, cp.is_dead, cp.is_recovered,
              coalesce(enc.hospitalized_flag, 0) AS hospitalized_flag, coalesce(enc.icu_flag, 0) AS icu_flag,
              coalesce(vent.vent_flag, 0) AS vent_flag
       FROM cp LEFT JOIN enc ON cp.patient_id = enc.patient_id LEFT JOIN vent ON cp.patient_id = vent.patient_id)
SELECT count(patient_id) AS total_covid_cases,
       CAST(sum(CASE WHEN hospitalized_flag = 0 THEN 1 ELSE 0 END) AS BIGINT) AS home_isolation_cases,
       CAST(sum(hospitalized_flag) AS BIGINT) AS hospitalized_cases,
       CAST(sum(icu_flag) AS BIGINT) AS icu_cases,
       CAST(sum(vent_flag) AS BIGINT) AS ventilation_cases,
       CAST(sum(is_recovered) AS BIGINT) AS recovered_cases,
       CAST(sum(is_dead) AS BIGINT) AS death_cases
FROM mp
"""

REVENUE_MONTHLY = """
SELECT CAST(date_trunc('month', e.encounter_start) AS DATE) AS "month", p.state,
       CAST(sum(e.total_claim_cost) AS DECIMAL(38,2)) AS total_claim_cost,
       CAST(sum(e.payer_coverage) AS DECIMAL(38,2)) AS payer_coverage,
       count(*) AS encounter_count
FROM silver_encounters e JOIN silver_patients p ON e.patient_id = p.patient_id
GROUP BY 1, 2
"""

WEEKLY_TREND = f"""
SELECT CAST(date_trunc('week', i.d) AS DATE) AS week_start, p.gender, count(*) AS new_cases
FROM (SELECT patient_id, min(condition_start_date) AS d FROM silver_conditions
      WHERE condition_code IN {in_list(SPEC.cohort.condition_codes)} GROUP BY patient_id) i
JOIN silver_patients p ON i.patient_id = p.patient_id
WHERE i.d IS NOT NULL
GROUP BY 1, 2
"""


def _gold(body: str, *needs: str) -> str:
    # bodies starting with ", name AS (...)" extend the CTE list
    text = with_ctes("SELECT 1", *needs)
    head = text[: text.rfind("SELECT 1")].rstrip()
    return head + "\n" + body.strip()


ORACLE_SQL: dict[str, str] = {
    "clean_patients": with_ctes("SELECT * FROM silver_patients", "silver_patients"),
    "clean_encounters": with_ctes("SELECT * FROM silver_encounters", "silver_encounters"),
    "clean_conditions": with_ctes("SELECT * FROM silver_conditions", "silver_conditions"),
    "clean_observations": with_ctes("SELECT * FROM silver_observations", "silver_observations"),
    "cohort_union": with_ctes("SELECT patient_id FROM cohort", "cohort"),
    "clinical_master": with_ctes("SELECT * FROM master", "master"),
    "clinical_master_no_observations": with_ctes(
        MASTER_NO_OBS, "silver_patients", "silver_encounters", "silver_conditions", "cohort_codes"
    ),
    "symptoms_outcomes": _gold(SYMPTOMS_OUTCOMES, "master", "silver_conditions"),
    "mortality_demographics": _gold(MORTALITY_DEMOGRAPHICS, "master"),
    "hospitalization_workload": _gold(HOSPITALIZATION_WORKLOAD, "master", "silver_encounters"),
    "mortality_by_demographics": _gold(MORTALITY_BY_DEMOGRAPHICS, "master"),
    "pathway_summary": _gold(PATHWAY_SUMMARY, "master", "bronze_encounters", "bronze_conditions"),
    "revenue_monthly_region": _gold(REVENUE_MONTHLY, "silver_encounters", "silver_patients"),
    "weekly_trend": _gold(WEEKLY_TREND, "silver_conditions", "silver_patients"),
}


# --- operator-level queries -----------------------------------------------------
PATHWAY_FLAGS = PATHWAY_SUMMARY[: PATHWAY_SUMMARY.rfind("SELECT count(patient_id)")].rstrip() + """
SELECT patient_id, is_dead, is_recovered, hospitalized_flag, icu_flag, vent_flag,
       CASE WHEN hospitalized_flag = 0 THEN 1 ELSE 0 END AS home_isolation_flag
FROM mp
"""

_PROFILE_PARTS = [
    ("bronze", "patients", "bronze_patients", 25),
    ("bronze", "encounters", "bronze_encounters", 15),
    ("bronze", "conditions", "bronze_conditions", 6),
    ("bronze", "observations", "bronze_observations", 6),
    ("silver", "patients", "silver_patients", 25),
    ("silver", "encounters", "silver_encounters", 15),
    ("silver", "conditions", "silver_conditions", 6),
    ("silver", "observations", "silver_observations", 6),
    ("silver", "covid_clinical_master", "master", 32),
]
TABLE_PROFILE = "\nUNION ALL\n".join(
    f"SELECT '{st}' AS stage, '{nm}' AS table_name, count(*) AS row_count, CAST({nc} AS INTEGER) AS column_count FROM {cte}"
    for st, nm, cte, nc in _PROFILE_PARTS
)

_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]

ORACLE_SQL.update(
    {
        "scan_parquet_project": """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(12,2)) AS extended_price,
       CAST(l_shipdate AS DATE) AS ship_date, l_returnflag AS return_flag,
       CAST(year(l_shipdate) AS INTEGER) AS ship_year
FROM lineitem
""",
        "rename_by_map": with_ctes(
            """
SELECT id AS "Id", start_time AS "START", stop_time AS "STOP", patient AS "PATIENT", organization AS "ORGANIZATION",
       provider AS "PROVIDER", payer AS "PAYER", encounterclass AS "ENCOUNTERCLASS", code AS "CODE",
       description AS "DESCRIPTION", base_encounter_cost AS "BASE_ENCOUNTER_COST", total_claim_cost AS "TOTAL_CLAIM_COST",
       payer_coverage AS "PAYER_COVERAGE", reasoncode AS "REASONCODE", reasondescription AS "REASONDESCRIPTION"
FROM bronze_encounters
""",
            "bronze_encounters",
        ),
        "flexible_projection": with_ctes(
            f"""
SELECT DISTINCT * FROM (
  SELECT {norm('patient')} AS patient_id, {norm('encounter')} AS encounter_id,
         CAST(CAST("date" AS DATE) + 1 AS TIMESTAMP) AS observation_time, code AS observation_code,
         description AS observation_description, "value" AS observation_value
  FROM bronze_observations) t
WHERE patient_id IS NOT NULL
""",
            "bronze_observations",
        ),
        "flexible_projection_no_time": with_ctes(
            f"""
SELECT DISTINCT * FROM (
  SELECT {norm('patient')} AS patient_id, {norm('encounter')} AS encounter_id,
         CAST(NULL AS TIMESTAMP) AS observation_time, code AS observation_code,
         description AS observation_description, "value" AS observation_value
  FROM bronze_observations) t
WHERE patient_id IS NOT NULL
""",
            "bronze_observations",
        ),
        "normalize_identifier": with_ctes(
            f"SELECT id AS encounter_id, patient AS raw_patient, {norm('patient')} AS patient_id FROM bronze_encounters",
            "bronze_encounters",
        ),
        "normalize_gender": with_ctes(
            f"SELECT ssn, gender AS raw_gender, {gender('gender')} AS gender FROM bronze_patients",
            "bronze_patients",
        ),
        "try_parse_dates": """
SELECT o_orderkey, date_text, time_text, try_cast(date_text AS DATE) AS parsed_date,
       try_cast(time_text AS TIMESTAMP) AS parsed_time
FROM (SELECT o_orderkey,
             CASE WHEN o_orderkey % 7 = 0 THEN concat(CAST(year(o_orderdate) AS VARCHAR), '-13-45')
                  ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date_text,
             CASE WHEN o_orderkey % 11 = 0 THEN 'not a time' ELSE CAST(o_orderdate AS VARCHAR) END AS time_text
      FROM orders) t
""",
        "filter_keys_and_codes": with_ctes(
            f"""
SELECT encounter_id, patient_id, encounter_code, encounter_start FROM silver_encounters
WHERE patient_id IS NOT NULL AND encounter_code IN {in_list(SPEC.admissions.encounter_codes)}
  AND encounter_stop IS NULL
""",
            "silver_encounters",
        ),
        "filter_text_patterns": with_ctes(
            f"""
SELECT patient_id, observation_time, observation_value FROM silver_observations
WHERE regexp_matches(upper(coalesce(observation_value, '')), {q(SPEC.cohort.value_pattern)})
   OR contains(upper(coalesce(observation_description, '')), {q(SPEC.cohort.description_text)})
""",
            "silver_observations",
        ),
        "symptom_labels": with_ctes(
            f"""
SELECT patient_id, encounter_id, condition_start_date, condition_description,
       {_label_case('condition_description')} AS condition_category
FROM silver_conditions
WHERE regexp_matches(condition_description, {q('(?i)(' + SPEC.symptoms.filter_pattern + ')')})
""",
            "silver_conditions",
        ),
        "pathway_patterns": with_ctes(
            f"""
SELECT encounter_id,
       CASE WHEN {_like_any('encounter_class', SPEC.pathway.inpatient)} THEN 1 ELSE 0 END AS is_hospitalized,
       CASE WHEN {_like_any('encounter_class', SPEC.pathway.icu)} THEN 1 ELSE 0 END AS is_icu
FROM silver_encounters
""",
            "silver_encounters",
        ),
        "filter_on_or_after_index": with_ctes(
            f"""
SELECT c.patient_id, c.encounter_id, c.condition_code, c.condition_start_date, i.covid_diagnosis_date
FROM silver_conditions c
JOIN (SELECT patient_id, min(condition_start_date) AS covid_diagnosis_date FROM silver_conditions
      WHERE condition_code IN {in_list(SPEC.cohort.condition_codes)} GROUP BY patient_id) i
  ON c.patient_id = i.patient_id
WHERE c.condition_start_date >= i.covid_diagnosis_date
""",
            "silver_conditions",
        ),
        "dedup_primary_key": f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_order_all(_LI_REST)}) = 1
""",
        "dedup_primary_key_split": f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_order_all(_LI_REST)}) = 1
""",
        "dedup_natural_key": with_ctes("SELECT DISTINCT * FROM bronze_conditions", "bronze_conditions"),
        "dedup_natural_key_split": with_ctes("SELECT DISTINCT * FROM bronze_conditions", "bronze_conditions"),
        "distinct_ids": with_ctes("SELECT DISTINCT patient_id FROM silver_encounters", "silver_encounters"),
        "semi_join_cohort": with_ctes(
            """
SELECT encounter_id, patient_id, encounter_start FROM silver_encounters
WHERE patient_id IN (SELECT patient_id FROM cohort)
""",
            "silver_encounters", "cohort",
        ),
        "inner_join_named_keys": with_ctes(
            f"""
SELECT e.id AS encounter_id, m.patient_id, e.encounterclass, m.gender
FROM bronze_encounters e JOIN master m ON {norm('e.patient')} = m.patient_id
""",
            "bronze_encounters", "master",
        ),
        "left_join_summaries": with_ctes(
            """
SELECT p.patient_id, coalesce(e.encounter_count, 0) AS encounter_count, e.total_claim_cost_sum,
       coalesce(c.condition_count, 0) AS condition_count, c.last_condition_date
FROM silver_patients p
LEFT JOIN (SELECT patient_id, count(*) AS encounter_count,
                  CAST(sum(coalesce(total_claim_cost, 0)) AS DECIMAL(18,2)) AS total_claim_cost_sum
           FROM silver_encounters GROUP BY patient_id) e ON p.patient_id = e.patient_id
LEFT JOIN (SELECT patient_id, count(*) AS condition_count, max(condition_start_date) AS last_condition_date
           FROM silver_conditions GROUP BY patient_id) c ON p.patient_id = c.patient_id
""",
            "silver_patients", "silver_encounters", "silver_conditions",
        ),
        "summary_per_key": with_ctes(
            """
SELECT patient_id, count(*) AS encounter_count, max(encounter_start) AS last_encounter_time,
       CAST(sum(coalesce(total_claim_cost, 0)) AS DECIMAL(18,2)) AS total_claim_cost_sum
FROM silver_encounters GROUP BY patient_id
""",
            "silver_encounters",
        ),
        "group_rate_by_population": _gold(
            """
, people AS (SELECT patient_id, patient_deathdate IS NULL AS is_survivor FROM master),
pop AS (SELECT is_survivor, count(*) AS population FROM people GROUP BY is_survivor),
cnt AS (SELECT is_survivor, count(*) AS patients_with_encounters FROM people
        WHERE patient_id IN (SELECT patient_id FROM silver_encounters) GROUP BY is_survivor)
SELECT cnt.is_survivor, cnt.patients_with_encounters, pop.population,
       round(cnt.patients_with_encounters / pop.population * 100, 2) AS rate_percentage
FROM cnt LEFT JOIN pop ON cnt.is_survivor = pop.is_survivor
""",
            "master", "silver_encounters",
        ),
        "cohort_rate": _gold(
            """
SELECT state, count(*) AS patient_count,
       round(count(*) / (SELECT count(*) FROM master) * 100, 2) AS percentage
FROM master GROUP BY state
""",
            "master",
        ),
        "ratio_within_group": _gold(
            """
SELECT state, count(patient_id) AS patients,
       CAST(sum(CASE WHEN patient_deathdate IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS deaths,
       round(sum(CASE WHEN patient_deathdate IS NOT NULL THEN 1 ELSE 0 END) / count(patient_id) * 100, 2)
         AS death_rate_percent
FROM master GROUP BY state
""",
            "master",
        ),
        "any_flag_per_key": _gold(PATHWAY_FLAGS, "master", "bronze_encounters", "bronze_conditions"),
        "global_summary": with_ctes(
            """
SELECT count(*) AS encounter_count, CAST(sum(total_claim_cost) AS DECIMAL(38,2)) AS total_claim_cost,
       min(encounter_start) AS first_encounter_start, max(encounter_stop) AS last_encounter_stop
FROM silver_encounters
""",
            "silver_encounters",
        ),
        "avg_stay": with_ctes(
            """
SELECT encounter_class, count(*) AS encounters,
       round(avg(date_diff('day', CAST(encounter_start AS DATE), CAST(encounter_stop AS DATE))), 2) AS avg_stay_days
FROM silver_encounters GROUP BY encounter_class
""",
            "silver_encounters",
        ),
        "age_bands": _gold(
            f"""
SELECT patient_id, age,
       CASE WHEN patient_birthdate IS NULL THEN 'Unknown'
            WHEN age <= 10 THEN '0-10' WHEN age <= 20 THEN '11-20' WHEN age <= 30 THEN '21-30'
            WHEN age <= 40 THEN '31-40' WHEN age <= 50 THEN '41-50' WHEN age <= 60 THEN '51-60'
            WHEN age <= 70 THEN '61-70' WHEN age <= 80 THEN '71-80' ELSE '80+' END AS decade_band,
       CASE WHEN age <= 18 THEN '0-18' WHEN age <= 34 THEN '19-34' WHEN age <= 49 THEN '35-49'
            WHEN age <= 64 THEN '50-64' WHEN age >= 65 THEN '65+' ELSE 'Unknown' END AS clinical_band
FROM (SELECT patient_id, patient_birthdate,
             CAST(CASE WHEN patient_deathdate IS NOT NULL THEN year(patient_deathdate) - year(patient_birthdate)
                       ELSE year({AS_OF_SQL}) - year(patient_birthdate) END AS INTEGER) AS age
      FROM master) a
""",
            "master",
        ),
        "parquet_roundtrip": with_ctes("SELECT * FROM bronze_patients", "bronze_patients"),
        # CSV with default options reads empty text as NULL
        "csv_roundtrip": with_ctes(
            "SELECT * REPLACE (nullif(gender, '') AS gender) FROM bronze_patients", "bronze_patients"
        ),
        "csv_roundtrip_encounters": with_ctes("SELECT * FROM bronze_encounters", "bronze_encounters"),
        "csv_mixed_headers": with_ctes("SELECT * FROM bronze_conditions", "bronze_conditions"),
        "csv_dirty_values": with_ctes(
            f"""
SELECT * REPLACE (CASE WHEN {id_number('id')} % 13 <> 0 THEN start_time END AS start_time, CASE WHEN {id_number('id')} % 19 <> 0 THEN stop_time END AS stop_time,
                  CASE WHEN {id_number('id')} % 17 <> 0 THEN total_claim_cost END AS total_claim_cost) FROM bronze_encounters
""",
            "bronze_encounters",
        ),
        "csv_rejected_values": with_ctes(
            f"""
SELECT id, reasoncode, 'start_time' AS column_name, 'soon' AS value, 'timestamp_ntz' AS wanted FROM bronze_encounters WHERE {id_number('id')} % 13 = 0
UNION ALL SELECT id, reasoncode, 'stop_time', '2024-02-30T10:00:00', 'timestamp_ntz' FROM bronze_encounters WHERE {id_number('id')} % 19 = 0
UNION ALL SELECT id, reasoncode, 'total_claim_cost', 'n/a, see "note"', 'decimal(12,2)' FROM bronze_encounters WHERE {id_number('id')} % 17 = 0
""",
            "bronze_encounters",
        ),
        "table_lifecycle": with_ctes(
            """
SELECT step, table_name, 'MANAGED' AS type, 'parquet' AS provider, n AS rows
FROM (SELECT 'patients' AS table_name, count(*) AS n FROM bronze_patients
      UNION ALL SELECT 'conditions', count(*) FROM bronze_conditions) t,
     (VALUES ('written'), ('dropped')) s(step)
WHERE step = 'written' OR table_name = 'patients'
""",
            "bronze_patients", "bronze_conditions",
        ),
        "table_roundtrip": with_ctes("SELECT * FROM master", "master"),
        "row_count_reconciliation": with_ctes(
            """
SELECT 'covid_clinical_master' AS table_name, count(*) AS expected_rows, count(*) AS persisted_rows, true AS ok
FROM master
""",
            "master",
        ),
        "ranked_members": with_ctes(
            """
SELECT patient_id, state, total_claim_cost_sum, row_number() OVER (ORDER BY total_claim_cost_sum DESC, patient_id) AS cost_rank FROM master
""",
            "master",
        ),
        "encounters_near_diagnosis": with_ctes(
            f"""
SELECT encounter_id, patient_id, encounter_start FROM silver_encounters e
WHERE EXISTS (SELECT 1 FROM silver_conditions c WHERE c.patient_id = e.patient_id
              AND c.condition_code IN {in_list(SPEC.cohort.condition_codes)}
              AND abs(date_diff('day', CAST(c.condition_start_date AS DATE), CAST(e.encounter_start AS DATE))) <= 30)
""",
            "silver_encounters", "silver_conditions",
        ),
        "distinct_patients_rollup": with_ctes(
            """
SELECT encounter_description, CAST(year(encounter_start) AS INTEGER) AS year, CAST(month(encounter_start) AS INTEGER) AS month,
       count(DISTINCT patient_id) AS patients FROM silver_encounters GROUP BY ALL
UNION ALL SELECT encounter_description, CAST(year(encounter_start) AS INTEGER), NULL, count(DISTINCT patient_id) FROM silver_encounters GROUP BY ALL
UNION ALL SELECT NULL, CAST(year(encounter_start) AS INTEGER), NULL, count(DISTINCT patient_id) FROM silver_encounters GROUP BY ALL
""",
            "silver_encounters",
        ),
        "content_reconciliation": with_ctes(
            f"""
SELECT 'covid_clinical_master' AS table_name, n AS written_rows, c AS written_checksum, n AS persisted_rows, c AS persisted_checksum, true AS ok
FROM (SELECT count(*) AS n, CAST(coalesce(sum(CAST('0x' || left(md5({row_text(MASTER_COLUMNS)}), 15) AS BIGINT)), 0) AS DECIMAL(38,0)) AS c
      FROM master) t
""",
            "master",
        ),
        "table_refresh": with_ctes(
            """
SELECT city, count(*) AS rows, max(ssn) AS last_ssn, 'first' AS step, 4 AS columns FROM bronze_patients GROUP BY city
UNION ALL SELECT city, count(*), max(ssn), 'other rows', 4 FROM bronze_patients WHERE zip < '01000' GROUP BY city
UNION ALL SELECT city, count(*), max(ssn), 'other columns', 2 FROM bronze_patients WHERE city <> 'City1' GROUP BY city
""",
            "bronze_patients",
        ),
        "partition_overwrite": with_ctes(
            """
SELECT id, start_time, CAST(total_claim_cost + CASE WHEN year(start_time) IN (1994, 1996) THEN 100 ELSE 0 END AS DECIMAL(12,2)) AS total_claim_cost,
       CAST(year(start_time) AS INTEGER) AS start_year
FROM bronze_encounters WHERE year(start_time) NOT IN (1994, 1996) OR CAST(id AS BIGINT) % 10 <> 0
""",
            "bronze_encounters",
        ),
        "bronze_as_of": with_ctes(
            f"""
SELECT *, CAST(1 AS BIGINT) AS load FROM bronze_conditions WHERE {id_number('encounter')} % 5 <> 0
UNION ALL SELECT * REPLACE (CASE WHEN {id_number('encounter')} % 3 = 0 THEN upper(description) ELSE description END AS description), 2
FROM bronze_conditions WHERE {id_number('encounter')} % 7 <> 0
UNION ALL SELECT *, 3 FROM bronze_conditions
UNION ALL SELECT *, 3 FROM bronze_conditions WHERE {id_number('encounter')} % 11 = 0
""",
            "bronze_conditions",
        ),
        "bronze_changes": with_ctes(
            f"""
, loads AS (
  SELECT *, 1 AS load FROM bronze_encounters WHERE {id_number('id')} % 5 <> 0
  UNION ALL SELECT * REPLACE (CASE WHEN {id_number('id')} % 3 = 0 THEN CAST(total_claim_cost + 10 AS DECIMAL(12,2)) ELSE total_claim_cost END
                              AS total_claim_cost), 2 FROM bronze_encounters WHERE {id_number('id')} % 7 <> 0
  UNION ALL SELECT *, 3 FROM bronze_encounters),
sides AS (SELECT *, 2 AS step FROM loads WHERE load <= 2 UNION ALL SELECT *, 3 FROM loads WHERE load >= 2),
counted AS (SELECT step, id, count(*) FILTER (load < step) AS before, count(*) FILTER (load = step) AS now
            FROM sides GROUP BY step, id, start_time, stop_time, patient, organization, provider, payer, encounterclass, code, description,
                       base_encounter_cost, total_claim_cost, payer_coverage, reasoncode, reasondescription),
keyed AS (SELECT step, id, sum(before) FILTER (before <> now) AS ended, sum(now) FILTER (before <> now) AS begun,
                 sum(before) AS all_before, sum(now) AS all_now FROM counted GROUP BY step, id)
SELECT id, CASE WHEN all_before = 0 THEN 'insert' WHEN all_now = 0 THEN 'delete' ELSE 'update' END AS change,
       CAST(ended AS BIGINT) AS rows_ended, CAST(begun AS BIGINT) AS rows_begun, CAST(step AS BIGINT) AS load
FROM keyed WHERE ended + begun > 0
""",
            "bronze_encounters",
        ),
        "table_profile": with_ctes(
            TABLE_PROFILE,
            "bronze_patients", "bronze_encounters", "bronze_conditions", "bronze_observations",
            "silver_patients", "silver_encounters", "silver_conditions", "silver_observations", "master",
        ),
    }
)


# --- ingestion and the whole medallion run --------------------------------------
def _count_of(sql: str) -> str:
    return f"(SELECT count(*) FROM ({sql.strip()}) x)"


RAW_TO_BRONZE = "\nUNION ALL\n".join(
    f"SELECT 'bronze' AS stage, '{t}' AS table_name, {_count_of(with_ctes(f'SELECT * FROM bronze_{t}', f'bronze_{t}'))} "
    f"AS row_count, CAST({n} AS INTEGER) AS column_count"
    for t, n in (("patients", 25), ("encounters", 15), ("conditions", 6))
)

_MEDALLION_PARTS = [
    ("raw", "patients", with_ctes("SELECT * FROM bronze_patients", "bronze_patients")),
    ("raw", "encounters", with_ctes("SELECT * FROM bronze_encounters", "bronze_encounters")),
    ("raw", "conditions", with_ctes("SELECT * FROM bronze_conditions", "bronze_conditions")),
    ("bronze", "patients", with_ctes("SELECT * FROM bronze_patients", "bronze_patients")),
    ("bronze", "encounters", with_ctes("SELECT * FROM bronze_encounters", "bronze_encounters")),
    ("bronze", "conditions", with_ctes("SELECT * FROM bronze_conditions", "bronze_conditions")),
    ("bronze", "observations", with_ctes("SELECT * FROM bronze_observations", "bronze_observations")),
    ("silver", "patients", ORACLE_SQL["clean_patients"]),
    ("silver", "encounters", ORACLE_SQL["clean_encounters"]),
    ("silver", "conditions", ORACLE_SQL["clean_conditions"]),
    ("silver", "observations", ORACLE_SQL["clean_observations"]),
    ("silver", "covid_clinical_master", ORACLE_SQL["clinical_master"]),
    ("gold", "symptoms_outcomes", ORACLE_SQL["symptoms_outcomes"]),
    ("gold", "mortality_demographics", ORACLE_SQL["mortality_demographics"]),
    ("gold", "hospitalization_workload", ORACLE_SQL["hospitalization_workload"]),
    ("gold", "mortality_by_demographics", ORACLE_SQL["mortality_by_demographics"]),
    ("gold", "covid_pathway_summary", ORACLE_SQL["pathway_summary"]),
    ("gold", "revenue_analysis", ORACLE_SQL["revenue_monthly_region"]),
    ("gold", "covid_trends", ORACLE_SQL["weekly_trend"]),
]
MEDALLION_RUN = "\nUNION ALL\n".join(
    f"SELECT '{st}' AS stage, '{nm}' AS table_name, {_count_of(sql)} AS row_count"
    for st, nm, sql in _MEDALLION_PARTS
)

ORACLE_SQL.update({"raw_to_bronze": RAW_TO_BRONZE, "medallion_run": MEDALLION_RUN})
ORACLE_SQL.update({
    "run_bronze_encounters": with_ctes("SELECT * FROM bronze_encounters", "bronze_encounters"),
    "run_silver_conditions": ORACLE_SQL["clean_conditions"],
    "run_master": ORACLE_SQL["clinical_master"],
    "run_master_no_observations": ORACLE_SQL["clinical_master_no_observations"],
    "run_symptoms_outcomes": ORACLE_SQL["symptoms_outcomes"],
    "run_pathway_summary": ORACLE_SQL["pathway_summary"],
    "run_revenue": ORACLE_SQL["revenue_monthly_region"],
})

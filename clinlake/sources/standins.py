"""Stand-in source entities derived from the driver's parquet tables.

The test data is a TPC-H-like star schema, not hospital data. These
projections turn it into the three source entities (plus observations) in
their source (Bronze) layout, with the dirt the cleaning steps exist for:
padded and missing identifiers, a duplicated patient id, blank and lower-case
genders, missing birth dates, encounters without a stop time, amended
encounters under the same id, conditions without an encounter, conditions and
observations that come twice, positive findings in descriptions. Every stand-in is a plain Spark plan over the given
tables, so its work grows with them. No stand-in drops, samples or caps
rows: the ``%`` expressions below only decide which rows carry dirty values.

| entity       | from                                   |
| ------------ | -------------------------------------- |
| patients     | customer ⟕ nation ⟕ region             |
| encounters   | orders ⟕ (max l_shipdate per order)    |
| conditions   | lineitem ⋈ orders ⋈ part               |
| observations | events                                 |

``SQL`` holds the same definitions in DuckDB SQL for the oracle check.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinlake.specs import AnalysisSpec, CohortSpec, PathwaySpec, AdmissionSpec, SymptomSpec

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Parameters that make the clinical definitions meaningful on stand-in data.
STANDIN_SPEC = AnalysisSpec(
    cohort=CohortSpec(
        condition_codes=("Brand#2:PROMO",),
        value_pattern="ERROR|REFUND",
        description_text="POSITIVE",
    ),
    symptoms=SymptomSpec(
        filter_pattern="gizmo|anvil|gear|rod|ring",
        labels=(
            ("Sepsis", "gizmo"),
            ("ARDS", "anvil"),
            ("Heart Failure", "gear"),
            ("Cough", "rod"),
            ("Fever", "ring"),
        ),
    ),
    admissions=AdmissionSpec(encounter_codes=("1-URGENT", "2-HIGH")),
    pathway=PathwaySpec(inpatient=("%urgent%",), icu=("%high%",), ventilation=("%cold anvil%",)),
)


# Declared layouts of the driver tables. Reading with a declared schema skips
# schema inference, which otherwise runs a Spark job over file footers on
# every read.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Column derivations as Spark SQL expressions: one call per column keeps
# plan construction cheap on the driver (Catalyst plans them the same way).
PATIENT_EXPRS = (
    "CASE WHEN c_custkey % 211 = 7 THEN 'NULL'"
    " WHEN c_custkey % 211 = 5 THEN CAST(c_custkey - 1 AS STRING)"  # a second, different row for patient k-1
    " WHEN c_custkey % 89 = 0 THEN concat('  ', CAST(c_custkey AS STRING), ' ')"
    " ELSE CAST(c_custkey AS STRING) END AS id",
    "CASE WHEN c_custkey % 97 = 0 THEN CAST(NULL AS DATE)"
    " ELSE date_add(DATE'1915-01-01', CAST((c_custkey * 7919) % 32000 AS INT)) END AS birthdate",
    "CASE WHEN c_acctbal < 1000 THEN date_add(DATE'2002-01-01', CAST(c_custkey % 700 AS INT)) END AS deathdate",
    "concat('999-', CAST(c_custkey AS STRING)) AS ssn",
    "concat('S', CAST(c_custkey AS STRING)) AS drivers",
    "CASE WHEN c_custkey % 3 = 0 THEN CAST(NULL AS STRING) ELSE concat('X', CAST(c_custkey AS STRING), 'X') END AS passport",
    "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Mr.' END AS prefix",
    "c_name AS first",
    "concat('Family', CAST(c_nationkey AS STRING)) AS last",
    "CAST(NULL AS STRING) AS suffix",
    "CAST(NULL AS STRING) AS maiden",
    "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'S' END AS marital",
    "r_name AS race",
    "'nonhispanic' AS ethnicity",
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'M' WHEN 'BUILDING' THEN 'F' WHEN 'FURNITURE' THEN ' f '"
    " WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN 'other' END AS gender",
    "n_name AS birthplace",
    "concat(CAST(c_custkey AS STRING), ' Main St') AS address",
    "concat('City', CAST(c_nationkey AS STRING)) AS city",
    "n_name AS state",
    "r_name AS county",
    "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS zip",
    "CAST(c_nationkey AS DECIMAL(10,6)) AS lat",
    "CAST(c_custkey % 180 AS DECIMAL(10,6)) AS lon",
    "CAST(c_acctbal AS DECIMAL(12,2)) AS healthcare_expenses",
    "CAST(c_custkey * 10 AS DECIMAL(12,2)) AS healthcare_coverage",
)

ENCOUNTER_EXPRS = (
    "CAST(o_orderkey AS STRING) AS id",
    # every 31st encounter comes twice, the second time amended
    "o_orderdate + make_dt_interval(version) AS start_time",
    "stop_time",
    "CASE WHEN o_orderkey % 157 = 0 THEN 'null'"
    " WHEN o_orderkey % 101 = 0 THEN concat(' ', CAST(o_custkey AS STRING), ' ')"
    " ELSE CAST(o_custkey AS STRING) END AS patient",
    "concat('org-', CAST(o_orderkey % 20 AS STRING)) AS organization",
    "concat('prv-', CAST(o_orderkey % 100 AS STRING)) AS provider",
    "concat('pay-', o_orderstatus) AS payer",
    "o_orderpriority AS encounterclass",
    "o_orderpriority AS code",
    "o_orderpriority AS description",
    "CAST(o_totalprice AS DECIMAL(12,2)) AS base_encounter_cost",
    "CAST(o_totalprice AS DECIMAL(12,2)) AS total_claim_cost",
    "CAST(o_custkey AS DECIMAL(12,2)) AS payer_coverage",
    "CASE WHEN version = 1 THEN 'amended' ELSE o_orderstatus END AS reasoncode",
    "concat('status ', o_orderstatus) AS reasondescription",
)

CONDITION_EXPRS = (
    "start_date",
    "CAST(NULL AS DATE) AS stop_date",
    "CAST(o_custkey AS STRING) AS patient",
    "CASE WHEN no_encounter THEN CAST(NULL AS STRING) ELSE CAST(l_orderkey AS STRING) END AS encounter",
    "concat(p_brand, ':', p_type) AS code",
    "p_name AS description",
)


def bronze_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    return c.join(geo, c.c_nationkey == geo.n_nationkey, "left").selectExpr(*PATIENT_EXPRS)


def bronze_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    last_ship = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("stop_time"))
    )
    versions = o.withColumn("version", F.explode(F.expr("sequence(0, IF(o_orderkey % 31 = 0, 1, 0))")))
    return versions.join(last_ship, versions.o_orderkey == last_ship.l_orderkey, "left").selectExpr(*ENCOUNTER_EXPRS)


def bronze_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # what a line's numbers say is taken before the joins, whose shuffle then moves less
    li = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "to_date(l_shipdate) AS start_date", "(l_orderkey + l_linenumber) % 113 = 0 AS no_encounter")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    joined = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    # every 17th order's lines come twice, as they are
    joined = joined.withColumn("copy", F.explode(F.expr("sequence(0, IF(l_orderkey % 17 = 0, 1, 0))")))
    return joined.selectExpr(*CONDITION_EXPRS)


def bronze_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every 19th event comes twice, as it is
    e = table(spark, sf_dir, "events").withColumn("copy", F.explode(F.expr("sequence(0, IF(event_id % 19 = 0, 1, 0))")))
    return e.select(
        F.col("user_id").cast("string").alias("patient"),
        F.lit(None).cast("string").alias("encounter"),
        F.col("ts").alias("date"),
        F.col("event_type").alias("code"),
        F.expr("CASE WHEN event_id % 23 = 0 THEN concat(props, ' test positive') ELSE props END AS description"),
        F.expr("CASE WHEN event_id % 29 = 0 THEN 'Refunded' ELSE event_type END AS value"),
    )


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "patients": bronze_patients(spark, sf_dir),
        "encounters": bronze_encounters(spark, sf_dir),
        "conditions": bronze_conditions(spark, sf_dir),
        "observations": bronze_observations(spark, sf_dir),
    }


# ---------------------------------------------------------------------------
# The same stand-ins in DuckDB SQL (CTE bodies), for the oracle check.
# ---------------------------------------------------------------------------
SQL = {
    "bronze_patients": """
SELECT
  CASE WHEN c.c_custkey % 211 = 7 THEN 'NULL'
       WHEN c.c_custkey % 211 = 5 THEN CAST(c.c_custkey - 1 AS VARCHAR)
       WHEN c.c_custkey % 89 = 0 THEN concat('  ', CAST(c.c_custkey AS VARCHAR), ' ')
       ELSE CAST(c.c_custkey AS VARCHAR) END AS id,
  CASE WHEN c.c_custkey % 97 = 0 THEN NULL
       ELSE DATE '1915-01-01' + CAST((c.c_custkey * 7919) % 32000 AS INTEGER) END AS birthdate,
  CASE WHEN c.c_acctbal < 1000 THEN DATE '2002-01-01' + CAST(c.c_custkey % 700 AS INTEGER) END AS deathdate,
  concat('999-', CAST(c.c_custkey AS VARCHAR)) AS ssn,
  concat('S', CAST(c.c_custkey AS VARCHAR)) AS drivers,
  CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE concat('X', CAST(c.c_custkey AS VARCHAR), 'X') END AS passport,
  CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'Mr.' END AS prefix,
  c.c_name AS "first",
  concat('Family', CAST(c.c_nationkey AS VARCHAR)) AS "last",
  CAST(NULL AS VARCHAR) AS suffix,
  CAST(NULL AS VARCHAR) AS maiden,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'S' END AS marital,
  g.r_name AS race,
  'nonhispanic' AS ethnicity,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'M' WHEN 'BUILDING' THEN 'F' WHEN 'FURNITURE' THEN ' f '
       WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN 'other' END AS gender,
  g.n_name AS birthplace,
  concat(CAST(c.c_custkey AS VARCHAR), ' Main St') AS address,
  concat('City', CAST(c.c_nationkey AS VARCHAR)) AS city,
  g.n_name AS state,
  g.r_name AS county,
  lpad(CAST(c.c_custkey % 100000 AS VARCHAR), 5, '0') AS zip,
  CAST(c.c_nationkey AS DECIMAL(10,6)) AS lat,
  CAST(c.c_custkey % 180 AS DECIMAL(10,6)) AS lon,
  CAST(c.c_acctbal AS DECIMAL(12,2)) AS healthcare_expenses,
  CAST(c.c_custkey * 10 AS DECIMAL(12,2)) AS healthcare_coverage
FROM customer c
LEFT JOIN (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey) g
  ON c.c_nationkey = g.n_nationkey
""",
    "bronze_encounters": """
SELECT
  CAST(o.o_orderkey AS VARCHAR) AS id,
  o.o_orderdate + to_days(o.version) AS start_time,
  s.stop_time,
  CASE WHEN o.o_orderkey % 157 = 0 THEN 'null'
       WHEN o.o_orderkey % 101 = 0 THEN concat(' ', CAST(o.o_custkey AS VARCHAR), ' ')
       ELSE CAST(o.o_custkey AS VARCHAR) END AS patient,
  concat('org-', CAST(o.o_orderkey % 20 AS VARCHAR)) AS organization,
  concat('prv-', CAST(o.o_orderkey % 100 AS VARCHAR)) AS provider,
  concat('pay-', o.o_orderstatus) AS payer,
  o.o_orderpriority AS encounterclass,
  o.o_orderpriority AS code,
  o.o_orderpriority AS description,
  CAST(o.o_totalprice AS DECIMAL(12,2)) AS base_encounter_cost,
  CAST(o.o_totalprice AS DECIMAL(12,2)) AS total_claim_cost,
  CAST(o.o_custkey AS DECIMAL(12,2)) AS payer_coverage,
  CASE WHEN o.version = 1 THEN 'amended' ELSE o.o_orderstatus END AS reasoncode,
  concat('status ', o.o_orderstatus) AS reasondescription
FROM (SELECT *, 0 AS version FROM orders UNION ALL SELECT *, 1 FROM orders WHERE o_orderkey % 31 = 0) o
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS stop_time FROM lineitem GROUP BY l_orderkey) s
  ON o.o_orderkey = s.l_orderkey
""",
    "bronze_conditions": """
SELECT
  CAST(l.l_shipdate AS DATE) AS start_date,
  CAST(NULL AS DATE) AS stop_date,
  CAST(o.o_custkey AS VARCHAR) AS patient,
  CASE WHEN (l.l_orderkey + l.l_linenumber) % 113 = 0 THEN NULL ELSE CAST(l.l_orderkey AS VARCHAR) END AS encounter,
  concat(p.p_brand, ':', p.p_type) AS code,
  p.p_name AS description
FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 17 = 0) l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
""",
    "bronze_observations": """
SELECT
  CAST(user_id AS VARCHAR) AS patient,
  CAST(NULL AS VARCHAR) AS encounter,
  ts AS "date",
  event_type AS code,
  CASE WHEN event_id % 23 = 0 THEN concat(props, ' test positive') ELSE props END AS description,
  CASE WHEN event_id % 29 = 0 THEN 'Refunded' ELSE event_type END AS "value"
FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 19 = 0) e
""",
}


#: Landing files are read whole by one task each, so they are small enough for one;
#: packed at the codec's fastest, they cost no more time to write than plain ones.
CSV_OPTIONS = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1_000_000}


def land_sources(spark: SparkSession, sf_dir: str, root: str) -> tuple[dict[str, str], str]:
    """Write the stand-in entities as source landing files under ``root``:
    one directory of packed CSV files per entity (source header names) and observations as
    Parquet. Returns (csv_paths by entity, observations path)."""
    from clinlake.session import freed_shuffles
    from clinlake.sources import files

    entities = {
        "conditions": bronze_conditions(spark, sf_dir),
        "encounters": bronze_encounters(spark, sf_dir),
        "patients": bronze_patients(spark, sf_dir),
    }
    csv_paths = {entity: f"{root}/landing/{entity}" for entity in entities}
    obs_path = f"{root}/landing/observations"
    jobs = [lambda e=e, df=df: files.write_csv(df, csv_paths[e], entity=e, options=CSV_OPTIONS) for e, df in entities.items()]
    jobs.append(lambda: files.write_parquet(bronze_observations(spark, sf_dir), obs_path, options={"compression": "zstd"}))
    with freed_shuffles(spark), ThreadPoolExecutor(max_workers=len(jobs)) as pool:  # independent writes, so that no one's last tasks leave cores idle
        for job in [pool.submit(job) for job in jobs]:
            job.result()
    return {e: csv_paths[e] for e in ("patients", "encounters", "conditions")}, obs_path

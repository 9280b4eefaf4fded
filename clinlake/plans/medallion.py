"""The whole pipeline: sources -> Raw -> Bronze -> Silver -> Gold.

Each layer is written as tables and the next layer reads those tables back,
so every step restarts from persisted data: a lost executor re-runs tasks of
the current step only, and lineage never spans layers. Gold tables are
independent of each other.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from clinlake.operators.checks import ContentCheck
from clinlake.plans import gold, ingest, silver
from clinlake.session import delete_path, freed_shuffles
from clinlake.sources import catalog, files
from clinlake.specs import AnalysisSpec


@dataclass
class PipelineConfig:
    raw_dir: str
    csv_paths: dict[str, str] | None = None  # entity -> CSV path (source = csv)
    jdbc: dict | None = None  # jdbc_options kwargs (source = database)
    observations_raw: str | None = None  # optional observations parquet
    table_root: str | None = None  # external location for all tables
    bronze_ns: str = "bronze"
    silver_ns: str = "silver"
    gold_ns: str = "gold"
    fmt: str = "parquet"
    spec: AnalysisSpec = field(default_factory=AnalysisSpec)
    as_of: _dt.date | None = None
    # tables whose content is read back and compared before they replace the old ones
    reconcile: tuple[str, ...] = ("covid_clinical_master",)
    # independent tables of one stage written by concurrent Spark jobs
    concurrent_writes: int = 4
    # codec of the Parquet or ORC files of all layers (None: the session's)
    compression: str | None = "zstd"
    # sources and Raw files go once the next layer is written: for runs on copies
    drop_read: bool = False


def _options(cfg: PipelineConfig, fmt: str) -> dict[str, str]:
    return {"compression": cfg.compression} if cfg.compression and fmt in ("parquet", "orc") else {}


def _loc(cfg: PipelineConfig, ns: str, name: str) -> str | None:
    return f"{cfg.table_root.rstrip('/')}/{ns}/{name}" if cfg.table_root else None


def _ns(spark: SparkSession, cfg: PipelineConfig, ns: str) -> None:
    """Create a namespace; under ``table_root`` when one is configured."""
    catalog.ensure_namespace(spark, ns, location=f"{cfg.table_root.rstrip('/')}/{ns}" if cfg.table_root else None)


def _write(spark: SparkSession, cfg: PipelineConfig, df: DataFrame, ns: str, name: str) -> int:
    if name not in cfg.reconcile:
        return catalog.write_table(df, f"{ns}.{name}", fmt=cfg.fmt, path=_loc(cfg, ns, name), options=_options(cfg, cfg.fmt))
    content = ContentCheck(name, df.columns)
    return catalog.write_table(content.observed(df), f"{ns}.{name}", fmt=cfg.fmt, path=_loc(cfg, ns, name), check=content.check,
                               options=_options(cfg, cfg.fmt))


def _concurrently(cfg: PipelineConfig, jobs: dict[str, Callable[[], int]]) -> dict[str, int]:
    """Run independent table writes as concurrent Spark jobs (the session is
    thread-safe; the scheduler interleaves their tasks). Errors propagate."""
    if cfg.concurrent_writes <= 1 or len(jobs) <= 1:
        return {name: job() for name, job in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(cfg.concurrent_writes, len(jobs))) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def stage_raw(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    raw = cfg.raw_dir.rstrip("/")
    if cfg.csv_paths:
        jobs = {
            e: (lambda e=e, p=p: ingest.csv_to_raw(spark, p, e, f"{raw}/{e}", _options(cfg, "parquet")))
            for e, p in cfg.csv_paths.items()
        }
        return _concurrently(cfg, jobs)
    if cfg.jdbc:
        return ingest.extract_db_to_raw(spark, cfg.raw_dir, options=_options(cfg, "parquet"), **cfg.jdbc)
    raise ValueError("configure csv_paths or jdbc as the source")


def stage_bronze(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    _ns(spark, cfg, cfg.bronze_ns)
    raw = cfg.raw_dir.rstrip("/")
    jobs = {
        t: (lambda t=t: _write(spark, cfg, files.read_parquet(spark, f"{raw}/{t}"), cfg.bronze_ns, t))
        for t in ingest.ENTITIES
    }
    if cfg.observations_raw:
        jobs["observations"] = lambda: _write(
            spark, cfg, files.read_parquet(spark, cfg.observations_raw), cfg.bronze_ns, "observations"
        )
    return _concurrently(cfg, jobs)


def stage_silver(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    _ns(spark, cfg, cfg.silver_ns)
    b, s = cfg.bronze_ns, cfg.silver_ns
    jobs = {
        "patients": lambda: _write(spark, cfg, silver.clean_patients(
            catalog.resolve_table(spark, f"{b}.patients")), s, "patients"),
        "encounters": lambda: _write(spark, cfg, silver.clean_encounters(
            catalog.resolve_table(spark, f"{b}.encounters")), s, "encounters"),
        "conditions": lambda: _write(spark, cfg, silver.clean_conditions(
            catalog.resolve_table(spark, f"{b}.conditions")), s, "conditions"),
    }
    obs_bronze = catalog.resolve_table(spark, f"{b}.observations", required=False)
    if obs_bronze is not None:
        jobs["observations"] = lambda: _write(
            spark, cfg, silver.clean_observations(obs_bronze), s, "observations"
        )
    counts = _concurrently(cfg, jobs)
    obs = spark.table(f"{s}.observations") if obs_bronze is not None else None
    master = silver.clinical_master(
        spark.table(f"{s}.patients"), spark.table(f"{s}.encounters"), spark.table(f"{s}.conditions"),
        obs, cfg.spec.cohort,
    )
    counts["covid_clinical_master"] = _write(spark, cfg, master, s, "covid_clinical_master")
    return counts


def gold_tables(spark: SparkSession, cfg: PipelineConfig) -> dict[str, DataFrame]:
    s = cfg.silver_ns
    master = spark.table(f"{s}.covid_clinical_master")
    path_enc, path_cond = gold.pathway_inputs_from_bronze(
        spark.table(f"{cfg.bronze_ns}.encounters"), spark.table(f"{cfg.bronze_ns}.conditions")
    )
    patients = spark.table(f"{s}.patients")
    encounters = spark.table(f"{s}.encounters")
    conditions = spark.table(f"{s}.conditions")
    sp = cfg.spec
    return {
        "symptoms_outcomes": gold.symptoms_outcomes(master, conditions, sp.cohort, sp.symptoms),
        "mortality_demographics": gold.mortality_demographics(master),
        "hospitalization_workload": gold.hospitalization_workload(master, encounters, sp.admissions),
        "mortality_by_demographics": gold.mortality_by_demographics(master, cfg.as_of),
        "covid_pathway_summary": gold.pathway_summary(master, path_enc, path_cond, sp.pathway),
        "revenue_analysis": gold.revenue_monthly(encounters, patients),
        "covid_trends": gold.weekly_trend(conditions, patients, sp.cohort),
    }


def stage_gold(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    _ns(spark, cfg, cfg.gold_ns)
    jobs = {
        name: (lambda df=df, name=name: _write(spark, cfg, df, cfg.gold_ns, name))
        for name, df in gold_tables(spark, cfg).items()
    }
    return _concurrently(cfg, jobs)


STAGES = (("raw", stage_raw), ("bronze", stage_bronze), ("silver", stage_silver), ("gold", stage_gold))


def _drop_read(spark: SparkSession, cfg: PipelineConfig, stage: str) -> None:
    """What a stage was the last to read; values that did not fit stay beside Raw."""
    read = {"raw": list((cfg.csv_paths or {}).values()),
            "bronze": [*[f"{cfg.raw_dir.rstrip('/')}/{t}" for t in ingest.ENTITIES], *[cfg.observations_raw] * bool(cfg.observations_raw)]}
    for path in read.get(stage, ()):
        delete_path(spark, path)


def run_medallion(spark: SparkSession, cfg: PipelineConfig, stages=None) -> DataFrame:
    """Run the stages in order; returns (stage, table_name, row_count) as a DataFrame.

    Every table is written by one execution, whose shuffle files go when it ends."""
    rows = []
    with freed_shuffles(spark):
        for name, fn in STAGES:
            if stages and name not in stages:
                continue
            for table, n in fn(spark, cfg).items():
                rows.append((name, table, int(n)))
            if cfg.drop_read:
                _drop_read(spark, cfg, name)
    return spark.createDataFrame(rows, "stage string, table_name string, row_count bigint")


def drop_scratch(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Drop the tables and namespaces of a scratch configuration."""
    for ns in (cfg.bronze_ns, cfg.silver_ns, cfg.gold_ns):
        spark.sql(f"DROP NAMESPACE IF EXISTS {ns} CASCADE")


def keep_only(spark: SparkSession, cfg: PipelineConfig, ns: str, name: str) -> None:
    """Drop all tables of a scratch configuration but one, with their files."""
    for other in {cfg.bronze_ns, cfg.silver_ns, cfg.gold_ns} - {ns}:
        spark.sql(f"DROP NAMESPACE IF EXISTS {other} CASCADE")
    for table in [r["tableName"] for r in catalog.list_tables(spark, ns).collect()]:
        if table != name:
            catalog.drop_table(spark, f"{ns}.{table}")
            delete_path(spark, _loc(cfg, ns, table))


def scratch_config(spark: SparkSession, root: str, **kwargs) -> PipelineConfig:
    """A config whose namespaces and tables all live under ``root`` (a fresh
    folder under the shared checkpoint location), for isolated runs."""
    tag = re.sub(r"[^a-z0-9]", "", root.rstrip("/").rsplit("/", 1)[-1].rsplit("-", 1)[-1])
    cfg = PipelineConfig(
        raw_dir=f"{root}/raw", table_root=f"{root}/tables",
        bronze_ns=f"bronze_{tag}", silver_ns=f"silver_{tag}", gold_ns=f"gold_{tag}", **kwargs,
    )
    for ns in (cfg.bronze_ns, cfg.silver_ns, cfg.gold_ns):
        _ns(spark, cfg, ns)
    return cfg

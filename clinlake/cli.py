"""Command line: run medallion stages as a spark-submit job.

    spark-submit -m clinlake run --stages raw,bronze,silver,gold \\
        --csv patients=/data/patients.csv --csv encounters=/data/encounters.csv \\
        --csv conditions=/data/conditions.csv --raw-dir s3a://lake/raw

or with a database source instead of CSV files:

    ... run --jdbc-url jdbc:postgresql://host/db --jdbc-user etl \\
        --jdbc-password-env PG_PASSWORD --jdbc-driver org.postgresql.Driver

The session comes from the submitting environment (master, catalogs, object
store settings); nothing is hard-coded here.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import os
import sys

from clinlake.plans.medallion import STAGES, PipelineConfig, run_medallion
from clinlake.sources.jdbc import DEFAULT_BUCKETS


def _kv(items: list[str]) -> dict[str, str]:
    out = {}
    for item in items or []:
        key, _, value = item.partition("=")
        if not value:
            raise SystemExit(f"expected entity=path, got {item!r}")
        out[key] = value
    return out


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="clinlake")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="run medallion stages")
    r.add_argument("--stages", default=",".join(n for n, _ in STAGES))
    r.add_argument("--csv", action="append", help="entity=path (patients, encounters, conditions)")
    r.add_argument("--observations", help="optional observations Parquet path")
    r.add_argument("--raw-dir", required=True)
    r.add_argument("--table-root", help="external location for all tables")
    r.add_argument("--bronze-ns", default="bronze")
    r.add_argument("--silver-ns", default="silver")
    r.add_argument("--gold-ns", default="gold")
    r.add_argument("--format", default="parquet", help="table format (parquet, iceberg, delta …)")
    r.add_argument("--as-of", help="reference date for ages of living patients (default: today)")
    r.add_argument("--jdbc-url")
    r.add_argument("--jdbc-user")
    r.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
    r.add_argument("--jdbc-driver")
    r.add_argument("--jdbc-partitions", type=int, default=DEFAULT_BUCKETS,
                   help="parallel hash-bucket reads per table (PostgreSQL; 0: one connection)")
    r.add_argument("--shuffle-gb", type=int, help="size shuffles for about this many GB of facts")
    r.add_argument("--concurrent-writes", type=int, default=4, help="independent tables written at once")
    return p.parse_args(argv)


def config_from_args(a: argparse.Namespace) -> PipelineConfig:
    jdbc = None
    if a.jdbc_url:
        jdbc = {"url": a.jdbc_url, "user": a.jdbc_user, "driver": a.jdbc_driver, "hash_buckets": a.jdbc_partitions}
        if a.jdbc_password_env:
            jdbc["password"] = os.environ[a.jdbc_password_env]
    return PipelineConfig(
        raw_dir=a.raw_dir,
        csv_paths=_kv(a.csv) or None,
        jdbc=jdbc,
        observations_raw=a.observations,
        table_root=a.table_root,
        bronze_ns=a.bronze_ns,
        silver_ns=a.silver_ns,
        gold_ns=a.gold_ns,
        fmt=a.format,
        as_of=_dt.date.fromisoformat(a.as_of) if a.as_of else None,
        concurrent_writes=a.concurrent_writes,
    )


def main(argv: list[str] | None = None) -> int:
    a = parse_args(sys.argv[1:] if argv is None else argv)
    cfg = config_from_args(a)
    from clinlake.session import job_session, scale_conf

    spark = job_session("clinlake")
    if a.shuffle_gb:
        for key, value in scale_conf(a.shuffle_gb << 30, spark.sparkContext.defaultParallelism).items():
            spark.conf.set(key, value)
    counts = run_medallion(spark, cfg, stages=tuple(s.strip() for s in a.stages.split(",") if s.strip()))
    counts.show(100, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

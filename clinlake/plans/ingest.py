"""Ingestion: source CSV/DB -> Raw Parquet -> Bronze tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession

from clinlake.session import delete_path
from clinlake.sources import catalog, files, jdbc

ENTITIES = ("patients", "encounters", "conditions")


log = logging.getLogger(__name__)


def ingest_csv(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """An entity CSV in source (database) layout."""
    return files.read_csv(spark, path, entity)


def rejected_path(raw_path: str) -> str:
    """Where values that did not fit are kept: ``_rejected/<entity>`` beside the Raw folder."""
    folder, _, entity = raw_path.rstrip("/").rpartition("/")
    return f"{folder}/_rejected/{entity}"


def csv_to_raw(spark: SparkSession, path: str, entity: str, raw_path: str, options: Mapping[str, str] | None = None) -> int:
    """An entity CSV as Raw Parquet (``options`` go to its writer); returns the rows. Values that did not fit
    their column's type become NULL and are counted in the same pass. Only if
    there are any, the files are read again for their rows, which go to
    ``rejected_path`` as Parquet; what an earlier run left there goes."""
    seen = Observation(f"csv:{entity}")
    rows = files.write_parquet(files.read_csv(spark, path, entity, seen), raw_path, options=options)
    lost = {k: v for k, v in seen.get.items() if k.startswith("nullified_") and v}
    kept = rejected_path(raw_path)
    if lost:
        files.write_parquet(files.rejected_values(spark, path, entity), kept)
        log.warning("%s: values that became NULL: %s, kept in %s", path, lost, kept)
    else:
        delete_path(spark, kept)
    return rows


def load_csv_to_db(
    spark: SparkSession,
    csv_paths: Mapping[str, str],
    url: str,
    properties: Mapping[str, str],
    cascade: Mapping[str, bool] | None = None,
) -> dict[str, int]:
    """Truncate-then-load each entity table from its CSV, parents first.

    Loading order follows foreign keys: patients, encounters, conditions.
    """
    counts = {}
    for entity in ENTITIES:
        if entity not in csv_paths:
            continue
        df = ingest_csv(spark, csv_paths[entity], entity)
        if url.startswith("jdbc:postgresql:"):  # text goes into uuid, date and numeric columns
            properties = {"stringtype": "unspecified", **properties}
        counts[entity] = jdbc.write_jdbc(
            df, url, entity, truncate_first=True,
            cascade=bool((cascade or {}).get(entity, entity != "conditions")),
            properties=properties,
        )
    return counts


def land_raw(sources: Mapping[str, DataFrame], raw_dir: str, options: Mapping[str, str] | None = None) -> dict[str, int]:
    """Write each source DataFrame to ``raw_dir/<name>`` as Parquet (overwrite)."""
    return {name: files.write_parquet(df, f"{raw_dir.rstrip('/')}/{name}", options=options) for name, df in sources.items()}


# Column each entity table is split on for parallel hash-bucket reads.
HASH_COLUMNS = {"patients": "id", "encounters": "id", "conditions": "patient"}


def extract_db_to_raw(
    spark: SparkSession,
    raw_dir: str,
    tables=ENTITIES,
    hash_buckets: int = jdbc.DEFAULT_BUCKETS,
    hash_columns: Mapping[str, str] | None = None,
    options: Mapping[str, str] | None = None,
    **jdbc_kwargs,
) -> dict[str, int]:
    """DB tables -> Raw Parquet. Each table is read by ``hash_buckets`` parallel
    connections, split on a hash of its key column (PostgreSQL; 0: one connection)."""
    cols = {**HASH_COLUMNS, **dict(hash_columns or {})}
    dfs = {
        t: jdbc.read_jdbc(
            spark,
            predicates=jdbc.hash_bucket_predicates(cols[t], hash_buckets) if hash_buckets else None,
            table=t,
            **jdbc_kwargs,
        )
        for t in tables
    }
    return land_raw(dfs, raw_dir, options)

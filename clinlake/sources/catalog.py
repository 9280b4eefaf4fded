"""Catalog tables: resolve, create namespaces, write (full refresh, partitions), inspect."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def resolve_table(spark: SparkSession, name: str, required: bool = True) -> DataFrame | None:
    """The table if it exists; else raise (required) or return None (optional).

    Existence is asked of the catalog, not inferred from a failing read.
    """
    if spark.catalog.tableExists(name):
        return spark.table(name)
    if required:
        raise RuntimeError(f"Table {name} was not found")
    return None


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _is_session_catalog(spark: SparkSession, name: str) -> bool:
    parts = name.split(".")
    if len(parts) >= 3:
        return parts[0] == "spark_catalog"
    return spark.catalog.currentCatalog() == "spark_catalog"


def _sql_name(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _versions(spark: SparkSession, name: str, path: str | None) -> str:
    """The folder that holds the staged versions of a table's data."""
    if path:
        return path.rstrip("/")
    *namespace, table = name.split(".")
    location = spark.catalog.getDatabase(namespace[-1] if namespace else spark.catalog.currentDatabase()).locationUri
    return f"{location.rstrip('/')}/_versions/{table}"


#: Names of version folders start so; nothing else is ever deleted beside a table.
_VERSION = "v-"


def _delete_but(spark: SparkSession, folder: str, kept: set[str]) -> None:
    """Delete the folder's other versions."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(_VERSION) and name not in kept:
            fs.delete(status.getPath(), True)


def _location(spark: SparkSession, name: str) -> str:
    return describe_table(spark, name, ("Location",)).first()["data_type"]


def _point_to(spark: SparkSession, name: str, fmt: str, staged: str, df: DataFrame, partition_by: list[str], external: bool) -> None:
    """Let the catalog table ``name`` show the data under ``staged``."""
    sql_name = _sql_name(name)
    if spark.catalog.tableExists(name):
        now = spark.table(name)
        columns = [(f.name, f.dataType.simpleString()) for f in now.schema.fields]
        plain = not partition_by and not any(c.isPartition for c in spark.catalog.listColumns(name))
        if plain and columns == [(f.name, f.dataType.simpleString()) for f in df.schema.fields]:
            spark.sql(f"ALTER TABLE {sql_name} SET LOCATION '{staged}'")  # one change in the catalog: readers see old or new
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {sql_name}")  # other columns: what replaces it is complete by now
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    place = f" LOCATION '{staged}'" if external else ""
    spark.sql(f"CREATE TABLE {sql_name} ({_ddl(df)}) USING {fmt}{parts}{place}")
    if not external:
        spark.sql(f"ALTER TABLE {sql_name} SET LOCATION '{staged}'")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    path: str | None = None,
    partition_by: list[str] | None = None,
    check: Callable[[DataFrame], None] | None = None,
    options: Mapping[str, str] | None = None,
) -> int:
    """Full refresh of ``name`` with ``df``; returns the rows written.

    On a V2 catalog (e.g. a table-format catalog) this is an atomic
    CREATE OR REPLACE. The built-in session catalog has no REPLACE for file
    tables, so there the data is written to a folder of its own beside the
    version in use, read back by ``check`` (which raises if it does not like
    it), and only then does the table's location move to it, in one catalog
    change. A write or check that fails leaves the table as it was. The version
    replaced stays until the next refresh, for readers that are still on it.
    Where columns or partitioning change, the table is dropped and created
    again over the finished data. ``path`` makes it an external table whose
    versions lie under that folder; on a V2 catalog the catalog places its
    tables, so a path is an error there. ``options`` go to the writer (compression,
    say). The row count is observed during the write.
    """
    spark, partition_by, options = df.sparkSession, list(partition_by or []), dict(options or {})
    obs = Observation(f"rows:{name}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if not _is_session_catalog(spark, name):
        if path:
            raise ValueError(f"{name}: its catalog decides where the table lies, not {path}")
        writer = observed.writeTo(name).using(fmt).options(**options)
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.createOrReplace()
        if check:
            check(spark.table(name))
        return int(obs.get["rows"])
    folder, version = _versions(spark, name, path), f"{_VERSION}{uuid.uuid4().hex}"
    staged = f"{folder}/{version}"
    used = _location(spark, name).rstrip("/").rsplit("/", 1)[-1] if spark.catalog.tableExists(name) else version
    writer = observed.write.format(fmt).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(staged)
    try:
        if check:
            check(spark.read.format(fmt).schema(df.schema).load(staged))
        _point_to(spark, name, fmt, staged, df.select(*[c for c in df.columns if c not in partition_by], *partition_by), partition_by, bool(path))
    except BaseException:
        if not spark.catalog.tableExists(name) or not _location(spark, name).endswith(version):
            _delete_but(spark, folder, {used})
        raise
    _delete_but(spark, folder, {version, used})
    return int(obs.get["rows"])


def overwrite_partitions(df: DataFrame, name: str, partition_by: list[str], fmt: str = "parquet", path: str | None = None,
                         options: Mapping[str, str] | None = None) -> int:
    """Replace the partitions of ``name`` that ``df`` has rows for; returns the rows written.

    Other partitions keep their files. A table that does not exist is written as
    a whole; ``df`` must have the table's columns. Rows are dealt by partition
    first (Spark's rebalance, which splits large ones), so that no task writes
    small files into all of them.
    """
    spark, options = df.sparkSession, dict(options or {})
    if not spark.catalog.tableExists(name):
        return write_table(df, name, fmt, path, partition_by, options=options)
    columns = spark.table(name).columns
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"{name} has the columns {columns}, not {df.columns}")
    obs = Observation(f"rows:{name}")
    dealt = df.select(*columns).hint("rebalance", *[F.col(c) for c in partition_by])
    observed = dealt.observe(obs, F.count(F.lit(1)).alias("rows"))
    if _is_session_catalog(spark, name):  # by its folder: inserts into these tables do not take the mode as an option
        writer = observed.write.format(fmt).options(**options).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partition_by).save(_location(spark, name))
        spark.catalog.recoverPartitions(name)
        spark.catalog.refreshTable(name)
    else:
        observed.writeTo(name).options(**options).overwritePartitions()
    return int(obs.get["rows"])


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}")


METADATA_KEYS = ("Type", "Provider", "Location", "Owner", "Table Properties")


def describe_table(spark: SparkSession, name: str, keys: Iterable[str] = METADATA_KEYS) -> DataFrame:
    """Selected rows of DESCRIBE EXTENDED (table type, provider, location …)."""
    return spark.sql(f"DESCRIBE EXTENDED {_sql_name(name)}").filter(F.col("col_name").isin(*keys))

"""JDBC sources and sinks.

Reads are parallel when a numeric/date partition column (with bounds) or a
list of predicates is given; otherwise one task reads the whole table, which
is only acceptable for small tables. Credentials come only from the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

DEFAULT_FETCH_SIZE = 10_000
#: Parallel connections of an extract.
DEFAULT_BUCKETS = 8


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    fetch_size: int = DEFAULT_FETCH_SIZE,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    opts.update(dict(extra or {}))
    return opts


def read_jdbc(spark: SparkSession, predicates: Sequence[str] | None = None, **kwargs) -> DataFrame:
    """Full-table JDBC scan. ``predicates`` gives one partition per WHERE clause
    (use it to split tables keyed by non-numeric ids, e.g. UUIDs by hash bucket)."""
    opts = jdbc_options(**kwargs)
    if predicates:
        props = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(opts["url"], opts["dbtable"], predicates=list(predicates), properties=props)
    return spark.read.format("jdbc").options(**opts).load()


def hash_bucket_predicates(column: str, buckets: int) -> list[str]:
    """PostgreSQL WHERE clauses splitting a table into ``buckets`` disjoint parts
    by a hash of ``column`` (e.g. a UUID key), for parallel reads with
    ``predicates``. Rows without a key are in the first part."""
    expr = f"mod(abs(hashtext({column}::text)::bigint), {int(buckets)})"
    return [f"{expr} = {i}" + f" OR {column} IS NULL" * (i == 0) for i in range(int(buckets))]


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    truncate_first: bool = False,
    cascade: bool = False,
    properties: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
) -> int:
    """Append rows, or truncate-then-load when ``truncate_first``; returns rows written.

    Truncate-then-load is Spark's overwrite with ``truncate=true``: the table
    (and its definition) stays, its rows are replaced in the same write.
    ``cascade`` asks the database to cascade the truncate where it supports it.
    ``num_partitions`` caps concurrent database connections. The row count is
    observed during the write (no second pass, no read-back).
    """
    obs = Observation(f"jdbc_rows:{table}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", str(batch_size))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    if truncate_first:
        writer = writer.mode("overwrite").option("truncate", "true")
        if cascade:
            writer = writer.option("cascadeTruncate", "true")
    else:
        writer = writer.mode(mode)
    writer.save()
    return int(obs.get["rows"])

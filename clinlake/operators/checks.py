"""Data checks: row-count profiles and write/read-back reconciliation.

Profiles are one Spark job: each table contributes a one-row aggregate and
the rows are unioned, so nothing is counted table-by-table on the driver.
``content_checksum`` is an aggregate of two numbers (rows, and the sum of a
number made of every row's text), so it merges in any order, can be observed
while a table is written, and compared with what is read back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def table_profile(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """(stage, table_name, row_count, column_count) for {(stage, name): df}."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(stage).alias("stage"),
            F.lit(name).alias("table_name"),
            F.col("row_count"),
            F.lit(len(df.columns)).cast("int").alias("column_count"),
        )
        for (stage, name), df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_number_of(columns: Sequence[str]) -> Column:
    """A number below 2**60 made of a row's values: the first 15 hex digits of the
    MD5 of all values as text, each with its length, NULL as ``-``."""
    shown = [F.col(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in shown]
    return F.conv(F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")


def content_checksum(columns: Sequence[str]) -> list[Column]:
    """Aggregates ``rows`` and ``checksum`` over rows in any order: rows that differ in
    a value, or occur another number of times, give other sums (up to a chance of 2**-60)."""
    total = F.coalesce(F.sum(row_number_of(columns)), F.lit(0)).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("rows"), total.alias("checksum")]


class ContentCheck:
    """Observes what is written and compares it with what is read back.

    ``observed(df)`` is what to write; ``check(df)`` raises unless the rows read
    back have the content seen on the way out (for ``catalog.write_table``)."""

    def __init__(self, name: str, columns: Sequence[str]):
        self.name, self.columns = name, sorted(columns)
        self.seen = Observation(f"content:{name}")

    def observed(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *content_checksum(self.columns))

    def written(self) -> tuple[int, int]:
        return int(self.seen.get["rows"]), int(self.seen.get["checksum"])

    def compare(self, persisted: DataFrame) -> DataFrame:
        """(table_name, written_rows, written_checksum, persisted_rows, persisted_checksum, ok)."""
        rows, checksum = self.written()
        found = persisted.agg(*content_checksum(self.columns)).select(
            F.lit(self.name).alias("table_name"), F.lit(rows).cast("bigint").alias("written_rows"),
            F.lit(str(checksum)).cast("decimal(38,0)").alias("written_checksum"),
            F.col("rows").alias("persisted_rows"), F.col("checksum").alias("persisted_checksum"))
        same = (F.col("written_rows") == F.col("persisted_rows")) & (F.col("written_checksum") == F.col("persisted_checksum"))
        return found.withColumn("ok", same)

    def check(self, persisted: DataFrame) -> None:
        row = self.compare(persisted).first()
        if not row["ok"]:
            raise RuntimeError(f"{self.name}: read back {row['persisted_rows']} rows ({row['persisted_checksum']}), "
                               f"wrote {row['written_rows']} ({row['written_checksum']})")


def reconcile(spark: SparkSession, name: str, expected_rows: int, label: str | None = None) -> DataFrame:
    """(table_name, expected_rows, persisted_rows, ok) from a read-back count."""
    persisted = spark.table(name).agg(F.count(F.lit(1)).alias("persisted_rows"))
    return persisted.select(
        F.lit(label or name).alias("table_name"),
        F.lit(expected_rows).cast("bigint").alias("expected_rows"),
        F.col("persisted_rows"),
        (F.col("persisted_rows") == F.lit(expected_rows)).alias("ok"),
    )


def assert_reconciled(spark: SparkSession, name: str, expected_rows: int) -> None:
    row = reconcile(spark, name, expected_rows).first()
    if not row["ok"]:
        raise RuntimeError(
            f"Persisted row count mismatch for {name}: expected {expected_rows}, got {row['persisted_rows']}"
        )

"""Deduplication, as lazy plans without actions or size limits.

``dedup_deterministic`` keeps, per key, the row that sorts first over the
remaining columns (ascending, NULLs first): SQL ``ROW_NUMBER() OVER (PARTITION
BY keys ORDER BY rest NULLS FIRST) = 1``. Spark limits each key to its first row
inside every map task before the one shuffle (``WindowGroupLimit``), so the
input is scanned once, and a key holding a third of the rows leaves each task as
one row. ``dedup_split`` is another plan for the same result, for wide rows whose
keys hardly ever repeat: it scans its input more than once, but only rows of
repeated keys are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

_SURVIVOR = "__survivor"
_HASH = "__hash"
_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The first row of each key by one keyed ``min`` over all rows."""
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else rest
    tail = [c for c in rest if c not in order]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in order + tail])).alias(_SURVIVOR))
    return picked.select(*[F.col(c) if c in keys else F.col(f"{_SURVIVOR}.{c}").alias(c) for c in df.columns])


def split_repeated(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key hash occurs once, the others). Equal keys are always in
    the same part; a hash shared by different keys only sends them to the second."""
    hashed = df.withColumn(_HASH, F.xxhash64(*[F.col(k) for k in keys]))
    repeated = hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(_HASH)
    return hashed.join(repeated, _HASH, "left_anti").drop(_HASH), hashed.join(repeated, _HASH, "left_semi").drop(_HASH)


def dedup_deterministic(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``; survivor = first row ordered by ``order`` (default: all other columns)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order = list(order) if order is not None else rest
    order += [c for c in rest if c not in order]  # equal in every column: any of them is the survivor
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn(_RANK, F.row_number().over(first)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedup_split(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The same rows: unique keys pass by an anti join on a counted hash of the
    key, repeated ones are reduced by a keyed ``min`` over a struct."""
    once, repeated = split_repeated(df, list(keys))
    return once.unionByName(first_per_key(repeated, list(keys), order))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct rows (NULLs equal): one hash aggregate that combines map-side."""
    return df.dropDuplicates()


def dedup_rows_split(df: DataFrame) -> DataFrame:
    """Distinct rows; rows of a hash of their own pass without an aggregate."""
    once, repeated = split_repeated(df, df.columns)
    return once.unionByName(repeated.dropDuplicates())


def distinct_keys(df: DataFrame, *cols: str) -> DataFrame:
    """SELECT DISTINCT cols."""
    return df.select(*cols).distinct()

"""Exact distinct counts that can be rolled up without reading the facts again.

Keys are numbered once; a group's keys are then bitmaps, one for each
2**15 numbers (Spark's ``bitmap_construct_agg``). A bitmap is built whole in one
task from the distinct numbers of its group and bucket, 2**15 at most: facts are
reduced to distinct (group, number) first, and what is moved are numbers, not a
sparse bitmap from every task. Months become years, or a group all groups, by
OR-ing bitmaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from clinlake.operators.cohort import join_facts
from clinlake.session import scratch_path


def numbered_keys(keys: DataFrame, key: str) -> DataFrame:
    """(key, number) of the distinct non-null keys, dense within each task's range,
    written once so that the numbers stay."""
    spark = keys.sparkSession
    path = scratch_path(spark, "numbered")
    keys.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("number", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.schema(f"{key} {dict(keys.dtypes)[key]}, number bigint").parquet(path)


def key_bitmaps(facts: DataFrame, numbers: DataFrame, key: str, by: Sequence[str], salt_by: Sequence[str] | None = None) -> DataFrame:
    """(by, bucket, bitmap): the keys of each group's facts. Facts without a numbered key are left out."""
    # no broadcast: Spark judges it by the file of numbers, which the join repeats for every salt
    joined = join_facts(facts, numbers.hint("merge"), key, salt_by=salt_by)
    distinct = joined.select(*by, F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("__bit")).distinct()
    return distinct.repartition(*by, "bucket").groupBy(*by, "bucket").agg(F.bitmap_construct_agg("__bit").alias("bitmap"))


def distinct_from_bitmaps(bitmaps: DataFrame, by: Sequence[str], count_as: str = "distinct_keys") -> DataFrame:
    """(by, count) of a state of ``key_bitmaps``, rolled up to ``by`` (any of its columns, or none)."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("__n"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum("__n"), F.lit(0)).alias(count_as))

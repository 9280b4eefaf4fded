"""A total order over a result that fits no single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clinlake.session import scratch_path

#: ``monotonically_increasing_id`` keeps the row's place in its partition in this many low bits.
_PLACE_BITS = 33


def globally_ranked(df: DataFrame, order: Sequence[Column], rank: str = "rank", partitions: int | None = None) -> DataFrame:
    """``df`` with its row number by ``order`` (from 1), without a window over all rows.

    Rows are dealt by ranges of the order and sorted where they lie; a row's
    number is its place in its partition after the rows of the partitions before
    it (one number for each partition). The sorted rows are written once, so that
    places stay what they were counted as. ``order`` must not leave ties between
    rows that differ; a value that many rows share is split by the columns after it.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = dealt.withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()})
    path = scratch_path(spark, "ranked")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    bases = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__base"))
    place = F.col("__place").bitwiseAND((1 << _PLACE_BITS) - 1)
    ranked = placed.join(bases, "__part").withColumn(rank, F.col("__base") + place + 1)
    return ranked.drop("__part", "__place", "__base")

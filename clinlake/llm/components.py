"""Connected components of a link table, by alternating stars in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clinlake.llm.common import discard, materialize
from clinlake.operators.cohort import join_facts


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every node's larger neighbours on the smallest node around it (links a > b)."""
    around = links.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("near")))
    least = around.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least"))
    hung = join_facts(around.filter("near > node"), least, "node")
    return hung.select(F.col("near").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of them."""
    around = links.select(F.col("a").alias("node"), F.col("b").alias("near"))
    least = around.groupBy("node").agg(F.min("near").alias("least"))
    hung = join_facts(around, least, "node").select(F.col("near").alias("a"), F.col("least").alias("b"))
    return hung.filter("a > b").unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (columns a, b); root is the smallest node.

    Each round is written to the shared folder; the rounds needed grow with the
    logarithm of the longest chain. The joins are salted, so a node with very
    many links does not meet them in one task.
    """
    spark, scratch = links.sparkSession, []
    now = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "stars", scratch)
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before, read = state, scratch[:]
        scratch.clear()
        now = materialize(_small_star(_large_star(now)), "stars", scratch)
        discard(spark, read)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

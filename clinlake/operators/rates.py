"""Rates against a population.

Denominators stay inside the plan: a population that is a single number is a
scalar subquery (``DataFrame.scalar()``, one row by construction), a
population per group is an equi-join on the group flag. Nothing is counted on
the driver and fed back as a literal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clinlake.functions.labels import percent


def rate_against_groups(
    counts: DataFrame,
    population: DataFrame,
    on: str,
    count_col: str,
    population_col: str,
    rate_as: str,
) -> DataFrame:
    """Join per-group ``population`` (one row per ``on`` value) and add the rate."""
    return counts.join(population, on=on, how="left").withColumn(
        rate_as, percent(F.col(count_col), F.col(population_col))
    )


def share_of_total(counts: DataFrame, universe: DataFrame, count_col: str, rate_as: str) -> DataFrame:
    """count_col / |universe| * 100, rounded to 2 places."""
    total = universe.select(F.count(F.lit(1))).scalar()
    return counts.withColumn(rate_as, percent(F.col(count_col), total))

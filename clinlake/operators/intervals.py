"""Facts near any of several dates of their key, as an equi-join on bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from clinlake.operators.cohort import FACT_SALTS


def within_days(events: DataFrame, marks: DataFrame, key: str, event_date: str, mark_date: str, days: int,
                salts: int = FACT_SALTS, salt_by: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``events`` that lie at most ``days`` days before or after any mark of their key.

    Time is cut into bins of ``days`` + 1 days; a mark is there in its own bin
    and the two beside it, so a semi join on (key, bin) meets every pair that
    can be near, and the exact distance is its other condition. An event meets
    the marks of three bins, not all marks of its key. Events are dealt over
    ``salts`` parts by a hash of ``salt_by`` (default: the whole row) and marks
    repeated as often, so a key holding a third of all events is split. Events
    or marks without key or date meet nothing.
    """
    width = days + 1

    def bin_of(date: str):
        return F.floor(F.datediff(F.to_date(F.col(date)), F.lit("1970-01-01").cast("date")) / width)

    part = F.pmod(F.xxhash64(*[F.col(c) for c in salt_by or events.columns]), F.lit(salts)).cast("int")
    dealt = events.withColumns({"__part": part, "__bin": bin_of(event_date)})
    placed = marks.filter(F.col(mark_date).isNotNull()).select(F.col(key).alias("__key"), F.to_date(F.col(mark_date)).alias("__mark")).distinct()
    around = F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda step: bin_of("__mark") + step))
    placed = placed.withColumn("__mark_bin", around).withColumn("__mark_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    near = F.abs(F.datediff(F.to_date(F.col(event_date)), F.col("__mark"))) <= days
    met = (F.col(key) == F.col("__key")) & (F.col("__part") == F.col("__mark_part")) & (F.col("__bin") == F.col("__mark_bin")) & near
    return dealt.join(placed, met, "left_semi").drop("__part", "__bin")

"""Key sets (cohorts) and restriction of facts to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def union_keys(*key_sets: DataFrame) -> DataFrame:
    """SQL UNION (distinct) of one-column key sets, by column name."""
    sets = [k for k in key_sets if k is not None]
    out = sets[0]
    for other in sets[1:]:
        out = out.unionByName(other)
    return out.distinct()


#: Parts a hot key's facts are dealt into; the key side is repeated as often.
FACT_SALTS = 8


def join_facts(facts: DataFrame, per_key: DataFrame, on: str = "patient_id", how: str = "inner",
               salts: int = FACT_SALTS, salt_by: Sequence[str] | None = None) -> DataFrame:
    """Join raw facts with a table of at most one row per key.

    Where the key side is itself an aggregate, Spark's skew handling leaves its
    join alone, so a key holding a third of the facts would land in one task.
    Facts are therefore dealt over ``salts`` parts by a hash of the columns
    ``salt_by`` (a fact's own id, say; default: the whole row) and the key side
    is repeated once for each part. The salt depends on the row alone, so a task
    that runs again deals alike; rows equal in all these columns share a part. If the key side turns out small
    enough, Spark broadcasts it and shuffles no fact.
    """
    part = F.pmod(F.xxhash64(*[F.col(c) for c in salt_by or facts.columns]), F.lit(salts)).cast("int")
    dealt = facts.withColumn("__part", part)
    repeated = per_key.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(repeated, [on, "__part"], how).drop("__part")


def restrict_to(df: DataFrame, keys: DataFrame, on: str = "patient_id", salts: int = FACT_SALTS,
                salt_by: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose ``on`` appears in ``keys`` (left semi join of facts)."""
    return join_facts(df, keys.select(on), on, "left_semi", salts, salt_by)

"""Per-key summaries (count / latest / null-as-zero sum) and any-flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def summarize_per_key(
    df: DataFrame,
    key: str,
    count_as: str,
    latest: Mapping[str, str] | None = None,
    sums: Mapping[str, tuple[str, str]] | None = None,
    flags: Mapping[str, Column] | None = None,
) -> DataFrame:
    """groupBy(key): row count, max of ``latest`` columns, decimal sums, any-flags.

    latest: {output_name: input_column}
    sums:   {output_name: (input_column, decimal_type)} — NULL inputs count as 0.
    flags:  {output_name: boolean condition} — true if any row satisfies it.
    All are algebraic aggregates: partial aggregation runs map-side.
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias(count_as)]
    for out, src in (latest or {}).items():
        aggs.append(F.max(F.col(src)).alias(out))
    for out, (src, dtype) in (sums or {}).items():
        aggs.append(F.sum(F.coalesce(F.col(src), F.lit(0))).try_cast(dtype).alias(out))
    for out, cond in (flags or {}).items():
        aggs.append(F.bool_or(F.coalesce(cond, F.lit(False))).alias(out))
    return df.groupBy(key).agg(*aggs)


def any_flags_per_key(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """groupBy(keys): max of each 0/1 flag expression ({output_name: flag})."""
    return df.groupBy(*keys).agg(*[F.max(expr).alias(name) for name, expr in flags.items()])


def global_summary(df: DataFrame, count_as: str, sums: Mapping[str, tuple[str, str]] | None = None,
                   earliest: Mapping[str, str] | None = None,
                   latest: Mapping[str, str] | None = None) -> DataFrame:
    """Keyless aggregate: always one row; on empty input the count is 0 and
    sums / extremes are NULL. Partial aggregates run in every task, so only
    one small row per task reaches the final single-partition step."""
    aggs: list[Column] = [F.count(F.lit(1)).alias(count_as)]
    for out, (src, dtype) in (sums or {}).items():
        aggs.append(F.sum(F.col(src)).cast(dtype).alias(out))
    for out, src in (earliest or {}).items():
        aggs.append(F.min(F.col(src)).alias(out))
    for out, src in (latest or {}).items():
        aggs.append(F.max(F.col(src)).alias(out))
    return df.agg(*aggs)

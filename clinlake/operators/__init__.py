"""DataFrame -> DataFrame building blocks."""

from clinlake.operators.dedup import dedup_deterministic, dedup_rows, dedup_rows_split, dedup_split, distinct_keys, first_per_key
from clinlake.operators.cohort import join_facts, restrict_to, union_keys
from clinlake.operators.summaries import any_flags_per_key, summarize_per_key
from clinlake.operators.rates import rate_against_groups, share_of_total

__all__ = [
    "dedup_deterministic",
    "dedup_rows",
    "dedup_rows_split",
    "dedup_split",
    "first_per_key",
    "join_facts",
    "distinct_keys",
    "restrict_to",
    "union_keys",
    "summarize_per_key",
    "any_flags_per_key",
    "rate_against_groups",
    "share_of_total",
]

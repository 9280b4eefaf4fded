"""Banding, keyword labelling, flags and percentages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# --- fixed values: age bands of the two mortality tables ----------------------
# decade bands (age at death): upper bound inclusive, label
DECADE_BANDS = (
    (10, "0-10"),
    (20, "11-20"),
    (30, "21-30"),
    (40, "31-40"),
    (50, "41-50"),
    (60, "51-60"),
    (70, "61-70"),
    (80, "71-80"),
)
DECADE_OVERFLOW = "80+"
# clinical bands: upper bound inclusive, label; ages from 65 get "65+"
CLINICAL_BANDS = (
    (18, "0-18"),
    (34, "19-34"),
    (49, "35-49"),
    (64, "50-64"),
)
CLINICAL_OVERFLOW = "65+"
UNKNOWN_BAND = "Unknown"
# --- end of fixed values --------------------------------------------------------


def _bands(age: Column, bands: Sequence[tuple[int, str]], start: Column) -> Column:
    out = start
    for upper, label in bands:
        out = out.when(age <= upper, F.lit(label))
    return out


def decade_age_band(age: Column, birthdate: Column) -> Column:
    """'Unknown' without a birthdate; else 0-10 … 71-80, then 80+ (negatives -> 0-10)."""
    return _bands(age, DECADE_BANDS, F.when(birthdate.isNull(), F.lit(UNKNOWN_BAND))).otherwise(
        F.lit(DECADE_OVERFLOW)
    )


def clinical_age_band(age: Column) -> Column:
    """0-18, 19-34, 35-49, 50-64, 65+; NULL age -> 'Unknown'."""
    first_upper, first_label = CLINICAL_BANDS[0]
    out = F.when(age <= first_upper, F.lit(first_label))
    out = _bands(age, CLINICAL_BANDS[1:], out)
    return out.when(age >= CLINICAL_BANDS[-1][0] + 1, F.lit(CLINICAL_OVERFLOW)).otherwise(
        F.lit(UNKNOWN_BAND)
    )


def first_match_label(text: Column, rules: Sequence[tuple[str, str]], default: Column | None = None) -> Column:
    """Label of the first (label, regex) rule matching ``text`` case-insensitively."""
    label, pattern = rules[0]
    out = F.when(text.rlike(f"(?i)({pattern})"), F.lit(label))
    for label, pattern in rules[1:]:
        out = out.when(text.rlike(f"(?i)({pattern})"), F.lit(label))
    return out.otherwise(default if default is not None else text)


def any_like(text: Column, patterns: Sequence[str]) -> Column:
    """lower(text) LIKE any of ``patterns`` (patterns are lower-case)."""
    lowered = F.lower(text)
    cond = lowered.like(patterns[0])
    for p in patterns[1:]:
        cond = cond | lowered.like(p)
    return cond


def flag(cond: Column) -> Column:
    """1 when ``cond`` is true, else 0 (NULL counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def percent(numerator: Column, denominator: Column) -> Column:
    """round(n / d * 100, 2) as DOUBLE; d = 0 gives NULL instead of an error."""
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")) * 100, 2)

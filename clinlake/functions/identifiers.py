"""Normalization of coded text: identifiers and gender."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# --- fixed values ------------------------------------------------------------
# Texts that mean "no identifier" once padding is gone ('Null' is a value), and
# the labels of gender codes (upper case; blank means unknown).
MISSING_ID_TOKENS = ("", "NULL", "null")
GENDER_LABELS = {"M": "Male", "F": "Female", "": None}
# --- end of fixed values -----------------------------------------------------


def mapped(value: Column, labels: Mapping[str, str | None], default: Column) -> Column:
    """The label of ``value``; ``default`` for values without one (NULL stays NULL)."""
    by_label: dict[str | None, list[str]] = {}
    for code, label in labels.items():
        by_label.setdefault(label, []).append(code)
    out = default
    for label, codes in by_label.items():
        out = F.when(value.isin(codes), F.lit(label).cast("string")).otherwise(out)
    return out


def normalize_identifier(col: Column) -> Column:
    """Padding removed; a missing-value token becomes NULL."""
    value = F.trim(col)
    return mapped(value, dict.fromkeys(MISSING_ID_TOKENS), value)


def normalize_gender(col: Column) -> Column:
    """Label of the code, whatever its case and padding; other texts with capital initials."""
    value = F.trim(col)
    return mapped(F.upper(value), GENDER_LABELS, F.initcap(value))

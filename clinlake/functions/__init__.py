"""Column -> Column helpers. All are built-in Spark expressions (codegen'd)."""

from clinlake.functions.identifiers import normalize_gender, normalize_identifier
from clinlake.functions.temporal import (
    as_date,
    as_decimal,
    as_string,
    as_timestamp,
    stay_days,
    year_age,
)
from clinlake.functions.labels import (
    any_like,
    clinical_age_band,
    decade_age_band,
    first_match_label,
    flag,
    percent,
)

__all__ = [
    "normalize_identifier",
    "normalize_gender",
    "as_date",
    "as_timestamp",
    "as_decimal",
    "as_string",
    "year_age",
    "stay_days",
    "decade_age_band",
    "clinical_age_band",
    "first_match_label",
    "any_like",
    "flag",
    "percent",
]

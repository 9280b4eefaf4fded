"""Parameters of the analytic definitions.

Defaults are the clinical values the source pipeline hard-codes; the
stand-in data of ``sources.standins`` passes its own values through the same
dataclasses, so no query changes shape between real and stand-in data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: clinical codes, patterns and labels of the source pipeline
COVID_CONDITION_CODE = "840539006"
POSITIVE_VALUE_PATTERN = "POSITIVE|DETECTED|REACTIVE"
POSITIVE_DESCRIPTION_TEXT = "POSITIVE"
SYMPTOM_FILTER_PATTERN = "Sepsis|ARDS|Acute respiratory distress syndrome|Heart failure|Cough|Fever"
SYMPTOM_LABELS = (
    ("Sepsis", "Sepsis"),
    ("ARDS", "ARDS|Acute respiratory distress s"),
    ("Heart Failure", "Heart failure"),
    ("Cough", "Cough"),
    ("Fever", "Fever"),
)
ADMISSION_CODES = ("1505002", "305351004")
INPATIENT_PATTERNS = ("%inpatient%",)
ICU_PATTERNS = ("%icu%", "%intensive%")
VENTILATION_PATTERNS = ("%ventilator%", "%ventilation%", "%hypoxemia%")
# --- end of fixed values ------------------------------------------------------


@dataclass(frozen=True)
class CohortSpec:
    """Who enters the cohort: a coded diagnosis, or a positive observation.

    An observation is positive when upper(value) matches ``value_pattern``
    (unanchored regex) or upper(description) contains ``description_text``.
    """

    condition_codes: tuple[str, ...] = (COVID_CONDITION_CODE,)
    value_pattern: str = POSITIVE_VALUE_PATTERN
    description_text: str = POSITIVE_DESCRIPTION_TEXT


@dataclass(frozen=True)
class SymptomSpec:
    """Keyword filter and ordered (label, pattern) rules; first match wins.

    Patterns are case-insensitive unanchored regexes over the description.
    """

    filter_pattern: str = SYMPTOM_FILTER_PATTERN
    labels: tuple[tuple[str, str], ...] = SYMPTOM_LABELS


@dataclass(frozen=True)
class AdmissionSpec:
    encounter_codes: tuple[str, ...] = ADMISSION_CODES


@dataclass(frozen=True)
class PathwaySpec:
    """LIKE patterns over lower-cased encounter class / condition description."""

    inpatient: tuple[str, ...] = INPATIENT_PATTERNS
    icu: tuple[str, ...] = ICU_PATTERNS
    ventilation: tuple[str, ...] = VENTILATION_PATTERNS


@dataclass(frozen=True)
class AnalysisSpec:
    cohort: CohortSpec = field(default_factory=CohortSpec)
    symptoms: SymptomSpec = field(default_factory=SymptomSpec)
    admissions: AdmissionSpec = field(default_factory=AdmissionSpec)
    pathway: PathwaySpec = field(default_factory=PathwaySpec)

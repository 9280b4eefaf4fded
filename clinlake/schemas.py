"""Declared schemas for the three source entities and their CSV header maps.

Source files are read with these schemas (no inference): inference turns an
all-digit ZIP such as ``02138`` into the number 2138 and costs an extra pass
over the data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: CSV header -> source column name, per entity -------------
# (must equal the source system's header maps; absent headers are ignored)
PATIENTS_RENAME = {
    "Id": "id",
    "BIRTHDATE": "birthdate",
    "DEATHDATE": "deathdate",
    "SSN": "ssn",
    "DRIVERS": "drivers",
    "PASSPORT": "passport",
    "PREFIX": "prefix",
    "FIRST": "first",
    "LAST": "last",
    "SUFFIX": "suffix",
    "MAIDEN": "maiden",
    "MARITAL": "marital",
    "RACE": "race",
    "ETHNICITY": "ethnicity",
    "GENDER": "gender",
    "BIRTHPLACE": "birthplace",
    "ADDRESS": "address",
    "CITY": "city",
    "STATE": "state",
    "COUNTY": "county",
    "ZIP": "zip",
    "LAT": "lat",
    "LON": "lon",
    "HEALTHCARE_EXPENSES": "healthcare_expenses",
    "HEALTHCARE_COVERAGE": "healthcare_coverage",
}

ENCOUNTERS_RENAME = {
    "Id": "id",
    "START": "start_time",
    "STOP": "stop_time",
    "PATIENT": "patient",
    "ORGANIZATION": "organization",
    "PROVIDER": "provider",
    "PAYER": "payer",
    "ENCOUNTERCLASS": "encounterclass",
    "CODE": "code",
    "DESCRIPTION": "description",
    "BASE_ENCOUNTER_COST": "base_encounter_cost",
    "TOTAL_CLAIM_COST": "total_claim_cost",
    "PAYER_COVERAGE": "payer_coverage",
    "REASONCODE": "reasoncode",
    "REASONDESCRIPTION": "reasondescription",
}

CONDITIONS_RENAME = {
    "START": "start_date",
    "STOP": "stop_date",
    "PATIENT": "patient",
    "ENCOUNTER": "encounter",
    "CODE": "code",
    "DESCRIPTION": "description",
}

RENAME_MAPS = {
    "patients": PATIENTS_RENAME,
    "encounters": ENCOUNTERS_RENAME,
    "conditions": CONDITIONS_RENAME,
}

_S = T.StringType()
_D = T.DateType()
# Zoned source timestamps are kept as session-zone wall-clock values.
_TS = T.TimestampNTZType()


def _dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


# Source (Bronze) column layout, in the source table's physical order (fixed values as well).
PATIENTS_SCHEMA = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("birthdate", _D),
        T.StructField("deathdate", _D),
        *[T.StructField(c, _S) for c in (
            "ssn", "drivers", "passport", "prefix", "first", "last", "suffix",
            "maiden", "marital", "race", "ethnicity", "gender", "birthplace",
            "address", "city", "state", "county", "zip",
        )],
        T.StructField("lat", _dec(10, 6)),
        T.StructField("lon", _dec(10, 6)),
        T.StructField("healthcare_expenses", _dec(12, 2)),
        T.StructField("healthcare_coverage", _dec(12, 2)),
    ]
)

ENCOUNTERS_SCHEMA = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("start_time", _TS),
        T.StructField("stop_time", _TS),
        *[T.StructField(c, _S) for c in (
            "patient", "organization", "provider", "payer", "encounterclass",
            "code", "description",
        )],
        T.StructField("base_encounter_cost", _dec(12, 2)),
        T.StructField("total_claim_cost", _dec(12, 2)),
        T.StructField("payer_coverage", _dec(12, 2)),
        T.StructField("reasoncode", _S),
        T.StructField("reasondescription", _S),
    ]
)

CONDITIONS_SCHEMA = T.StructType(
    [
        T.StructField("start_date", _D),
        T.StructField("stop_date", _D),
        T.StructField("patient", _S),
        T.StructField("encounter", _S),
        T.StructField("code", _S),
        T.StructField("description", _S),
    ]
)

# --- end of fixed values -----------------------------------------------------

SOURCE_SCHEMAS = {
    "patients": PATIENTS_SCHEMA,
    "encounters": ENCOUNTERS_SCHEMA,
    "conditions": CONDITIONS_SCHEMA,
}


def csv_schema(entity: str) -> T.StructType:
    """Schema of an entity's CSV file: source types under the CSV header names."""
    back = {v: k for k, v in RENAME_MAPS[entity].items()}
    return T.StructType(
        [T.StructField(back.get(f.name, f.name), f.dataType) for f in SOURCE_SCHEMAS[entity]]
    )

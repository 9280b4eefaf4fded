"""Hand-made Bronze fixtures with the edge rows of FIXTURES.md §3."""

import datetime as dt
from decimal import Decimal

from clinlake import schemas

D = dt.date
T = dt.datetime


def _rows(schema, records):
    names = [f.name for f in schema.fields]
    return [tuple(r.get(n) for n in names) for r in records]


def patients(spark, records):
    return spark.createDataFrame(_rows(schemas.PATIENTS_SCHEMA, records), schemas.PATIENTS_SCHEMA)


def encounters(spark, records):
    return spark.createDataFrame(_rows(schemas.ENCOUNTERS_SCHEMA, records), schemas.ENCOUNTERS_SCHEMA)


def conditions(spark, records):
    return spark.createDataFrame(_rows(schemas.CONDITIONS_SCHEMA, records), schemas.CONDITIONS_SCHEMA)


def observations(spark, records, cols=("patient", "encounter", "date", "code", "description", "value")):
    schema = ", ".join(f"{c} {'timestamp_ntz' if c.lower() in ('date', 'start', 'start_date') else 'string'}" for c in cols)
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in records], schema)


COVID = "840539006"


def small_world(spark):
    """Four patients, one with a duplicate row; p1..p3 coded, p4 observation-only,
    p9 coded without a patient row."""
    pats = patients(spark, [
        {"id": "p1", "birthdate": D(1950, 5, 1), "deathdate": D(2020, 4, 1), "first": "Ann", "gender": "F",
         "healthcare_expenses": Decimal("10.00")},
        {"id": " p2 ", "birthdate": D(1990, 1, 1), "first": "Bob", "gender": "M"},
        {"id": "p3", "birthdate": None, "first": "Cy", "gender": ""},
        {"id": "p4", "birthdate": D(2010, 1, 1), "first": "Di", "gender": "f"},
        {"id": "p2", "birthdate": D(1990, 1, 1), "first": "Bobby", "gender": "M"},
        {"id": "NULL", "first": "Nobody"},
    ])
    encs = encounters(spark, [
        {"id": "e1", "patient": "p1", "start_time": T(2020, 3, 1, 23, 0), "stop_time": T(2020, 3, 2, 1, 0),
         "code": "1505002", "description": "Hospital admission", "encounterclass": "inpatient",
         "total_claim_cost": Decimal("100.50")},
        {"id": "e2", "patient": "p1", "start_time": T(2020, 3, 10), "stop_time": None, "code": "305351004",
         "description": "ICU admission", "encounterclass": "ICU", "total_claim_cost": None},
        {"id": "e3", "patient": "p2", "start_time": T(2020, 4, 1), "stop_time": T(2020, 4, 5),
         "code": "305351004", "description": "ICU admission", "encounterclass": "intensive care",
         "total_claim_cost": Decimal("20.00")},
        {"id": "e4", "patient": "null", "start_time": T(2020, 4, 1)},
    ])
    conds = conditions(spark, [
        {"patient": "p1", "encounter": "e1", "start_date": D(2020, 3, 1), "code": COVID, "description": "COVID-19"},
        {"patient": "p1", "encounter": "e1", "start_date": D(2020, 2, 28), "code": "x", "description": "Fever"},
        {"patient": "p1", "encounter": "e1", "start_date": D(2020, 3, 1), "code": "y", "description": "Cough (finding)"},
        {"patient": "p1", "encounter": "e1", "start_date": D(2020, 3, 2), "code": "z", "description": "Sepsis with ARDS"},
        {"patient": "p2", "encounter": "e3", "start_date": D(2020, 4, 1), "code": COVID, "description": "COVID-19"},
        {"patient": "p2", "encounter": "e3", "start_date": D(2020, 4, 1), "code": COVID, "description": "COVID-19"},
        {"patient": "p2", "encounter": "e3", "start_date": D(2020, 4, 2), "code": "v", "description": "Hypoxemia"},
        {"patient": "p3", "encounter": "e9", "start_date": D(2020, 5, 1), "code": COVID, "description": "COVID-19"},
        {"patient": "p3", "encounter": None, "start_date": D(2020, 5, 1), "code": COVID, "description": "COVID-19"},
        {"patient": "p9", "encounter": "e8", "start_date": D(2020, 5, 1), "code": COVID, "description": "COVID-19"},
        {"patient": "p4", "encounter": "e7", "start_date": D(2020, 6, 1), "code": "w", "description": "Fever"},
    ])
    obs = observations(spark, [
        {"patient": "p4", "encounter": None, "date": T(2020, 6, 1), "code": "94500-6", "value": "Positive"},
        {"patient": "p1", "encounter": "e1", "date": T(2020, 3, 1), "code": "94500-6", "value": "Negative"},
    ])
    return pats, encs, conds, obs

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from clinlake.functions import (
    as_date,
    as_decimal,
    as_timestamp,
    clinical_age_band,
    decade_age_band,
    first_match_label,
    normalize_gender,
    normalize_identifier,
    percent,
    stay_days,
)
from clinlake.specs import SymptomSpec


def test_normalize_identifier(spark):
    vals = [" a ", "", "  ", "NULL", "null", "Null", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    out = [r[0] for r in df.orderBy("i").select(normalize_identifier(F.col("v"))).collect()]
    assert out == ["a", None, None, None, None, "Null", None]


def test_normalize_gender(spark):
    vals = ["M", " f ", "", None, "OTHER", "non binary", "NULL"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    out = [r[0] for r in df.orderBy("i").select(normalize_gender(F.col("v"))).collect()]
    assert out == ["Male", "Female", None, None, "Other", "Non Binary", "Null"]


def test_tolerant_dates_and_money(spark):
    df = spark.createDataFrame(
        [(0, "2020-03-01", "2020-03-01 10:00:00", "12.345"), (1, "2020-13-45", "nope", "abc"), (2, None, None, None)],
        "i int, d string, t string, m string",
    )
    out = df.orderBy("i").select(
        as_date(df, "d").alias("d"), as_timestamp(df, "t").alias("t"), as_decimal(df, "m", 12, 2).alias("m")
    ).collect()
    assert [tuple(r) for r in out] == [
        (dt.date(2020, 3, 1), dt.datetime(2020, 3, 1, 10, 0), Decimal("12.35")),
        (None, None, None),
        (None, None, None),
    ]
    assert dict(df.select(as_timestamp(df, "t").alias("t")).dtypes)["t"] == "timestamp_ntz"


def test_decade_bands(spark):
    cases = [(-1, True), (10, True), (11, True), (80, True), (81, True), (50, False)]
    df = spark.createDataFrame([(i, a, k) for i, (a, k) in enumerate(cases)], "i int, age int, known boolean")
    birth = F.when(F.col("known"), F.lit(dt.date(1950, 1, 1)))
    out = [r[0] for r in df.orderBy("i").select(decade_age_band(F.col("age"), birth)).collect()]
    assert out == ["0-10", "0-10", "11-20", "71-80", "80+", "Unknown"]


def test_clinical_bands(spark):
    ages = [18, 19, 34, 35, 49, 50, 64, 65, None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, age int")
    out = [r[0] for r in df.orderBy("i").select(clinical_age_band(F.col("age"))).collect()]
    assert out == ["0-18", "19-34", "19-34", "35-49", "35-49", "50-64", "50-64", "65+", "Unknown"]


def test_symptom_labels_first_match_wins(spark):
    descs = ["Sepsis with ARDS", "Acute respiratory distress syndrome", "Chronic HEART FAILURE", "Cough (finding)", "Fever"]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(descs)], "i int, d string")
    out = [r[0] for r in df.orderBy("i").select(first_match_label(F.col("d"), SymptomSpec().labels)).collect()]
    assert out == ["Sepsis", "ARDS", "Heart Failure", "Cough", "Fever"]


def test_stay_days(spark):
    df = spark.createDataFrame(
        [
            (0, dt.datetime(2020, 1, 1, 23, 0), dt.datetime(2020, 1, 2, 1, 0)),
            (1, dt.datetime(2020, 1, 1, 0, 0), None),
            (2, dt.datetime(2020, 1, 5, 0, 0), dt.datetime(2020, 1, 3, 0, 0)),
        ],
        "i int, start timestamp_ntz, stop timestamp_ntz",
    )
    out = [r[0] for r in df.orderBy("i").select(stay_days(F.col("stop"), F.col("start"))).collect()]
    assert out == [1, None, -2]


def test_percent_rounds_and_tolerates_zero(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (0, 5)], "n long, d long")
    out = [r[0] for r in df.select(percent(F.col("n"), F.col("d"))).collect()]
    assert out == [33.33, None, 0.0]


def test_timestamps_keep_wall_clock_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [(0, "2020-03-08 02:30:00"), (1, "2020-03-01 10:00:00+07:00"), (2, "2020-03-01T10:00:00Z"),
             (3, "2020-03-01"), (4, "bad")],
            "i int, t string",
        )
        out = [r[0] for r in df.orderBy("i").select(as_timestamp(df, "t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert out == [
        dt.datetime(2020, 3, 8, 2, 30),  # inside the DST gap: not shifted
        dt.datetime(2020, 2, 29, 22, 0),  # offset text shown in the session zone
        dt.datetime(2020, 3, 1, 5, 0),
        dt.datetime(2020, 3, 1, 0, 0),
        None,
    ]


def test_a_time_without_a_sign_at_its_end_is_not_searched_for_an_offset(spark):
    from clinlake.functions import as_timestamp

    texts = ["1994-01-02T00:00:00Z", "1994-01-02 10:00:00+02", "1994-01-02 10:00:00 -1", "1994-01-02 10:00:00", "1994-01-02", "soon", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [str(r[0]) for r in df.select(as_timestamp(df, "t")).collect()]
    assert out == ["1994-01-02 00:00:00", "1994-01-02 08:00:00", "1994-01-02 11:00:00", "1994-01-02 10:00:00", "1994-01-02 00:00:00", "None", "None", "None"]
    assert "-6, 6" in df.select(as_timestamp(df, "t"))._jdf.queryExecution().analyzed().toString()

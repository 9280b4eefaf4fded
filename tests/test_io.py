import datetime as dt
import os
import uuid

import pytest

from clinlake.operators.checks import reconcile, table_profile
from clinlake.session import scratch_path
from clinlake.sources import catalog, files, jdbc
from clinlake.plans import ingest

from fixtures import D, patients


def test_csv_declared_schema_keeps_zip_and_renames(spark):
    path = scratch_path(spark, "csv-zip")
    os.makedirs(path)
    with open(f"{path}/p.csv", "w") as fh:
        fh.write("Id,BIRTHDATE,DEATHDATE,GENDER,ZIP,LAT,HEALTHCARE_EXPENSES\n")
        fh.write("u1,2000-01-02,,M,02138,42.1,12.345\n")
        fh.write("u2,not-a-date,,F,00501,x,7\n")
    df = ingest.ingest_csv(spark, path, "patients")
    assert "id" in df.columns and "zip" in df.columns and "Id" not in df.columns
    got = {r["id"]: r for r in df.collect()}
    assert got["u1"]["zip"] == "02138" and got["u2"]["zip"] == "00501"
    assert got["u1"]["birthdate"] == dt.date(2000, 1, 2)
    assert got["u2"]["birthdate"] is None and got["u2"]["lat"] is None


def test_csv_roundtrip_keeps_padding(spark):
    p = patients(spark, [{"id": "  p1 ", "birthdate": D(1950, 1, 1), "gender": " f ", "zip": "02138"}])
    path = scratch_path(spark, "csv-rt")
    files.write_csv(p, path, entity="patients")
    back = files.read_csv(spark, path, "patients").collect()[0]
    assert back["id"] == "  p1 " and back["gender"] == " f " and back["zip"] == "02138"


def test_parquet_write_counts_rows_in_the_write(spark):
    path = scratch_path(spark, "pq")
    n = files.write_parquet(spark.range(123), path)
    assert n == 123 and files.read_parquet(spark, path).count() == 123


def test_catalog_write_resolve_reconcile(spark):
    root = scratch_path(spark, "cat")
    ns = "t_" + uuid.uuid4().hex[:8]
    catalog.ensure_namespace(spark, ns, location=root)
    n = catalog.write_table(spark.range(10), f"{ns}.t")
    assert n == 10
    n = catalog.write_table(spark.range(4).selectExpr("id", "id * 2 AS twice"), f"{ns}.t")  # replace, new schema
    assert n == 4 and spark.table(f"{ns}.t").columns == ["id", "twice"]
    assert catalog.table_exists(spark, f"{ns}.t")
    assert catalog.resolve_table(spark, f"{ns}.missing", required=False) is None
    with pytest.raises(RuntimeError):
        catalog.resolve_table(spark, f"{ns}.missing")
    r = reconcile(spark, f"{ns}.t", 4, label="t").collect()[0]
    assert (r["table_name"], r["expected_rows"], r["persisted_rows"], r["ok"]) == ("t", 4, 4, True)
    keys = {r["col_name"] for r in catalog.describe_table(spark, f"{ns}.t").collect()}
    assert {"Type", "Provider", "Location"} <= keys
    assert "t" in {r["tableName"] for r in catalog.list_tables(spark, ns).collect()}


def test_table_profile_is_one_plan(spark):
    prof = table_profile({("a", "x"): spark.range(3), ("b", "y"): spark.range(5).selectExpr("id", "id")})
    assert sorted(tuple(r) for r in prof.collect()) == [("a", "x", 3, 1), ("b", "y", 5, 2)]


def test_jdbc_options():
    o = jdbc.jdbc_options("jdbc:x://h/db", "encounters", user="u", password="p",
                          partition_column="n", lower_bound=0, upper_bound=100, num_partitions=8)
    assert o["fetchsize"] == "10000" and o["numPartitions"] == "8" and o["partitionColumn"] == "n"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x://h/db", "t", partition_column="n")


def test_hash_bucket_predicates_cover_all_rows():
    preds = jdbc.hash_bucket_predicates("id", 4)
    assert len(preds) == 4 and preds[0].endswith("= 0 OR id IS NULL") and preds[3].endswith("= 3")
    assert all("hashtext(id::text)" in p for p in preds)


def test_extracts_read_in_parallel_by_default(monkeypatch, spark):
    asked = []
    monkeypatch.setattr(jdbc, "read_jdbc", lambda spark, **kw: asked.append(kw) or spark.range(1))
    ingest.extract_db_to_raw(spark, scratch_path(spark, "jdbc-raw"), url="jdbc:postgresql://h/db")
    assert [len(kw["predicates"]) for kw in asked] == [jdbc.DEFAULT_BUCKETS] * 3


@pytest.mark.parametrize("url,given,want", [
    ("jdbc:postgresql://h/db", {}, "unspecified"), ("jdbc:postgresql://h/db", {"stringtype": "varchar"}, "varchar"), ("jdbc:mysql://h/db", {}, None)])
def test_load_into_postgresql_leaves_text_untyped(monkeypatch, spark, url, given, want):
    seen = []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, url, table, properties, **kw: seen.append(properties.get("stringtype")) or 0)
    monkeypatch.setattr(ingest, "ingest_csv", lambda spark, path, entity: None)
    ingest.load_csv_to_db(spark, {"patients": "/p"}, url, given)
    assert seen == [want]


def _csv(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as fh:
        fh.write(text)


def test_csv_times_with_offsets_are_kept(spark):
    path = scratch_path(spark, "csv-offsets")
    _csv(path, "e.csv", "Id,START,STOP,PATIENT,TOTAL_CLAIM_COST\n"
         "e1,2020-03-01T10:00:00Z,2020-03-01 12:30:00+02:00,p1,12.345\ne2,2020-03-01 10:00:00,soon,p1,abc\n")
    got = {r["id"]: r for r in files.read_csv(spark, path, "encounters").collect()}
    assert got["e1"]["start_time"] == got["e2"]["start_time"] == dt.datetime(2020, 3, 1, 10)
    assert got["e1"]["stop_time"] == dt.datetime(2020, 3, 1, 10, 30) and got["e2"]["stop_time"] is None
    assert str(got["e1"]["total_claim_cost"]) == "12.35" and got["e2"]["total_claim_cost"] is None


def test_csv_files_of_different_headers(spark):
    path = scratch_path(spark, "csv-headers")
    _csv(path, "a.csv", "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION\n2020-01-01,,p1,e1,c,d one\n")
    _csv(path, "b.csv", "patient,Code,START,extra,DESCRIPTION,description\np2,c2,2020-01-02,x,d two,other\n")
    got = {r["patient"]: r for r in files.read_csv(spark, path, "conditions").collect()}
    assert got["p1"]["encounter"] == "e1" and got["p1"]["extra"] is None and got["p1"]["description"] == "d one"
    assert got["p2"]["start_date"] == dt.date(2020, 1, 2) and got["p2"]["code"] == "c2" and got["p2"]["encounter"] is None
    assert got["p2"]["description"] == "d two" and got["p2"]["extra"] == "x"


def test_csv_counts_values_that_became_null(spark, caplog):
    path = scratch_path(spark, "csv-lost")
    _csv(path, "p.csv", "ID,BirthDate,LAT\nu1,2000-01-02,1\nu2,not-a-date,x\nu3,,2\n")
    with caplog.at_level("WARNING"):
        assert ingest.csv_to_raw(spark, path, "patients", scratch_path(spark, "raw-lost")) == 3
    assert "'nullified_birthdate': 1" in caplog.text and "'nullified_lat': 1" in caplog.text
    assert "deathdate" not in caplog.text


def test_tables_of_a_v2_catalog_take_no_path(monkeypatch, spark):
    monkeypatch.setattr(catalog, "_is_session_catalog", lambda spark, name: False)
    with pytest.raises(ValueError):
        catalog.write_table(spark.range(1), "cat.ns.t", path="/somewhere")


def test_scale_conf():
    from clinlake.session import MAX_REDUCERS, scale_conf

    conf = scale_conf(shuffle_bytes=100 * 2**40, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == MAX_REDUCERS
    assert int(conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == -(-100 * 2**40 // MAX_REDUCERS)
    assert int(scale_conf(10 * 2**20, total_cores=8)["spark.sql.shuffle.partitions"]) == 16
    assert int(scale_conf(2**40, total_cores=100)["spark.sql.shuffle.partitions"]) == 4096


def test_drop_table_and_namespace_reentry(spark):
    root = scratch_path(spark, "cat-drop")
    ns = "d_" + uuid.uuid4().hex[:8]
    catalog.ensure_namespace(spark, ns, location=root)
    catalog.ensure_namespace(spark, ns, location=root)  # IF NOT EXISTS: second call is a no-op
    catalog.write_table(spark.range(3), f"{ns}.t")
    catalog.drop_table(spark, f"{ns}.t")
    catalog.drop_table(spark, f"{ns}.t")  # IF EXISTS
    assert not catalog.table_exists(spark, f"{ns}.t")


def test_scale_conf_keys_are_accepted_by_a_session(spark):
    from clinlake.session import scale_conf

    conf = scale_conf(shuffle_bytes=2**30, total_cores=8)
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
            assert spark.conf.get(k) == v
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_headers_come_from_one_job_and_any_file(spark):
    import os

    from clinlake.sources.files import _headers

    path = scratch_path(spark, "odd headers")
    os.makedirs(path)
    files_ = {"a b.csv": '﻿Id,"START, at",x\n1,2,3\n', "b%20.csv": "\n\nid,,y\n", "c.csv": "", "d.csv": 'id,"q ""x"""\n' + "1,2\n" * 50_000, "e.csv": "only"}
    for name, text in files_.items():
        with open(f"{path}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    found = {p.rsplit("/", 1)[-1]: h for p, h in _headers(spark, path).items()}
    assert found == {"a b.csv": ("Id", "START, at", "x"), "b%20.csv": ("id", "_c1", "y"), "d.csv": ("id", 'q "x"'), "e.csv": ("only",)}


def test_rejected_values_are_kept_with_their_rows(spark):
    import json
    import os

    from clinlake.plans import ingest

    root = scratch_path(spark, "rejected")
    for name, text in (("one", "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION\n2024-01-02,never,p1,e1,1,a\n2024-13-01,,p2,e2,2,b\n"),
                       ("two", "PATIENT,START\np3,2024-02-30\np4,2024-02-28\n")):
        os.makedirs(f"{root}/landing/{name}", exist_ok=True)
        with open(f"{root}/landing/{name}/part.csv", "w") as f:
            f.write(text)
    assert ingest.csv_to_raw(spark, f"{root}/landing/*", "conditions", f"{root}/raw/conditions") == 4
    kept = spark.read.parquet(ingest.rejected_path(f"{root}/raw/conditions")).collect()
    assert sorted((r["column_name"], r["value"], r["wanted"], json.loads(r["record"])["patient"]) for r in kept) == [
        ("start_date", "2024-02-30", "date", "p3"), ("start_date", "2024-13-01", "date", "p2"), ("stop_date", "never", "date", "p1")]
    assert {r["file"] for r in kept} == {"part.csv"}
    assert ingest.csv_to_raw(spark, f"{root}/landing/two", "conditions", f"{root}/raw/conditions") == 2
    with open(f"{root}/landing/two/part.csv", "w") as f:
        f.write("PATIENT,START\np4,2024-02-28\n")
    assert ingest.csv_to_raw(spark, f"{root}/landing/two", "conditions", f"{root}/raw/conditions") == 1
    assert not os.path.exists(ingest.rejected_path(f"{root}/raw/conditions").removeprefix("file:"))

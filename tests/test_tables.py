"""Refresh, partition overwrite, content checks and history of catalog tables."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clinlake.operators import history
from clinlake.operators.checks import ContentCheck, content_checksum
from clinlake.session import scratch_path
from clinlake.sources import catalog


@pytest.fixture
def ns(spark):
    root = scratch_path(spark, "tables-test")
    name = "t_" + root.rsplit("-", 1)[-1]
    catalog.ensure_namespace(spark, name, location=root)
    yield name
    spark.sql(f"DROP NAMESPACE IF EXISTS {name} CASCADE")


def content(spark, name):
    return sorted(map(str, spark.table(name).collect()))


@pytest.mark.parametrize("external", [False, True])
def test_failed_write_or_check_leaves_the_old_table(spark, ns, external):
    path = scratch_path(spark, "ext") if external else None
    name, df = f"{ns}.t", spark.range(100).selectExpr("id", "id % 7 AS v")
    assert catalog.write_table(df, name, path=path) == 100
    old = content(spark, name)
    failing = df.withColumn("v", F.when(F.col("id") == 50, F.raise_error(F.lit("bad row"))).otherwise(F.col("v")))
    with pytest.raises(PySparkException):
        catalog.write_table(failing, name, path=path)
    assert content(spark, name) == old

    def refuse(staged):
        assert staged.count() == 10
        raise RuntimeError("refused")

    with pytest.raises(RuntimeError, match="refused"):
        catalog.write_table(df.limit(10), name, path=path, check=refuse)
    assert content(spark, name) == old
    assert catalog.write_table(df.filter("id < 3"), name, path=path) == 3
    assert [r["id"] for r in spark.table(name).sort("id").collect()] == [0, 1, 2]
    kind = {r["col_name"]: r["data_type"] for r in catalog.describe_table(spark, name).collect()}
    assert kind["Type"] == ("EXTERNAL" if external else "MANAGED")


def test_a_reader_of_the_old_version_can_finish(spark, ns):
    name = f"{ns}.t"
    catalog.write_table(spark.range(1000).toDF("id"), name)
    reader = spark.table(name).filter("id >= 0")
    assert reader.count() == 1000
    catalog.write_table(spark.range(5).toDF("id"), name)
    assert spark.table(name).count() == 5
    assert reader.count() in (1000, 5)


def test_refresh_from_the_table_itself_and_other_columns(spark, ns):
    name = f"{ns}.t"
    catalog.write_table(spark.range(10).toDF("id"), name)
    catalog.write_table(spark.table(name).filter("id > 4"), name)
    assert spark.table(name).count() == 5
    catalog.write_table(spark.table(name).withColumn("more", F.lit("x")), name)
    assert spark.table(name).columns == ["id", "more"]
    catalog.write_table(spark.range(6).selectExpr("id", "id % 2 AS part"), name, partition_by=["part"])
    assert spark.table(name).filter("part = 1").count() == 3
    catalog.drop_table(spark, name)
    assert not catalog.table_exists(spark, name)
    catalog.write_table(spark.range(2).toDF("id"), name)
    assert spark.table(name).count() == 2


def test_nothing_but_versions_is_deleted_beside_a_table(spark, ns):
    import os

    path = scratch_path(spark, "shared-folder")
    os.makedirs(f"{path}/other_table")
    open(f"{path}/other_table/part.txt", "w").close()
    for n in (3, 4, 5):
        catalog.write_table(spark.range(n).toDF("id"), f"{ns}.t", path=path)
    kept = sorted(os.listdir(path))
    assert os.path.exists(f"{path}/other_table/part.txt") and len(kept) == 3  # the version in use and the one before
    assert spark.table(f"{ns}.t").count() == 5


def test_partition_overwrite_keeps_the_others(spark, ns):
    name = f"{ns}.p"
    df = spark.range(60).selectExpr("id", "cast(id % 3 as int) AS part")
    assert catalog.overwrite_partitions(df, name, ["part"]) == 60
    untouched = sorted(f for f in spark.table(name).filter("part = 0").inputFiles())
    new = spark.createDataFrame([(7, 1), (8, 5), (9, None)], "id long, part int")
    assert catalog.overwrite_partitions(new, name, ["part"]) == 3
    counts = {r["part"]: r["count"] for r in spark.table(name).groupBy("part").count().collect()}
    assert counts == {0: 20, 1: 1, 2: 20, 5: 1, None: 1}
    assert sorted(spark.table(name).filter("part = 0").inputFiles()) == untouched
    assert catalog.overwrite_partitions(df.filter("id < 0"), name, ["part"]) == 0
    assert spark.table(name).count() == 43
    with pytest.raises(ValueError):
        catalog.overwrite_partitions(spark.range(3).toDF("id"), name, ["part"])
    failing = df.withColumn("id", F.when(F.col("id") == 40, F.raise_error(F.lit("bad"))).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        catalog.overwrite_partitions(failing, name, ["part"])
    assert spark.table(name).count() == 43


def test_content_check_finds_one_changed_value(spark, ns):
    name = f"{ns}.c"
    df = spark.range(500).selectExpr("id", "concat('v', id % 10) AS v", "if(id % 3 = 0, null, date'2024-01-01') AS d")
    check = ContentCheck("c", df.columns)
    catalog.write_table(check.observed(df.repartition(7)), name, check=check.check)
    assert check.compare(spark.table(name)).first()["ok"]
    read = spark.table(name)
    for changed in (read.withColumn("v", F.when(F.col("id") == 77, "v8").otherwise(F.col("v"))), read.filter("id != 3"),
                    read.withColumn("d", F.when(F.col("id") == 3, F.lit("2024-01-01").cast("date")).otherwise(F.col("d"))),
                    read.filter("id != 5").unionByName(read.filter("id = 6"))):
        assert not check.compare(changed).first()["ok"]
        with pytest.raises(RuntimeError):
            check.check(changed)
    with pytest.raises(RuntimeError):  # found before the table is refreshed
        other = ContentCheck("c", df.columns)
        catalog.write_table(other.observed(df.filter("id < 100")), name, check=lambda staged: other.check(staged.filter("id != 9")))
    assert spark.table(name).count() == 500


def test_checksum_is_order_free_and_keeps_values_apart(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "x"), ("x", None), ("-", "x"), ("", None)]

    def total(own):
        return spark.createDataFrame(own, "p string, q string").agg(*content_checksum(["p", "q"])).first()

    assert total(rows) == total(rows[::-1])
    assert len({total([r])["checksum"] for r in rows}) == len(rows)
    assert tuple(spark.createDataFrame([], "p string, q string").agg(*content_checksum(["p", "q"])).first()) == (0, 0)


KIND = "k long, v string, n double"
LOADS = [
    [(1, "a", 1.0), (2, "b", None), (2, "b", None), (None, "z", 0.5), (3, None, 1.0)],
    [(1, "A", 1.0), (2, "b", None), (None, "z", 0.5), (None, "z", 0.5), (4, "", 2.0)],
    [],
    [(1, "a", 1.0), (None, "z", 0.5)],
]


def bag(rows):
    return sorted(map(str, map(tuple, rows)))


def test_history_gives_back_every_load(spark, ns):
    name = f"{ns}.h"
    for load, rows in enumerate(LOADS, 1):
        history.record_load(spark.createDataFrame(rows, KIND), name, 10 * load)
    for load, rows in enumerate(LOADS, 1):
        assert bag(history.as_of(spark, name, 10 * load).collect()) == bag(rows), load
        assert bag(history.as_of(spark, name, 10 * load + 9).collect()) == bag(rows)
    assert history.as_of(spark, name, 5).count() == 0
    found = {r["k"]: (r["change"], r["rows_ended"], r["rows_begun"]) for r in history.changes(spark, name, 20, ["k"]).collect()}
    assert found == {1: ("update", 1, 1), 2: ("update", 2, 1), None: ("update", 1, 2), 3: ("delete", 1, 0), 4: ("insert", 0, 1)}
    assert {r["change"] for r in history.changes(spark, name, 10, ["k"]).collect()} == {"insert"}
    with pytest.raises(ValueError):
        history.record_load(spark.createDataFrame(LOADS[0], KIND), name, 40)
    with pytest.raises(ValueError):
        history.record_load(spark.createDataFrame([(1,)], "k long"), name, 50)
    with pytest.raises(ValueError):
        history.record_load(spark.createDataFrame([(1, 2)], "k long, copies int"), f"{ns}.other", 1)


def test_unchanged_rows_are_not_opened_again(spark, ns):
    name, df = f"{ns}.h", spark.range(1000).selectExpr("id AS k", "'same' AS v")
    assert history.record_load(df, name, 1) == {"opened": 1000, "closed": 0, "unchanged": 0}
    changed = df.withColumn("v", F.when(F.col("k") < 3, "new").otherwise(F.col("v")))
    assert history.record_load(changed, name, 2) == {"opened": 3, "closed": 3, "unchanged": 997}
    assert spark.table(f"{name}_closed").count() == 3


def test_a_load_that_fails_half_way_can_be_done_again(spark, ns, monkeypatch):
    name = f"{ns}.h"
    first, second = (spark.createDataFrame(rows, KIND) for rows in LOADS[:2])
    history.record_load(first, name, 1)

    def fail(*args, **kwargs):
        raise RuntimeError("executor storage is gone")

    history.record_load(second, name, 2)
    with monkeypatch.context() as m:
        real = catalog.write_table
        m.setattr(catalog, "write_table", lambda df, table, **k: fail() if table.endswith("_open") else real(df, table, **k))
        with pytest.raises(RuntimeError):
            history.record_load(first, name, 3)
    assert history.last_load(spark, name) == 2
    assert bag(history.as_of(spark, name, 1).collect()) == bag(LOADS[0])
    assert bag(history.as_of(spark, name, 2).collect()) == bag(LOADS[1])
    history.record_load(second, name, 3)  # done again, with other rows: nothing of the failed attempt is left
    assert history.changes(spark, name, 3, ["k"]).count() == 0
    assert bag(history.as_of(spark, name, 3).collect()) == bag(LOADS[1])


def test_a_load_is_one_aggregate_and_stores_no_hashes(spark, ns):
    name, df = f"{ns}.h", spark.range(100).selectExpr("id AS k", "concat('v', id % 3) AS v")
    history.record_load(df, name, 1)
    history.record_load(df.filter("k > 9"), name, 2)
    assert spark.table(f"{name}_open").columns == ["k", "v", "copies", "valid_from", "load"]
    assert sorted(spark.table(f"{name}_closed").columns) == ["copies", "k", "v", "valid_from", "valid_to"]
    plan = history._met(df, spark.table(f"{name}_open"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "SortAggregate" not in plan
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1

from pyspark.sql import functions as F

from clinlake.plans.medallion import gold_tables, run_medallion, scratch_config
from clinlake.session import scratch_path
from clinlake.sources import standins

from conftest import SF_SMALL


def _setup(spark, sf_dir):
    root = scratch_path(spark, "pipe")
    csv_paths, obs_path = standins.land_sources(spark, sf_dir, root)
    return scratch_config(spark, root, csv_paths=csv_paths, observations_raw=obs_path, spec=standins.STANDIN_SPEC)


def _snapshot(spark, cfg):
    out = {}
    for name in gold_tables(spark, cfg):
        df = spark.table(f"{cfg.gold_ns}.{name}")
        out[name] = sorted((tuple(r) for r in df.collect()), key=repr)
    out["master"] = sorted((tuple(r) for r in spark.table(f"{cfg.silver_ns}.covid_clinical_master").collect()), key=repr)
    return out


def test_medallion_invariants_and_idempotence(spark):
    cfg = _setup(spark, SF_SMALL)
    counts = {(r["stage"], r["table_name"]): r["row_count"] for r in run_medallion(spark, cfg).collect()}
    s, g = cfg.silver_ns, cfg.gold_ns
    master = spark.table(f"{s}.covid_clinical_master")
    assert counts[("silver", "covid_clinical_master")] == master.count() > 0
    # master keys unique
    assert master.select("patient_id").distinct().count() == master.count()
    # sum of mortality counts = dead master rows
    dead = master.filter(F.col("patient_deathdate").isNotNull()).count()
    assert spark.table(f"{g}.mortality_demographics").agg(F.sum("mortality_count")).first()[0] == dead
    # hospitalized + home isolation = total; recovered + deaths = total
    row = spark.table(f"{g}.covid_pathway_summary").first()
    assert row["hospitalized_cases"] + row["home_isolation_cases"] == row["total_covid_cases"] == master.count()
    assert row["recovered_cases"] + row["death_cases"] == row["total_covid_cases"]
    first = _snapshot(spark, cfg)
    run_medallion(spark, cfg, stages=("raw", "bronze", "silver", "gold"))
    assert _snapshot(spark, cfg) == first


def test_medallion_without_observations(spark):
    """No Bronze observations table: cohort from coded conditions only, same master schema."""
    root = scratch_path(spark, "pipe-noobs")
    csv_paths, _ = standins.land_sources(spark, SF_SMALL, root)
    cfg = scratch_config(spark, root, csv_paths=csv_paths, spec=standins.STANDIN_SPEC)
    tables = {r["table_name"] for r in run_medallion(spark, cfg, stages=("raw", "bronze", "silver")).collect()}
    assert "observations" not in tables and "covid_clinical_master" in tables
    master = spark.table(f"{cfg.silver_ns}.covid_clinical_master")
    assert len(master.columns) == 32
    assert master.filter("observation_count <> 0 OR last_observation_time IS NOT NULL").count() == 0
    from clinlake.plans import silver

    s = cfg.silver_ns
    coded = silver.cohort_from_conditions(spark.table(f"{s}.conditions"), standins.STANDIN_SPEC.cohort)
    expected = spark.table(f"{s}.patients").join(coded, "patient_id", "left_semi").count()
    assert master.count() == expected


def test_cli_arguments_build_the_config():
    from clinlake.cli import config_from_args, parse_args

    a = parse_args(["run", "--csv", "patients=/p", "--csv", "encounters=/e", "--raw-dir", "/raw",
                    "--as-of", "2024-12-31", "--stages", "raw,bronze"])
    cfg = config_from_args(a)
    assert cfg.csv_paths == {"patients": "/p", "encounters": "/e"} and cfg.raw_dir == "/raw"
    assert str(cfg.as_of) == "2024-12-31" and cfg.jdbc is None and a.stages == "raw,bronze"
    assert cfg.concurrent_writes == 4
    assert config_from_args(parse_args(["run", "--raw-dir", "/r", "--concurrent-writes", "1"])).concurrent_writes == 1


def test_cli_runs_the_stages(spark):
    import subprocess
    import sys

    root = scratch_path(spark, "cli")
    csv_paths, _ = standins.land_sources(spark, SF_SMALL, root)
    repo = __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__)))
    args = [sys.executable, "-m", "clinlake", "run", "--stages", "raw,bronze", "--raw-dir", f"{root}/raw",
            "--table-root", f"{root}/tables"]
    for entity, path in csv_paths.items():
        args += ["--csv", f"{entity}={path}"]
    env = dict(__import__("os").environ, PYSPARK_SUBMIT_ARGS="--conf spark.ui.enabled=false pyspark-shell")
    out = subprocess.run(args, cwd=repo, capture_output=True, text=True, timeout=600, env=env)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "bronze" in out.stdout and "encounters" in out.stdout


def _files_below(spark, path):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, out = fs.listFiles(root, True), []
    while found.hasNext():
        out.append(found.next().getPath().toString())
    return [f for f in out if "/part-" in f]


def test_a_run_for_one_table_leaves_no_other_files(spark, monkeypatch):
    """Landing files, Raw, Bronze and the other tables of the run are gone; the result is whole."""
    from clinlake.plans import queries

    for name, table, same in (("run_silver_conditions", "conditions", "clean_conditions"), ("run_master", "covid_clinical_master", "clinical_master"),
                              ("run_pathway_summary", "covid_pathway_summary", "pathway_summary")):
        roots = []
        monkeypatch.setattr(queries, "scratch_path", lambda s, n: roots.append(scratch_path(s, n)) or roots[-1])
        result = queries.QUERIES[name](spark, SF_SMALL)
        left = _files_below(spark, roots[0])
        assert left and all(f"/{table}/" in f for f in left), left
        want = queries.QUERIES[same](spark, SF_SMALL)
        assert sorted(map(str, result.collect())) == sorted(map(str, want.select(*result.columns).collect()))


def test_sources_and_raw_go_only_from_runs_on_copies(spark):
    cfg = _setup(spark, SF_SMALL)
    run_medallion(spark, cfg, stages=("raw", "bronze"))
    assert all(_files_below(spark, p) for p in [*cfg.csv_paths.values(), cfg.raw_dir, cfg.observations_raw])
    rejected = f"{cfg.raw_dir}/_rejected/patients"
    spark.range(1).write.parquet(rejected)
    cfg.drop_read = True
    run_medallion(spark, cfg, stages=("bronze",))
    assert _files_below(spark, cfg.raw_dir) == _files_below(spark, rejected) != []


def test_shuffle_files_go_when_their_write_ends(spark):
    from clinlake.session import freed_shuffles

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in files.mkString("\n").split("\n") if "shuffle_" in f}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffles(), spark.conf.get(key)
    with freed_shuffles(spark):
        spark.range(100_000).repartition(4, "id").write.parquet(scratch_path(spark, "freed"))
        assert not shuffles() - before
    assert spark.conf.get(key) == setting
    spark.conf.set(key, "true")
    try:
        with freed_shuffles(spark):
            pass
        assert spark.conf.get(key) == "true"
    finally:
        spark.conf.unset(key)


def test_landing_files_are_packed_and_read_back_whole(spark):
    from clinlake.sources import files

    csv_paths, _ = standins.land_sources(spark, SF_SMALL, scratch_path(spark, "packed"))
    for entity, source in (("conditions", standins.bronze_conditions), ("patients", standins.bronze_patients)):
        assert all(f.endswith(".csv.gz") for f in _files_below(spark, csv_paths[entity]))
        got, want = files.read_csv(spark, csv_paths[entity], entity), source(spark, SF_SMALL)
        assert got.count() == want.count()
        key = {"conditions": ("patient", "code", "description"), "patients": ("address", "first")}[entity]
        assert got.select(*key).exceptAll(want.select(*key)).isEmpty()

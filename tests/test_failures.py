"""Alerts and error logs, written by the jobs themselves."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_gate import AT, HEAD, file, folder, lines  # noqa: F401  (a fixture)

import wardline.__main__ as cli
from wardline.operators import checks, joins, scd2
from wardline.plans import failures, gold, ingest
from wardline.registry.adapters import ntz
from wardline.session import scratch_path, written
from wardline.sinks import audit
from wardline.sources import files


def test_the_gate_writes_messages_for_files_that_do_not_load(spark, folder):
    file(folder, "patient_admissions_ok.csv", HEAD, lines())
    file(folder, "patient_admissions_bad's.csv", HEAD, lines({"length_of_stay": "x"}))
    file(folder, "patient_admissions_wide.csv", HEAD, lines({"department": "D" * 30}))
    stores = ingest.Stores(scratch_path(spark, "stores"))
    ingest.seed_recipients(spark, stores, ["b@example.org", "a@example.org"], AT)
    ingest.seed_recipients(spark, stores, ["late@example.org"], AT)  # the table has some already
    for _ in range(2):  # a repeat doubles nothing
        ingest.run_gate(spark, str(folder), stores, "r1", AT)
    got = {r["subject"]: r for r in spark.read.parquet(stores.log("alert_outbox")).collect()}
    assert set(got) == {"GATEKEEPER QUARANTINE - patient_admissions_bads.csv", "GATEKEEPER QUARANTINE - patient_admissions_wide.csv"}
    bad = got["GATEKEEPER QUARANTINE - patient_admissions_bads.csv"]
    assert bad["recipients"] == ["a@example.org", "b@example.org"] and "'" not in bad["body"]
    assert "  Status:         QUARANTINED (not loaded)\n" in bad["body"] and "non-numeric rows=1" in bad["body"]
    assert "  Status:         LOAD_FAILED (not loaded)\n" in got["GATEKEEPER QUARANTINE - patient_admissions_wide.csv"]["body"]


def test_outbox_plan_has_no_product(spark):
    log = spark.createDataFrame([("r", "f", "x", "QUARANTINED", 0, 1, 1, "c", "a", AT)], audit.FILE_LOG)
    to = spark.createDataFrame([(f"{i}@e", "DQ_FAILURE", i % 2 == 0, AT) for i in range(4)], audit.RECIPIENTS)
    out = audit.alert_outbox(log, to)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert sorted(r["recipient_email"] for r in out.collect()) == ["0@e", "2@e"]
    assert audit.alert_outbox(log, to.limit(0)).count() == 0


LOG = "2026 INFO start\n\x1b[31mERROR creating sql view model STAGING.stg_claims\x1b[0m\nFailure in test not_null_x\nFailure in test not_null_x\n"


@pytest.fixture()
def task_logs(tmp_path):
    def add(dag, run, task, text, attempt=1):
        d = tmp_path / "logs" / f"dag_id={dag}" / f"run_id={run}" / f"task_id={task}"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"attempt={attempt}.log").write_text(text)

    add("healthcare_pipeline", "scheduled__2026-01-01T00:10:00+00:00", "dbt_run", LOG)
    add("healthcare_pipeline", "scheduled__2026-01-01T00:10:00+00:00", "dbt_snapshot", "nothing to see\n")
    add("healthcare_pipeline", "other", "dbt_run", "Database Error in snapshot scd_doctors\n")
    (tmp_path / "failed.csv").write_text(
        "dag_id,run_id,task_id,triggered_by,try_no,max_tries\n"
        "healthcare_pipeline,scheduled__2026-01-01T00:10:00+00:00,dbt_run,scheduled,2,2\n"
        "healthcare_pipeline,scheduled__2026-01-01T00:10:00+00:00,dbt_snapshot,scheduled,1,2\n"
        "healthcare_pipeline,no log,dbt_test,manual,1,2\n"
        "gatekeeper_dag,r9,gatekeeper_validate,scheduled,1,2\n")
    return tmp_path


def test_failed_tasks_get_causes_messages_and_log_rows(spark, task_logs):
    stores = ingest.Stores(scratch_path(spark, "stores"))
    ingest.seed_recipients(spark, stores, ["a@example.org"], AT)
    for _ in range(2):
        got = failures.mine(spark, str(task_logs / "logs"), str(task_logs / "failed.csv"), stores, "m1", AT).collect()
    rows = {r["task_id"]: r for r in got}
    assert len(got) == 4
    assert rows["dbt_run"]["error_summary"] == "Model failed to build: STAGING.stg_claims  Test failed: not_null_x"
    assert rows["dbt_run"]["attempt"] == "2 of 2" and rows["dbt_run"]["action"].endswith("then re-run the pipeline.")
    assert rows["dbt_snapshot"]["error_summary"] == "dbt failed to capture SCD2 snapshot history."
    assert rows["dbt_test"]["error_summary"] == "One or more dbt data-quality tests failed."
    assert rows["gatekeeper_validate"]["error_summary"].startswith("The gatekeeper worker itself failed to run")
    assert rows["gatekeeper_validate"]["action"] == "Open Airflow > gatekeeper_dag > gatekeeper_validate > Logs for the full error, fix the issue, then re-run."
    box = {r["subject"]: r["body"] for r in spark.read.parquet(stores.log("alert_outbox")).collect()}
    assert len(box) == 4
    assert "  What happened:\n    - The gatekeeper" in box["Gatekeeper Pipeline FAILED - gatekeeper_validate"]
    assert "  Root cause:\n    - Model failed to build" in box["Airflow Pipeline FAILED - dbt_run"]
    assert "  Failed at:      2026-06-29 13:02:45\n" in box["Airflow Pipeline FAILED - dbt_run"]


def test_command_line_records_its_own_failures(spark, folder, tmp_path, monkeypatch):
    file(folder, "patient_admissions_ok.csv", HEAD, lines())
    root = scratch_path(spark, "cli")
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    cli.main(["gate", "--incoming", str(folder), "--root", root, "--recipients", "a@example.org"])
    assert spark.read.parquet(f"{root}/audit/file_processing_log").first()["status"] == "PASSED"
    with pytest.raises(Exception):
        cli.main(["build", "--root", root, "--seeds", str(tmp_path / "no such folder")])
    row = spark.read.parquet(f"{root}/audit/pipeline_error_log").first()
    assert (row["dag_id"], row["task_id"], row["status"]) == ("wardline", "build", "FAILED") and row["error_summary"]
    box = spark.read.parquet(f"{root}/audit/alert_outbox").filter("subject like 'Airflow%'").first()
    assert box["recipients"] == ["a@example.org"]
    cli.main(["expire", "--root", root, "--keep", "1"])


def test_a_source_that_repeats_an_id_is_refused_with_its_ids(spark):
    dim = gold.dim_doctor(spark.createDataFrame([("D1", "a", "x", 1), ("D2", "b", "x", 2), ("D2", "c", "y", 2)],
                                                "doctor_id string, doctor_name string, specialty string, years_experience int"))
    with pytest.raises(scd2.RepeatedKeys, match=r"doctor_id repeated: D2 \(2 rows\)"):
        gold.doctor_snapshot(None, dim, ntz("2026-01-01 00:00:00"))


@pytest.mark.parametrize("most", [0, 100])
def test_rows_of_one_file_meet_its_plan_on_many_tasks(spark, folder, most):
    file(folder, "patient_admissions_a.csv", HEAD, lines(n=200))
    file(folder, "patient_admissions_b.csv", HEAD, lines(n=5))
    headers, staged = files.read_files(files.read_lines(spark, str(folder)))
    manifest = files.recognised(files.file_manifest(spark, str(folder)))
    plan = written(checks.file_plan(manifest, headers), "plan")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = checks.placed_rows(staged, plan, most)
        text = placed._jdf.queryExecution().executedPlan().toString()
        assert {r["file_name"]: r["count"] for r in placed.groupBy("file_name").count().collect()} == {"patient_admissions_a.csv": 200, "patient_admissions_b.csv": 5}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [x for x in text.splitlines() if "Exchange hashpartitioning" in x]
    assert all("_deal" in x or "_d#" in x for x in exchanges) and bool(exchanges) == (most == 0)


def test_about_group_equals_a_plain_join(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").repartition(7)
    facts = written(spark.createDataFrame([(0, "a"), (1, "b"), (5, "c")], "k long, v string"), "facts")
    want = sorted(map(tuple, rows.join(facts, "k").select("k", "id", "v").collect()))
    for most in (0, 10):
        assert sorted(map(tuple, joins.about_group(rows, facts, "k", most).select("k", "id", "v").collect())) == want

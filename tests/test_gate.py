"""One defect per CSV file, through the whole gate."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wardline.feeds import ADMISSIONS, CLAIMS, TREATMENTS, GateLimits
from wardline.operators import checks as c
from wardline.plans import ingest
from wardline.registry import gate_files, q_gate
from wardline.session import scratch_path, written
from wardline.sinks import bronze
from wardline.sources import files

AT = dt.datetime(2026, 6, 29, 13, 2, 45)
HEAD = ",".join(ADMISSIONS.columns)


def adm(i, **change):
    row = dict(
        admission_id=i, patient_id=100 + i, doctor_id="D001", hospital_id="H01", admit_date="2024-05-06", department="ER",
        admission_type="EMG", diagnosis_code="A1", length_of_stay=3, readmission_flag=0,
    ) | change
    return ",".join(str(row[k]) for k in ADMISSIONS.columns)


def lines(*changes, n=20):
    return [adm(i, **(changes[i] if i < len(changes) else {})) for i in range(n)]


def file(folder, name, header, rows):
    (folder / name).write_text("\n".join([header, *rows]) + "\n")


@pytest.fixture()
def folder(tmp_path):
    d = tmp_path / "incoming"
    d.mkdir()
    return d


def gate(spark, folder, limits=GateLimits()):
    headers, staged = files.read_files(files.read_lines(spark, str(folder)))
    manifest = files.recognised(files.file_manifest(spark, str(folder)))
    rows = c.check_rows(c.file_plan(manifest, headers), staged, limits)
    out = {}
    for r in rows.collect():
        out.setdefault(r["file_name"], {})[r["check_name"]] = (r["passed"], r["detail"])
    status = {r["file_name"]: r["status"] for r in c.file_verdicts(rows).collect()}
    return out, status


CASES = {
    "clean": (HEAD, lines(), None, None),
    "missing_column": (HEAD.rsplit(",", 1)[0], [x.rsplit(",", 1)[0] for x in lines()], "column_count", "found 9, expected 10"),
    "extra_column": (HEAD + ",note", [x + ",n" for x in lines()], "column_count", "found 11, expected 10"),
    "two_extra_columns": (HEAD + ",n1,n2", [x + ",n,m" for x in lines()], "column_count", "found 12, expected 10"),
    "fifteen_columns": (HEAD + ",a,b,c,d,e", [x + ",,,,," for x in lines()], "column_count", "found 15, expected 10"),
    "renamed_required": (HEAD.replace("doctor_id", "doc"), lines(), "required_columns", "missing=['doctor_id']"),
    "two_renamed": (HEAD.replace("doctor_id", "doc").replace("hospital_id", "hos"), lines(), "required_columns", "missing=['doctor_id', 'hospital_id']"),
    "renamed_optional": (HEAD.replace("length_of_stay", "los"), lines(), "data_types", "column missing"),
    "header_only": (HEAD, [], "row_count", "rows=0"),
    "all_ragged": (HEAD, [x + ",z" for x in lines()], "row_count", "rows=0"),
    "nulls_over": (HEAD, lines({"doctor_id": ""}, {"doctor_id": "NULL"}), "null_percentage",
                   "admission_id=0.0%, patient_id=0.0%, doctor_id=10.0%, hospital_id=0.0%"),
    "nulls_at_limit": (HEAD, lines({"doctor_id": ""}), None, None),
    "non_numeric": (HEAD, lines({"length_of_stay": "abc"}), "data_types", "non-numeric rows=1"),
    "blank_numeric": (HEAD, lines({"length_of_stay": ""}), "data_types", "non-numeric rows=1"),
    "duplicate_key": (HEAD, lines({}, {"admission_id": 0}, {"admission_id": 0}), "pk_uniqueness", "duplicate ids=1"),
    "bad_category": (HEAD, lines({"admission_type": "emg"}), "valid_admission_type", "invalid values=1"),
    "null_category": (HEAD, lines({"admission_type": ""}), None, None),
    "out_of_range_date": (HEAD, lines({"admit_date": "2019-12-31"}), "date_range", "out-of-range dates=1"),
    "unparseable_date": (HEAD, lines({"admit_date": "soon"}), None, None),
    "quoted_comma": (HEAD, lines({"department": '"ER, west"'}), None, None),
    "line_end_in_a_cell": (HEAD, lines({"department": '"ER\nwest"'}, {"department": '"a ""b"""'}), None, None),
    "stray_quote": (HEAD, lines({"department": 'five" ER'}), None, None),
    "odd [name] {of} a file*": (HEAD, lines(), None, None),
    "shouting_header": (" " + HEAD.upper(), lines(), None, None),
}


def test_one_defect_each(spark, folder):
    for name, (header, rows, _, _) in CASES.items():
        file(folder, f"patient_admissions_{name}.csv", header, rows)
    (folder / "patient_admissions_empty.csv").write_text("")
    file(folder, "lab_results.csv", HEAD, lines())
    file(folder, "patient_admissions_upper.CSV", HEAD, lines())
    got, status = gate(spark, folder)
    assert "lab_results.csv" not in got and "patient_admissions_upper.CSV" not in got
    empty = got["patient_admissions_empty.csv"]
    assert empty["file_not_empty"] == (False, "size=0 bytes") and len(empty) == 3
    for name, (_, rows, failing, detail) in CASES.items():
        checks = got[f"patient_admissions_{name}.csv"]
        bad = {k for k, (ok, _) in checks.items() if not ok}
        verdict = status[f"patient_admissions_{name}.csv"]
        if failing is None:
            assert (bad, verdict, len(checks)) == (set(), "PASSED", 10), name
            continue
        assert failing in bad and checks[failing][1] == detail, (name, checks)
        assert verdict == ("PASSED" if failing == "date_range" else "QUARANTINED"), name
        if failing in c.GATE_CHECKS:
            assert len(checks) == 3, name


def test_duplicate_rows_count_every_copy(spark, folder):
    file(folder, "patient_admissions_d.csv", HEAD, lines() + [adm(1), adm(1), adm(2), adm(3, department="X")])
    got, _ = gate(spark, folder)
    assert got["patient_admissions_d.csv"]["duplicate_rows"] == (False, "dup rows=5")
    assert got["patient_admissions_d.csv"]["pk_uniqueness"] == (False, "duplicate ids=3")


def test_rows_without_key_group_together(spark, folder):
    file(folder, "patient_admissions_k.csv", HEAD, lines(n=60) + [adm(1, admission_id="", patient_id=1), adm(2, admission_id="", patient_id=2)])
    got, _ = gate(spark, folder)
    assert got["patient_admissions_k.csv"]["pk_uniqueness"] == (False, "duplicate ids=1")


def test_blank_amounts_can_be_allowed(spark, folder):
    head = ",".join(CLAIMS.columns)
    rows = [f"{i},{i},I01,10.00,,P,2024-01-01," for i in range(5)]
    file(folder, "insurance_claims_p.csv", head, rows)
    assert gate(spark, folder)[1] == {"insurance_claims_p.csv": "QUARANTINED"}
    assert gate(spark, folder, GateLimits(null_is_bad=False))[1] == {"insurance_claims_p.csv": "PASSED"}


def test_ragged_rows_are_skipped_and_counted(spark, folder):
    file(folder, "patient_admissions_r.csv", HEAD, lines() + [adm(50) + ",extra", "1,2", "", adm(51, department='"open')])
    _, staged = files.read_files(files.read_lines(spark, str(folder)))
    counts = files.ragged_counts(staged).first()
    assert (counts["kept"], counts["ragged"]) == (20, 3)  # the empty line is no record
    assert files.lenient_load(staged).count() == 20
    stores = ingest.Stores(scratch_path(spark, "stores"))
    run = ingest.run_gate(spark, str(folder), stores, "r1", AT)
    assert (run.rows_loaded, run.files_quarantined) == (0, 1)
    entry = spark.read.parquet(stores.log("file_processing_log")).first()
    assert (entry["status"], entry["failed_checks"]) == (c.LOAD_FAILED, "    - load_ragged_rows [LOAD]: bad rows=3")
    assert entry["checks_failed"] == 1 and spark.read.parquet(stores.log("dq_metrics_log")).filter("check_tier = 'LOAD'").count() == 1


def test_line_ends_inside_cells_load(spark, folder):
    file(folder, "patient_admissions_n.csv", HEAD, lines({"department": '"one\n""two"", 2"'}))
    stores = ingest.Stores(scratch_path(spark, "stores"))
    assert ingest.run_gate(spark, str(folder), stores, "r1", AT).rows_loaded == 20
    got = {r["department"] for r in bronze.read_landing(spark, stores.landing("patient_admissions"), ADMISSIONS).collect()}
    assert got == {"ER", 'one\n"two", 2'}


def test_header_of_a_file_read_in_many_blocks(spark, folder):
    rows = [adm(i, department=f"DEP{i}") for i in range(20000)]
    file(folder, "patient_admissions_big.csv", HEAD, rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        raw = files.read_lines(spark, str(folder))
        assert raw.rdd.getNumPartitions() > 4
        headers, staged = files.read_files(raw)
        assert headers.first()["header"] == ADMISSIONS.columns
        assert staged.count() == 20000 and not staged.filter("ragged").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_reordered_columns_load_by_name(spark, folder):
    names = list(reversed(TREATMENTS.columns))
    file(folder, "treatment_records_x.csv", ",".join(names), ["S,12.50,2024-01-02,P1,D001,7,1"])
    stores = ingest.Stores(scratch_path(spark, "stores"))
    run = ingest.run_gate(spark, str(folder), stores, "r1", AT)
    row = bronze.read_landing(spark, stores.landing("treatment_records"), TREATMENTS).first()
    assert run.rows_loaded == 1 and (row["treatment_id"], row["admission_id"], row["outcome"]) == (1, 7, "S")
    assert str(row["cost"]) == "12.50" and row["load_dttm"] == AT


def test_run_moves_files_logs_and_reports(spark, folder):
    file(folder, "patient_admissions_ok.csv", HEAD, lines())
    file(folder, "patient_admissions_bad.csv", HEAD, lines({"length_of_stay": "x"}))
    stores = ingest.Stores(scratch_path(spark, "stores"))
    run = ingest.run_gate(spark, str(folder), stores, "r1", AT)
    assert (run.files_seen, run.rows_loaded, run.files_quarantined, run.any_quarantined) == (2, 20, 1, True)
    assert list(folder.iterdir()) == [] or all(p.name.endswith(".crc") for p in folder.iterdir())
    moved = spark.read.text(f"{stores.files}/quarantine/20260629_130245/patient_admissions_bad.csv")
    assert moved.count() == 21
    log = {r["file_name"]: r for r in spark.read.parquet(stores.log("file_processing_log")).collect()}
    bad = log["patient_admissions_bad.csv"]
    assert bad["rows_loaded"] == 0 and bad["failed_checks"] == "    - data_types [THRESHOLD]: non-numeric rows=1"
    assert log["patient_admissions_ok.csv"]["rows_loaded"] == 20
    assert spark.read.parquet(stores.log("dq_metrics_log")).count() == 20
    again = ingest.run_gate(spark, str(folder), stores, "r2", AT)
    assert again.files_seen == 0


def test_repeated_batch_does_not_double(spark, folder):
    file(folder, "patient_admissions_ok.csv", HEAD, lines())
    stores = ingest.Stores(scratch_path(spark, "stores"))
    for _ in range(2):
        ingest.run_gate(spark, str(folder), stores, "same", AT, move=False)
    assert bronze.read_landing(spark, stores.landing("patient_admissions"), ADMISSIONS).count() == 20
    assert spark.read.parquet(stores.log("file_processing_log")).count() == 1


def test_a_file_that_cannot_be_typed_fails_by_itself(spark, folder):
    file(folder, "patient_admissions_a.csv", HEAD, lines({"patient_id": "p1"}, {"department": "D" * 21}))
    file(folder, "patient_admissions_b.csv", HEAD, lines())
    file(folder, "insurance_claims_ok.csv", ",".join(CLAIMS.columns), ["1,1,I01,5,5,A,2024-01-01,"])
    stores = ingest.Stores(scratch_path(spark, "stores"))
    run = ingest.run_gate(spark, str(folder), stores, "r1", AT)
    assert (run.rows_loaded, run.files_quarantined) == (21, 1)
    log = {r["file_name"]: r for r in spark.read.parquet(stores.log("file_processing_log")).collect()}
    failed = log["patient_admissions_a.csv"]
    assert failed["status"] == c.LOAD_FAILED and failed["rows_loaded"] == 0
    assert failed["failed_checks"].split("\n") == ["    - load_department [LOAD]: bad rows=1", "    - load_patient_id [LOAD]: bad rows=1"]
    landed = bronze.read_landing(spark, stores.landing("patient_admissions"), ADMISSIONS)
    assert {r[0] for r in landed.select("file_name").distinct().collect()} == {"patient_admissions_b.csv"}
    assert spark.read.text(f"{stores.files}/quarantine/20260629_130245/patient_admissions_a.csv").count() == 21


def test_strict_load_names_all_faults(spark, folder):
    file(folder, "patient_admissions_a.csv", HEAD, lines({"patient_id": "p1"}, {"department": "D" * 21}))
    headers, staged = files.read_files(files.read_lines(spark, str(folder)))
    with pytest.raises(bronze.StrictLoadError, match="bad department.*bad patient_id|bad patient_id.*bad department"):
        bronze.strict_load(files.named_cells(staged, headers, ADMISSIONS), ADMISSIONS)


def test_a_repeated_run_takes_the_files_and_the_stamp_of_its_first_try(spark, folder, monkeypatch):
    file(folder, "patient_admissions_ok.csv", HEAD, lines())
    stores = ingest.Stores(scratch_path(spark, "stores"))
    append = bronze.append_with_count

    def stops(rows, path, batch_id):
        append(rows, path, batch_id)
        raise InterruptedError

    monkeypatch.setattr(bronze, "append_with_count", stops)
    with pytest.raises(InterruptedError):
        ingest.run_gate(spark, str(folder), stores, "r1", AT)
    monkeypatch.undo()
    file(folder, "patient_admissions_late.csv", HEAD, lines())  # arrives before the run is repeated
    run = ingest.run_gate(spark, str(folder), stores, "r1", AT + dt.timedelta(hours=1))
    assert (run.files_seen, run.rows_loaded) == (1, 20)
    assert bronze.read_landing(spark, stores.landing("patient_admissions"), ADMISSIONS).select("load_dttm").distinct().first()[0] == AT
    assert {p.name for p in folder.iterdir() if not p.name.endswith(".crc")} == {"patient_admissions_late.csv"}
    again = ingest.run_gate(spark, str(folder), stores, "r1", AT)  # moved files are not missed
    assert (again.files_seen, again.rows_loaded) == (1, 20)
    assert bronze.read_landing(spark, stores.landing("patient_admissions"), ADMISSIONS).count() == 20


def test_preflight(spark, folder):
    file(folder, "patient_admissions_ok.csv", HEAD, lines(n=1))
    file(folder, "patient_admissions_order.CSV", ",".join(reversed(ADMISSIONS.columns)), lines(n=1))
    file(folder, "patient_admissions_diff.csv", HEAD.replace("department", "dept"), lines(n=1))
    file(folder, "other.csv", HEAD, lines(n=1))
    got = {r["file_name"]: (r["verdict"], r["missing"], r["extra"]) for r in ingest.preflight(spark, str(folder)).collect()}
    assert got == {
        "patient_admissions_ok.csv": ("OK", "", ""),
        "patient_admissions_order.CSV": ("WARN", "", ""),
        "patient_admissions_diff.csv": ("WARN", "department", "dept"),
        "other.csv": ("SKIP", None, None),
    }


def test_cells(spark, folder):
    file(folder, "patient_admissions_c.csv", "a,b,c,d,e", ['a, "x,y" , NULL,,"q""z"', "1", ",b,,,", ' "a" ,b,c,d,e'])
    _, staged = files.read_files(files.read_lines(spark, str(folder)))
    got = [r["cells"] for r in staged.filter("not ragged").collect()]
    assert sorted(got, key=str) == sorted([["a", "x,y", None, None, 'q"z'], [None, "b", None, None, None], ["a", "b", "c", "d", "e"]], key=str)
    assert staged.filter("ragged").count() == 1


@pytest.fixture()
def few_orders(spark, tmp_path):
    """A folder of its own with orders of 1995, 1998, 2000 (repeated rows) and a missing day."""
    rows = [
        (k, k % 5, "FOP"[k % 3], 10.5 + k, None if k == 30 else dt.datetime((1995, 1998, 2000)[k % 3], 1 + k % 12, 7), "1-URGENT")
        for k in range(1, 41)
    ]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


@pytest.fixture()
def purposes(monkeypatch):
    """What ``sources.files`` writes, in order."""
    seen, real = [], files.written
    monkeypatch.setattr(files, "written", lambda df, purpose, *by: seen.append(purpose) or real(df, purpose, *by))
    return seen


def test_files_hold_the_derived_lines_without_a_table_of_them(spark, few_orders):
    place = gate_files.incoming(spark, few_orders)
    assert not any(sf == few_orders for _, sf in gate_files._tables)
    want = {}
    for r in gate_files.derived_lines(spark, few_orders).orderBy("file_name", "line_no").collect():
        want.setdefault(r["file_name"], []).append(r["line"])
    found = {f.name: f.read_text().splitlines() for f in Path(place.removeprefix("file:")).iterdir() if f.suffix == ".csv"}
    assert found == want | {"insurance_claims_1998_0.csv": []}


def test_header_checks_leave_the_rows_in_the_files(spark, few_orders, purposes):
    checked = q_gate.QUERIES["chk_required_columns"](spark, few_orders).collect()
    assert len(checked) == len(set(r["file_name"] for r in checked)) > 0
    assert "staged" not in purposes


def test_a_run_summary_reads_the_files_once(spark, few_orders, purposes):
    summary = q_gate.QUERIES["gate_run_summary"](spark, few_orders).first()
    assert summary["files_seen"] > 0 and purposes == ["heads", "headers", "staged"]


def test_heads_and_staged_rows_are_not_sorted(spark, few_orders, monkeypatch):
    lines = files.read_lines(spark, gate_files.incoming(spark, few_orders))
    heads = files.file_heads(lines)
    plan = heads._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan
    partitioned = []
    monkeypatch.setattr(files, "written", lambda df, purpose, *by: partitioned.extend(by) or written(df, purpose, *by))
    _, staged = files.read_files(lines)
    assert not partitioned and staged.filter("feed <> file_name and not startswith(file_name, feed)").isEmpty()

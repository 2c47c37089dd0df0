"""Files to tested star schema, in batch and as a stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_gate import HEAD, adm
from test_state import same_rows

from wardline.feeds import CLAIMS, FEEDS, TREATMENTS
from wardline.operators import checks as c
from wardline.plans import gold, ingest, silver
from wardline.plans.pipeline import Pipeline
from wardline.session import scratch_path
from wardline.sinks.store import TableStore
from wardline.sinks import bronze
from wardline.streaming import ingest as stream

AT = dt.datetime(2026, 6, 29, 13, 0, 0)
AS_OF = dt.date(2026, 1, 1)


def drop(folder, batch, n=30):
    """Three good files and a bad one."""
    lo = batch * 20  # the last third of a batch comes again in the next one
    (folder / f"patient_admissions_{batch}.csv").write_text(
        "\n".join([HEAD, *[adm(i, patient_id=i % 5, admit_date=f"2024-0{1 + (i + batch) % 8}-1{i % 10}") for i in range(lo, lo + n)]]) + "\n")
    (folder / f"treatment_records_{batch}.csv").write_text(
        "\n".join([",".join(TREATMENTS.columns), *[f"{i},{i % 7},D00{i % 3},p{i % 4},2024-02-1{i % 10},{i * 13 % 50 + batch}.25,{'SPF'[i % 3]}" for i in range(lo, lo + n)]]) + "\n")
    (folder / f"insurance_claims_{batch}.csv").write_text(
        "\n".join([",".join(CLAIMS.columns), *[f"{i},{i},I0{i % 3},{100 + i}.00,{50 + batch}.00,{'APR'[i % 3]},2024-03-01,2024-03-{10 + batch}" for i in range(lo, lo + n)]]) + "\n")
    (folder / f"insurance_claims_bad_{batch}.csv").write_text("claim_id\n1\n")


@pytest.fixture()
def setup(spark, tmp_path):
    incoming, seeds = tmp_path / "incoming", tmp_path / "seeds"
    incoming.mkdir(), seeds.mkdir()
    (seeds / "seed_doctors.csv").write_text("doctor_id,doctor_name,specialty,years_experience\nD001,Ann,Cardiology,21\nD002,Bo,Oncology,0\n")
    (seeds / "seed_hospitals.csv").write_text("hospital_id,hospital_name,city\nH01,North,Aville\n")
    (seeds / "seed_insurers.csv").write_text("insurance_id,insurer_name\nI00,Zero\nI01,One\nI02,Two\n")
    return incoming, seeds, ingest.Stores(scratch_path(spark, "stores"))


def test_two_cycles_equal_a_rebuild(spark, setup):
    incoming, seeds, stores = setup
    p = Pipeline(spark, stores, str(seeds))
    for batch in (0, 1):
        at = AT + dt.timedelta(minutes=10 * batch)
        drop(incoming, batch)
        run = ingest.run_gate(spark, str(incoming), stores, f"r{batch}", at)
        assert (run.files_seen, run.files_quarantined, run.rows_loaded) == (4, 1, 90)
        if batch:
            (seeds / "seed_doctors.csv").write_text(
                "doctor_id,doctor_name,specialty,years_experience\nD001,Ann,Radiology,21\nD002,Bo,Oncology,0\n")
        p.build(at, AS_OF)
    landed = {f: bronze.read_landing(spark, stores.landing(f), FEEDS[f]) for f in FEEDS}
    today = F.lit(AS_OF)
    stg = silver.stg_admissions(landed["patient_admissions"], today)
    assert same_rows(p.table("stg_admissions"), stg)
    assert same_rows(p.table("fct_admissions"), gold.fct_admissions(stg))
    assert same_rows(p.table("stg_treatments"), silver.stg_treatments(landed["treatment_records"]))
    assert same_rows(p.table("fct_claims"), gold.fct_claims(silver.stg_claims(landed["insurance_claims"])))

    history = {(r["doctor_id"], r["specialty"], r["is_current"]) for r in p.table("dim_doctor_history").collect()}
    assert history == {("D001", "Cardiology", False), ("D001", "Radiology", True), ("D002", "Oncology", True)}
    rich = p.table("fct_admissions_enriched")
    assert rich.count() == 50 and rich.filter("specialty_changed_since").count() == 50  # all admitted before the change
    tests = {r["test"]: r["failures"] for r in p.test().collect()}
    assert len(tests) == 41
    assert {t for t, n in tests.items() if n} == {"relationships_fct_treatments_doctor_sk"}  # D000 is no known doctor
    assert all(r["cleaned_difference"] == 0 == r["fact_difference"] for r in p.reconcile().collect())
    assert p.check_keys().count() == 13

    before = p.table("dim_doctor_history").collect()
    p.build(AT + dt.timedelta(minutes=10), AS_OF)  # the same run again
    assert sorted(before) == sorted(p.table("dim_doctor_history").collect())
    p.build(AT + dt.timedelta(minutes=30), AS_OF, full=True)
    assert same_rows(p.table("stg_admissions"), stg)


def test_stream_loads_each_file_once_and_keeps_silver_current(spark, setup):
    incoming, _, stores = setup
    runs = []
    clock = lambda: AT + dt.timedelta(minutes=len(runs))

    def start():
        stream.gate_stream(
            spark, str(incoming), stores, f"{stores.root}/checkpoint", clock=clock,
            after=stream.silver_upsert(spark, stores, AS_OF.isoformat()), on_run=runs.append,
        ).awaitTermination()

    drop(incoming, 0)
    (incoming / "patient_admissions_empty.csv").write_text("")
    start()
    start()
    assert [r.files_seen for r in runs] == [5]
    drop(incoming, 1)
    start()
    assert [r.rows_loaded for r in runs] == [90, 90] and [r.files_quarantined for r in runs] == [2, 1]
    landed = {f: bronze.read_landing(spark, stores.landing(f), FEEDS[f]) for f in FEEDS}
    read = TableStore(spark, stores.root).table
    assert same_rows(read("stg_admissions"), silver.stg_admissions(landed["patient_admissions"], F.lit(AS_OF)))
    assert same_rows(read("stg_treatments"), silver.stg_treatments(landed["treatment_records"]))
    assert same_rows(read("stg_claims"), silver.stg_claims(landed["insurance_claims"]))
    # a batch whose commit was lost runs again and changes nothing
    before = read("stg_treatments").collect()
    assert all(r.run_id.startswith("batch-") and r.run_id.count("-") == 2 for r in runs)
    stream.silver_upsert(spark, stores, AS_OF.isoformat())(runs[1].run_id, AT)
    assert sorted(map(str, before)) == sorted(map(str, read("stg_treatments").collect()))
    log = spark.read.parquet(stores.log("file_processing_log"))
    assert log.filter(F.col("status") == c.QUARANTINED).count() == 3
    assert spark.read.text(stores.files).filter("folder = 'quarantine'").count() == 4


def test_default_calendar(spark):
    from wardline.sources.spine import date_spine

    d = gold.dim_date(date_spine(spark))
    span = d.agg(F.min("date_day"), F.max("date_day"), F.count("*")).first()
    assert tuple(span) == (dt.date(2023, 1, 1), dt.date(2025, 12, 30), 1095)
    first = d.filter("date_day = date'2023-01-01'").first()
    assert (first["day_of_week"], first["day_name"], first["is_weekend"], first["month_name"]) == (0, "Sun", True, "Jan")


def test_status_where_stay_or_date_is_missing(spark):
    from wardline.functions import rules

    df = spark.createDataFrame([(None, None, None, "D1", "H1"), (-5, 3, "2024-01-01", "D1", "H1")],
                               "gap int, stay int, day string, doc string, hos string")
    day, as_of = F.col("day").cast("date"), F.lit("2025-01-01").cast("date")
    got = df.select(
        rules.admission_status(F.col("gap"), F.col("stay"), day, F.col("doc"), F.col("hos"), as_of).alias("s"),
        rules.admission_is_valid(F.col("stay"), day, F.col("doc"), F.col("hos"), as_of).alias("v"),
    ).collect()
    assert [tuple(r) for r in got] == [("VALID", False), ("OVERLAPPING_ADMISSION", True)]


def test_dates(spark):
    from wardline.functions.dates import parse_date

    texts = ["2024-02-29", "29/02/2024", "2023-02-29", "1/2/2024", "2024-2-1", "2024-01-01 ", "n/a", None, "2024/01/01", "99/99/2024"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_date(F.col("t"))).collect()]
    assert got == [dt.date(2024, 2, 29)] * 2 + [None] * 8


def test_plans_hold_no_nested_loops(spark, sf):
    """Equi joins only, and no Python stages, in the models."""
    import __spark_entry__ as e

    for name in ("stg_admissions", "stg_treatments", "fct_admissions_enriched", "gate_all_checks", "incr_admissions", "scd2_snapshot_check"):
        plan = e.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan, name

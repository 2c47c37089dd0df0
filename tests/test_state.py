"""Incremental steps, upserts and history."""

import random

import pytest
from pyspark.sql import functions as F

from wardline.feeds import ADMISSIONS, TREATMENTS
from wardline.operators import incremental as inc
from wardline.operators import scd2
from wardline.plans import gold, silver
from wardline.registry.adapters import ntz
from wardline.session import scratch_path, written
from wardline.sinks import tables as t

AS_OF = "2025-01-01"


def same_rows(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    a, b = a.select(cols), b.select(cols)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def landed_admissions(spark, batches, seed):
    """Admissions that move between patients, repeat and miss fields, over several loads."""
    r = random.Random(seed)
    rows = []
    for b in range(batches):
        for _ in range(60):
            i = r.randrange(80)
            patient = r.choice([1, 2, 3, None, r.randrange(20)])
            day = r.choice(["bad", f"{r.randrange(1, 29):02d}/0{r.randrange(1, 9)}/2024", f"2024-0{r.randrange(1, 9)}-{r.randrange(10, 29)}"])
            rows.append((i, patient, r.choice([" d1", "D2", None]), "H01", day, "er", r.choice(["EMG", "x"]), "a",
                         r.choice([-1, 2, 30, 400, None]), 1, f"f{b}.csv", b, b))
    names = ADMISSIONS.landing_schema.names
    df = spark.createDataFrame(rows, "admission_id long, patient_id long, doctor_id string, hospital_id string, admit_date string, "
                               "department string, admission_type string, diagnosis_code string, length_of_stay int, readmission_flag int, "
                               "file_name string, upload_dttm int, load_dttm int")
    for c in ("upload_dttm", "load_dttm"):
        df = df.withColumn(c, F.timestamp_seconds(F.col(c) * 86400).cast("timestamp_ntz"))
    return written(df.select(*names), "landed")


def as_of():
    return F.lit(AS_OF).cast("date")


@pytest.mark.parametrize("seed", [1, 2])
def test_admissions_step_by_step_equals_rebuild(spark, seed):
    landed = landed_admissions(spark, 3, seed)
    at = lambda b: F.timestamp_seconds(F.lit(b * 86400)).cast("timestamp_ntz")
    target = written(silver.stg_admissions(landed.filter(F.col("load_dttm") <= at(0)), as_of()), "target")
    for b in (1, 2):
        seen = landed.filter(F.col("load_dttm") <= at(b))
        target = written(inc.incr_admissions(target, seen, as_of()), "target")
        assert same_rows(target, silver.stg_admissions(seen, as_of()))
    nothing = written(inc.incr_admissions(target, landed, as_of()), "target")
    assert same_rows(nothing, target)


def test_admissions_step_with_large_groups_equals_rebuild(spark):
    landed = landed_admissions(spark, 2, 5)
    first = landed.filter(F.col("load_dttm") <= F.timestamp_seconds(F.lit(0)).cast("timestamp_ntz"))
    target = written(silver.stg_admissions(first, as_of(), samples=2), "target")
    assert same_rows(target, silver.stg_admissions(first, as_of()))
    fresh = inc.watermark_filter(landed, target)
    out = t.merge_upsert(target, written(inc.rewritten_admissions(target, fresh, as_of(), samples=2), "u"), "admission_id")
    assert same_rows(out, silver.stg_admissions(landed, as_of()))


def landed_treatments(spark, seed):
    r = random.Random(seed)
    rows = []
    for b in range(2):
        for _ in range(150 if b == 0 else 12):
            rows.append((r.randrange(200), r.randrange(40), "D1", r.choice([" p1", "P2 ", "p3", None, f"q{r.randrange(30)}"]),
                         r.choice(["bad", f"2024-01-{r.randrange(10, 29)}"]), f"{r.randrange(-500, 90000) / 100:.2f}",
                         r.choice(["S", "p", "?"]), f"f{b}", b, b))
    df = spark.createDataFrame(rows, "treatment_id long, admission_id long, doctor_id string, procedure_code string, treatment_date string, "
                               "cost string, outcome string, file_name string, upload_dttm int, load_dttm int")
    df = df.withColumn("cost", F.col("cost").cast("decimal(12,2)"))
    for c in ("upload_dttm", "load_dttm"):
        df = df.withColumn(c, F.timestamp_seconds(F.col(c) * 86400).cast("timestamp_ntz"))
    return written(df.select(*TREATMENTS.landing_schema.names), "landed")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_treatments_step_equals_rebuild(spark, seed):
    landed = landed_treatments(spark, seed)
    target = written(silver.stg_treatments(landed.filter("file_name = 'f0'")), "target")
    rows = written(inc.rewritten_treatments(target, inc.watermark_filter(landed, target)), "rows")
    full = written(silver.stg_treatments(landed), "full")
    assert same_rows(t.merge_upsert(target, rows, "treatment_id"), full)
    assert rows.count() < full.count()  # untouched groups are left alone
    assert same_rows(silver.stg_treatments(landed, samples=1), full)


def test_treatments_table_meets_the_rewritten_keys_once(spark):
    """Procedures and admissions without a new row stay as stored; the marking pass alone tells them apart."""
    rows = [(i, i % 40, "D1", f"P{i % 8}", "2024-01-02", f"{i}.50", "S", "f0", 0, 0) for i in range(400)]
    rows += [(i, 1000 + i, "D2", "P3", "2024-02-02", "7.25", "F", "f1", 1, 1) for i in (3, 5, 900, 901)]
    names = TREATMENTS.landing_schema.names
    df = spark.createDataFrame(rows, "treatment_id long, admission_id long, doctor_id string, procedure_code string, treatment_date string, "
                               "cost string, outcome string, file_name string, upload_dttm int, load_dttm int")
    stamp = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz").alias(c)
    landed = written(df.withColumn("cost", F.col("cost").cast("decimal(12,2)")).select(*names[:-2], *map(stamp, names[-2:])), "landed")
    target = written(silver.stg_treatments(landed.filter("file_name = 'f0'")), "target")
    done = inc.incr_treatments(target, landed)
    assert same_rows(done, silver.stg_treatments(landed))
    stays = F.col("procedure_code").isin("P1", "P2") & ~F.col("admission_id").isin(3, 5)
    assert same_rows(done.filter(stays), target.filter(stays))
    assert "LeftAnti" not in done._jdf.queryExecution().optimizedPlan().toString()


def test_fact_follows_neighbours_that_changed(spark):
    landed = landed_admissions(spark, 2, 9)
    old = written(silver.stg_admissions(landed.filter("file_name = 'f0.csv'"), as_of()), "old")
    new = written(silver.stg_admissions(landed, as_of()), "new")
    fact = written(gold.fct_admissions(old), "fact")
    changed = written(inc.incr_facts(fact, new, gold.fct_admissions, "admission_id"), "changed")
    assert same_rows(t.merge_upsert(fact, changed, "admission_id"), gold.fct_admissions(new))
    by_stamp = inc.incr_facts(fact, new, gold.fct_admissions, "admission_id", by_watermark=True)
    assert by_stamp.count() < changed.count()  # the stamp alone misses rows changed by a neighbour
    assert inc.incr_facts(gold.fct_admissions(new), new, gold.fct_admissions, "admission_id").isEmpty()


def test_watermark_of_an_empty_table_lets_all_rows_in(spark):
    landed = landed_admissions(spark, 1, 3)
    assert inc.watermark_filter(landed, landed.limit(0)).count() == landed.count()


def test_watermark_reaches_the_scan(spark, capsys):
    landed = landed_admissions(spark, 2, 3)
    inc.watermark_filter(landed, landed).explain("formatted")
    pushed = [x for x in capsys.readouterr().out.splitlines() if "PushedFilters" in x]
    assert any("GreaterThan(load_dttm,ScalarSubquery" in x for x in pushed)


def test_schema_sync(spark):
    old = spark.createDataFrame([(1, "a", "gone"), (2, "b", "gone")], "k int, v string, retired string")
    new = spark.createDataFrame([(2, "B", 5)], "k int, v string, added int")
    assert {tuple(r) for r in t.schema_sync_upsert(old, new, "k").collect()} == {(1, "a", None), (2, "B", 5)}


# ── history ─────────────────────────────────────────────────────────────────────────────────────

CHECK = ("specialty",)


def people(spark, **who):
    return spark.createDataFrame([(k, k.upper(), v) for k, v in who.items()] or [], "id string, name string, specialty string")


def test_history_of_changes_deletes_and_returns(spark):
    ts = [ntz(f"2024-01-0{i} 00:00:00") for i in range(1, 6)]
    h = scd2.first_snapshot(people(spark, a="x", b="x", c="x"), "id", ts[0])
    step = lambda h, at, **who: written(scd2.next_snapshot(h, people(spark, **who), "id", CHECK, at), "h")
    h = step(h, ts[1], a="x", b="y")  # b changes, c goes
    again = step(h, ts[2], a="x", b="y")
    assert same_rows(h, again)
    h = step(again, ts[3], a=None, b="y", c="x", d="n")  # a to NULL, c returns, d new
    rows = {(r["id"], r["specialty"], str(r["valid_from"])[8:10], str(r["valid_to"])[8:10] if r["valid_to"] else None) for r in h.collect()}
    assert rows == {
        ("a", "x", "01", "04"), ("a", None, "04", None),
        ("b", "x", "01", "02"), ("b", "y", "02", None),
        ("c", "x", "01", "02"), ("c", "x", "04", None),
        ("d", "n", "04", None),
    }
    assert scd2.overlapping_versions(h, "id").isEmpty()
    assert h.filter("valid_to is null").groupBy("id").count().filter("count > 1").isEmpty()
    kept = scd2.next_snapshot(h, people(spark, a=None), "id", CHECK, ts[4], hard_deletes=False)
    assert kept.filter("valid_to is null").count() == 4


def test_name_change_alone_is_ignored(spark):
    h = scd2.first_snapshot(people(spark, a="x"), "id", ntz("2024-01-01 00:00:00"))
    renamed = people(spark, a="x").withColumn("name", F.lit("other"))
    assert same_rows(scd2.next_snapshot(h, renamed, "id", CHECK, ntz("2024-02-01 00:00:00")), h)


def test_first_run_into_an_empty_history(spark):
    src, at = people(spark, a="x", b="y"), ntz("2024-01-01 00:00:00")
    assert same_rows(scd2.next_snapshot(scd2.empty_history(src), src, "id", CHECK, at), scd2.first_snapshot(src, "id", at))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_histories_never_overlap(spark, seed):
    r = random.Random(seed)
    h = scd2.empty_history(people(spark, a="x"))
    live = {}
    for day in range(1, 6):
        live = {k: r.choice("xyz") for k in "abcdefg" if r.random() < 0.7}
        h = written(scd2.next_snapshot(h, people(spark, **live), "id", CHECK, ntz(f"2024-03-0{day} 00:00:00")), "h")
    assert scd2.overlapping_versions(h, "id").isEmpty()
    assert {(x["id"], x["specialty"]) for x in h.filter("valid_to is null").collect()} == set(live.items())


def test_ten_thousand_doctors_keep_their_ids(spark, tmp_path):
    from wardline.registry import adapters

    path = str(tmp_path / "supplier.parquet")
    spark.range(1, 10_001).select(
        F.col("id").alias("s_suppkey"), F.format_string("name %d", "id").alias("s_name"),
        (F.col("id") % 25).cast("int").alias("s_nationkey"), F.lit("x").alias("s_address"), F.lit("1").alias("s_phone"),
        F.lit(1.0).alias("s_acctbal"), F.lit("c").alias("s_comment"),
    ).write.parquet(path)
    ids = spark.read.parquet(path).select(
        F.concat(F.lit("D"), adapters._padded(F.col("s_suppkey"), 3)).alias("doctor_id"), "s_name"
    )
    assert ids.select("doctor_id").distinct().count() == 10_000
    assert ids.filter("doctor_id in ('D007', 'D10000')").count() == 2
    first = scd2.first_snapshot(ids, "doctor_id", ntz("2024-01-01 00:00:00"))
    again = scd2.next_snapshot(first, ids, "doctor_id", ["s_name"], ntz("2024-02-01 00:00:00"))
    assert again.count() == 10_000


def test_tasks_without_lines_get_the_generic_text(spark):
    from wardline.operators import lognotes

    lines = spark.createDataFrame([("a", 1, "Failure in test x")], "task_id string, line_no long, line string")
    tasks = spark.createDataFrame([("a",), ("b",)], "task_id string")
    got = {r["task_id"]: r["root_cause"] for r in lognotes.root_causes(lines, "task_id", tasks=tasks).collect()}
    assert got["a"] == "Test failed: x"
    assert got["b"] == lognotes.GENERIC_OTHER

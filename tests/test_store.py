"""Stored tables: published as one, repeatable after any stop, following columns."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_pipeline import AS_OF, AT, drop, setup  # noqa: F401  (a fixture)
from test_state import landed_admissions, same_rows

from wardline.feeds import ADMISSIONS, FEEDS
from wardline.operators import incremental as inc
from wardline.plans import gold, ingest, pipeline, silver
from wardline.plans.pipeline import Pipeline
from wardline.session import scratch_path, written
from wardline.sinks import bronze
from wardline.sinks.store import PublishConflict, TableStore, Transaction


@pytest.fixture()
def store(spark):
    return TableStore(spark, scratch_path(spark, "store"))


def rows(spark, lo, hi, v):
    return spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).alias("v"))


def published(store, change):
    tx = store.begin()
    change(tx)
    return tx.publish()


def versions(store):
    return {r["key_range"]: r["version"] for r in store.ranges("t", store.current().tables["t"].ranges).collect()}


def values(store, at=None):
    return {r["k"]: r["v"] for r in store.table("t", at=at).collect()}


def test_upsert_rewrites_only_touched_ranges(spark, store):
    published(store, lambda tx: tx.replace("t", rows(spark, 0, 100, "old"), "k", width=10))
    first = store.current()
    before = versions(store)
    batch = written(rows(spark, 35, 38, "new").unionByName(rows(spark, 100, 103, "new")), "batch")
    for _ in range(2):  # repeating it changes nothing
        published(store, lambda tx: tx.upsert("t", batch))
    after = versions(store)
    assert {r for r in after if after[r] != before.get(r)} == {3, 10}
    got = values(store)
    assert len(got) == 103 and {k for k, v in got.items() if v == "new"} == {35, 36, 37, 100, 101, 102}
    assert set(values(store, first).values()) == {"old"}  # who still follows the first pointer sees the first state


def test_nothing_shows_before_it_is_published(spark, store):
    published(store, lambda tx: (tx.replace("t", rows(spark, 0, 20, "old"), "k", width=10), tx.replace("u", rows(spark, 0, 5, "old"))))
    reader = store.table("t")
    tx = store.begin()
    tx.upsert("t", written(rows(spark, 0, 20, "new"), "batch"))
    tx.replace("u", rows(spark, 0, 9, "new"))
    assert set(values(store).values()) == {"old"} and store.table("u").count() == 5
    assert tx.table("u").count() == 9
    tx.publish()
    assert set(values(store).values()) == {"new"} and store.table("u").count() == 9
    assert {r["v"] for r in reader.collect()} == {"old"}


def test_a_pointer_cut_short_does_not_count(spark, store):
    published(store, lambda tx: tx.replace("t", rows(spark, 0, 3, "old"), "k"))
    store.files.create(f"{store.root}/published/{2:012d}.json", '{"version": "0000')
    assert len(values(store)) == 3
    p = published(store, lambda tx: tx.upsert("t", written(rows(spark, 1, 5, "new"), "batch")))
    assert p.number == 3 and values(store) == {0: "old", 1: "new", 2: "new", 3: "new", 4: "new"}


def test_a_second_writer_is_noticed(spark, store):
    published(store, lambda tx: tx.replace("t", rows(spark, 0, 3, "old"), "k"))
    mine, other = store.begin(), store.begin()
    other.replace("t", rows(spark, 0, 3, "other"), "k")
    other.publish()
    mine.replace("t", rows(spark, 0, 3, "mine"), "k")
    with pytest.raises(PublishConflict):
        mine.publish()
    assert set(values(store).values()) == {"other"}


def test_columns_follow_the_rows(spark, store):
    old = rows(spark, 0, 30, "a").withColumn("gone", F.lit("x"))
    published(store, lambda tx: tx.replace("t", old, "k", width=10))
    before = versions(store)
    added = written(rows(spark, 25, 40, "b").withColumn("n", F.lit(1)), "batch")
    published(store, lambda tx: tx.upsert("t", added))
    t = store.table("t")
    assert t.columns == ["k", "v", "n"]
    assert {(r["v"], r["n"]) for r in t.collect()} == {("a", None), ("b", 1)} and t.count() == 40
    after = versions(store)
    assert {r for r in after if after[r] != before.get(r)} == {2, 3}
    # a column that comes back does not bring its old values with it
    published(store, lambda tx: tx.upsert("t", written(rows(spark, 39, 40, "c").withColumn("gone", F.lit("y")), "batch")))
    assert [(r["k"], r["gone"]) for r in store.table("t").filter("gone is not null").collect()] == [(39, "y")]
    # another type: every range is rewritten
    retyped = written(rows(spark, 0, 1, "d").withColumn("gone", F.lit("z")).withColumn("v", F.array("v")), "batch")
    published(store, lambda tx: tx.replace("t", store.table("t").withColumn("v", F.lit(7)), "k", width=10))
    widened = written(retyped.withColumn("v", F.lit(9).cast("long")), "batch")
    published(store, lambda tx: tx.upsert("t", widened))
    assert {(r["v"]) for r in store.table("t").collect()} == {7, 9} and dict(store.table("t").dtypes)["v"] == "bigint"


def test_null_and_negative_keys_and_empty_tables(spark, store):
    df = spark.createDataFrame([(None, "a"), (-5, "b"), (7, "c")], "k long, v string")
    published(store, lambda tx: (tx.replace("t", df, "k", width=10), tx.replace("none", df.limit(0), "k"), tx.replace("flat", df)))
    published(store, lambda tx: tx.upsert("t", written(spark.createDataFrame([(None, "A"), (-11, "d")], "k long, v string"), "b")))
    assert values(store) == {None: "A", -5: "b", 7: "c", -11: "d"}
    assert store.table("none").count() == 0 and store.table("none").columns == ["k", "v"] and store.table("flat").count() == 3
    published(store, lambda tx: tx.upsert("none", written(df, "b")))
    assert store.table("none").count() == 3


def test_reading_touched_ranges_prunes_folders(spark, store):
    published(store, lambda tx: tx.replace("t", rows(spark, 0, 100, "old"), "k", width=10))
    some = written(rows(spark, 41, 43, "x"), "some")
    t = store.table("t", touching=some)
    assert {r["k"] for r in t.collect()} == set(range(40, 50))
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_expired_versions_go_and_published_rows_stay(spark, store):
    published(store, lambda tx: tx.replace("t", rows(spark, 0, 30, "v0"), "k", width=10))
    for i in range(1, 5):
        published(store, lambda tx: tx.upsert("t", written(rows(spark, 0, 10, f"v{i}"), "b")))
    abandoned = store.begin()
    abandoned.upsert("t", written(rows(spark, 10, 20, "lost"), "b"))
    published(store, lambda tx: tx.take("f", spark.createDataFrame([("b1",)], "batch_id string")))
    want = values(store)
    gone = store.expire(keep=2)
    assert len(gone) >= 3 and abandoned.version in gone
    assert values(store) == want and set(want.values()) == {"v0", "v4"}
    assert store.ledger().count() == 1 and len(store.numbers()) == 2


def test_late_rows_lose_against_newer_ones(spark):
    landed = landed_admissions(spark, 4, 11)
    at = lambda b: F.col("file_name") == f"f{b}.csv"
    today = F.lit("2025-01-01").cast("date")
    target = written(silver.stg_admissions(landed.filter(at(0) | at(3)), today), "target")
    seen = landed.filter(at(0) | at(3))
    for b in (2, 1):  # older stamps, landing later
        fresh = inc.still_newest(landed.filter(at(b)), target, "admission_id")
        upsert = written(inc.rewritten_admissions(target, fresh, today), "rows")
        target = written(inc.merge_upsert(target, upsert, "admission_id"), "target")
        seen = seen.unionByName(landed.filter(at(b)))
        assert same_rows(target, silver.stg_admissions(seen, today))


def rebuilt(spark, stores):
    landed = {f: bronze.read_landing(spark, stores.landing(f), FEEDS[f]) for f in FEEDS}
    stg = {
        "stg_admissions": silver.stg_admissions(landed["patient_admissions"], F.lit(AS_OF)),
        "stg_treatments": silver.stg_treatments(landed["treatment_records"]),
        "stg_claims": silver.stg_claims(landed["insurance_claims"]),
    }
    facts = {"fct_admissions": gold.fct_admissions, "fct_treatments": gold.fct_treatments, "fct_claims": gold.fct_claims}
    return stg | {n: make(stg[n.replace("fct_", "stg_")]) for n, make in facts.items()}


def gate(spark, incoming, stores, batch, at):
    drop(incoming, batch)
    ingest.run_gate(spark, str(incoming), stores, f"r{batch}", at)


def clean(spark, stores, feed=ADMISSIONS, **more):
    today = F.lit(AS_OF)
    pipeline.bring_up_to_date(
        TableStore(spark, stores.root), stores, feed, "stg_admissions", lambda r: silver.stg_admissions(r, today),
        lambda target, fresh: inc.rewritten_admissions(target, fresh, today), gold.fct_admissions, **more,
    )


def test_a_step_that_stops_anywhere_is_made_up_for(spark, setup, monkeypatch):
    incoming, _, stores = setup
    gate(spark, incoming, stores, 0, AT)
    clean(spark, stores)
    gate(spark, incoming, stores, 1, AT + dt.timedelta(minutes=10))
    store = TableStore(spark, stores.root)
    before = {n: written(store.table(n), "before") for n in ("stg_admissions", "fct_admissions")}
    save, steps = Transaction.save, []

    def count(self, df, path, *by):
        steps.append(path)
        save(self, df, path, *by)

    def stop_after(n):
        def saving(self, df, path, *by):
            if len(steps) == n:
                raise InterruptedError(path)
            count(self, df, path, *by)

        return saving

    for n in range(5):  # ledger, rows and ranges of the cleaned table, rows and ranges of the fact
        steps.clear()
        monkeypatch.setattr(Transaction, "save", stop_after(n))
        with pytest.raises(InterruptedError):
            clean(spark, stores)
        assert all(same_rows(store.table(name), df) for name, df in before.items())
    monkeypatch.undo()
    monkeypatch.setattr(Transaction, "publish", lambda self: (_ for _ in ()).throw(InterruptedError()))
    with pytest.raises(InterruptedError):  # everything is written, nothing published
        clean(spark, stores)
    monkeypatch.undo()
    clean(spark, stores)
    want = rebuilt(spark, stores)
    assert same_rows(store.table("stg_admissions"), want["stg_admissions"])
    assert same_rows(store.table("fct_admissions"), want["fct_admissions"])
    number = store.current().number
    clean(spark, stores)  # nothing new: the same rows
    assert same_rows(store.table("fct_admissions"), want["fct_admissions"]) and store.current().number == number + 1


def test_a_batch_that_lands_late_is_taken_once(spark, setup):
    incoming, seeds, stores = setup
    p = Pipeline(spark, stores, str(seeds))
    gate(spark, incoming, stores, 0, AT)
    p.build(AT, AS_OF)
    gate(spark, incoming, stores, 2, AT + dt.timedelta(minutes=20))
    p.build(AT + dt.timedelta(minutes=20), AS_OF)
    gate(spark, incoming, stores, 1, AT + dt.timedelta(minutes=10))  # stamped before what is taken already
    p.build(AT + dt.timedelta(minutes=30), AS_OF)
    for name, df in rebuilt(spark, stores).items():
        assert same_rows(p.table(name), df), name
    ledger = [(r["feed"], r["batch_id"]) for r in p.store.ledger().collect()]
    assert sorted(ledger) == sorted((f, f"r{b}") for f in FEEDS for b in range(3))


def test_the_watermark_is_still_there_and_misses_late_batches(spark, setup):
    incoming, _, stores = setup
    for batch, minutes in ((0, 0), (2, 20), (1, 10)):
        gate(spark, incoming, stores, batch, AT + dt.timedelta(minutes=minutes))
        clean(spark, stores, fresh_by="watermark")
    t = TableStore(spark, stores.root).table("stg_admissions")
    assert t.filter("file_name like '%_1.csv'").count() == 0 and t.filter("file_name like '%_2.csv'").count() == 30
    with pytest.raises(ValueError):
        clean(spark, stores, fresh_by="luck")


def test_a_new_column_passes_through_a_step(spark, setup, monkeypatch):
    """Cleaning that gains a column and loses another reaches the stored table, older ranges included."""
    incoming, _, stores = setup
    gate(spark, incoming, stores, 0, AT)
    clean(spark, stores)
    gate(spark, incoming, stores, 1, AT + dt.timedelta(minutes=10))
    history = inc.rewritten_admissions
    monkeypatch.setattr(inc, "rewritten_admissions", lambda *a: history(*a).drop("department").withColumn("ward", F.lit("w")))
    monkeypatch.setattr(pipeline.inc, "incr_facts", lambda fact, rows, *_: fact.limit(0))
    clean(spark, stores)
    t = TableStore(spark, stores.root).table("stg_admissions")
    assert "ward" in t.columns and "department" not in t.columns
    old = rebuilt(spark, stores)["stg_admissions"]
    assert t.count() == old.count() and 0 < t.filter("ward = 'w'").count() <= t.count()


@pytest.mark.parametrize("seed", [1, 2])
def test_random_upserts_equal_a_dictionary(spark, store, seed):
    r = random.Random(seed)
    held = {}
    for i in range(4):
        batch = {r.randrange(-50, 150): f"{i}" for _ in range(r.choice([0, 1, 25]))}
        df = written(spark.createDataFrame(list(batch.items()), "k long, v string"), "b")
        held |= batch
        published(store, (lambda tx: tx.upsert("t", df)) if i else (lambda tx: tx.replace("t", df, "k", width=10)))
        assert values(store) == held

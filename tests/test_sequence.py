"""Numbering of very large groups equals the plain window."""

import random

import pytest
from pyspark.sql import functions as F

from wardline.operators import sequence as q
from wardline.operators.latest import dedup_latest

SPEC = q.Sequence(key="k", day="d", id="i", seq="seq", total="total", value="v", previous="prev")


def rows(spark, n=4000, seed=1):
    """A third of the rows under one key, another third under NULL; days and ids partly NULL."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        key = r.choice([7, None, r.randrange(50)])
        day = None if r.random() < 0.1 else f"2024-{r.randrange(1, 13):02d}-{r.randrange(1, 4):02d}"
        value = None if r.random() < 0.2 else f"2024-01-{r.randrange(1, 29):02d}"
        ident = None if i == 0 else i * r.choice([1, 1 << 19, 1 << 22]) + i
        out.append((key, day, ident, value))
    seen, unique = set(), []
    for x in out:
        if x[2] not in seen:
            seen.add(x[2])
            unique.append(x)
    df = spark.createDataFrame(unique, "k long, d string, i long, v string")
    return df.withColumns({"d": F.col("d").cast("date"), "v": F.col("v").cast("date")})


def as_set(df):
    return {tuple(r) for r in df.select("k", "d", "i", "v", "seq", "total", "prev").collect()}


def by_hand(df):
    out = set()
    groups = {}
    for r in df.collect():
        groups.setdefault(r["k"], []).append(r)
    for k, group in groups.items():
        group.sort(key=lambda r: (r["d"] is None, r["d"] or 0, r["i"] is None, r["i"] or 0))
        for n, r in enumerate(group):
            out.add((k, r["d"], r["i"], r["v"], n + 1, len(group), group[n - 1]["v"] if n else None))
    return out


@pytest.mark.parametrize("samples", [1, 5, 20, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_numbers_do_not_depend_on_the_cut_points(spark, samples, seed):
    df = rows(spark, seed=seed)
    assert as_set(q.number_rows(df, SPEC, samples=samples)) == by_hand(df)


def test_large_keys_are_cut_into_bounded_pieces(spark):
    df = rows(spark, 12_000, seed=2)
    points = {r["key"]: r["points"] for r in q.cut_points(df, SPEC).collect()}
    assert set(points) == {7, None} and all(1 <= len(p) <= 8 for p in points.values())
    order = lambda p: (p["no_day"], p["day"] if not p["no_day"] else 0, p["no_id"], p["id"] or 0)
    for key, cuts in points.items():
        places = df.filter(F.col("k").eqNullSafe(F.lit(key))).select(q.place_of(SPEC).alias("p")).collect()
        sizes = [sum(1 for p in places if sum(order(c) <= order(p["p"]) for c in cuts) == i) for i in range(len(cuts) + 1)]
        assert sum(sizes) == len(places) and max(sizes) <= 3 * 12_000 / 8


def test_no_large_key_no_cut(spark):
    df = spark.range(5000).select((F.col("id") % 500).alias("k"), F.lit(None).cast("date").alias("d"), F.col("id").alias("i"), F.lit(None).cast("date").alias("v"))
    assert q.cut_points(df, SPEC) is None and q.cut_points(df.limit(0), SPEC) is None
    assert q.number_rows(df.limit(0), SPEC).count() == 0


def test_points_of_another_table_give_the_same_numbers(spark):
    df = rows(spark, seed=3)
    other = rows(spark, seed=4).select("k", "d", "i")
    assert as_set(q.number_rows(df, SPEC, sample_of=other, samples=3)) == by_hand(df)


def test_one_exchange_of_the_rows_and_no_window_over_a_whole_key(spark):
    df = rows(spark)
    plan = q.number_rows(df, SPEC, samples=3)._jdf.queryExecution().executedPlan().toString()
    over_rows = [line for line in plan.splitlines() if "Window " in line and "row_number" in line]
    assert over_rows and all("_piece" in w for w in over_rows)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_piece" in line]
    assert len(exchanges) <= 2  # the rows once, and the counts of pieces


@pytest.mark.parametrize("copies", [1, 3000])
def test_dedup_keeps_the_newest(spark, copies):
    df = spark.range(copies).select(
        F.lit(1).alias("id"),
        (F.timestamp_seconds(F.col("id") % 7).cast("timestamp_ntz")).alias("load_dttm"),
        F.col("id").alias("payload"),
    )
    got = dedup_latest(df, "id").collect()
    best = max((i % 7, i) for i in range(copies))
    assert len(got) == 1 and got[0]["payload"] == best[1]


def test_dedup_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("load_dttm"))
    plan = dedup_latest(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_dedup_sorts_no_whole_split_before_the_shuffle(spark):
    """Rows of usual keys meet their sort behind the shuffle; a large key, or NULL, is still cut down before it."""
    n = 40 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    usual = spark.range(n).select(F.floor(F.col("id") / 2).alias("k"), F.col("id").alias("load_dttm"), F.col("id").alias("x"))
    plan = dedup_latest(usual, "k")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert {(r["k"], r["x"]) for r in dedup_latest(usual, "k").collect()} == {(i, 2 * i + 1) for i in range(n // 2)}

    hot = F.when(F.col("x") % 3 == 0, -1).when(F.col("x") % 3 == 1, F.col("k"))
    mixed = usual.withColumn("k", hot.cast("long")).withColumn("load_dttm", F.lit(None).cast("long"))
    done = dedup_latest(mixed, "k")
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "NestedLoop" not in plan
    want = {}
    for x in range(n):
        want[-1 if x % 3 == 0 else x // 2 if x % 3 == 1 else None] = x
    assert sorted((r["k"] is not None, r["k"] or 0, r["x"]) for r in done.collect()) == sorted((k is not None, k or 0, x) for k, x in want.items())


def test_dedup_twice_changes_nothing(spark, sf):
    from wardline.registry import adapters as a

    once = dedup_latest(a.admissions(spark, sf), "admission_id")
    assert once.exceptAll(dedup_latest(once, "admission_id")).isEmpty()

"""Exact statistics against Spark's own aggregates and brute force."""

import math
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardline.operators import spread


def frame(spark, pairs):
    return spark.createDataFrame([(k, None if v is None else Decimal(v)) for k, v in pairs], "k string, v decimal(12,2)")


def exact_percentile_x100(values, percent):
    s = sorted(int(Decimal(v) * 100) for v in values)
    lo, frac = divmod((len(s) - 1) * percent, 100)
    hi = min(lo + (1 if frac else 0), len(s) - 1)
    return s[lo] * (100 - frac) + s[hi] * frac


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    r = random.Random(seed)
    pairs = []
    for k in ("a", "b", None, "c", "d"):
        n = r.choice([1, 2, 100, 101, 500])
        pairs += [(k, f"{r.uniform(-5e6, 9e6):.2f}") for _ in range(n)]
    pairs += [("same", "12.50")] * 40 + [("none", None)]
    pairs += [("a", None)]
    got = {x["k"]: x for x in spread.cost_statistics(frame(spark, pairs), "k", "v").collect()}
    assert "none" not in got
    for k, row in got.items():
        vals = [v for kk, v in pairs if kk == k and v is not None]
        assert row["n"] == len(vals)
        assert row["percentile_x100"] == exact_percentile_x100(vals, 99)
        mean = sum(map(Decimal, vals)) / len(vals)
        assert abs(row["mean"] - mean) <= Decimal("0.005")
        if len(vals) > 1:
            want = statistics.stdev(float(v) for v in vals)
            assert math.isclose(row["deviation"] / 100, want, rel_tol=1e-9, abs_tol=1e-9)
        else:
            assert row["deviation"] is None


def test_against_spark(spark, sf):
    from wardline.plans import silver
    from wardline.registry import adapters as a

    c = silver.clean_treatments(a.treatments(spark, sf))
    want = c.groupBy("procedure_code").agg(
        F.percentile(F.col("cost"), 0.99).alias("p"), F.stddev_samp(F.col("cost").cast("double")).alias("s")
    )
    got = spread.cost_statistics(c, "procedure_code", "cost")
    for r in got.join(want, "procedure_code").collect():
        assert math.isclose(r["percentile_x100"] / 10000, r["p"], rel_tol=1e-9)
        assert math.isclose(r["deviation"] / 100, r["s"], rel_tol=1e-9)


def test_constant_cost_has_no_z_score_and_no_outlier(spark):
    df = frame(spark, [("x", "99999.99")] * 50 + [("y", "5.00")])
    out = spread.attach(df, spread.cost_statistics(df, "k", "v"), "k").select(
        "k", spread.z_score(F.col("v")).alias("z"), spread.above_percentile(F.col("v")).alias("o")
    )
    assert all(r["z"] == 0 and r["o"] is False for r in out.collect())


def test_spread_of_large_amounts(spark):
    big = [("x", "9999999999.99"), ("x", "-9999999999.99")] * 20
    row = spread.cost_statistics(frame(spark, big), "k", "v").first()
    assert math.isclose(row["deviation"] / 100, statistics.stdev(float(v) for _, v in big), rel_tol=1e-14)


@pytest.mark.parametrize("weight", [1, 10**7, 10**11])
def test_deviation_of_very_many_rows(spark, weight):
    """Bins that stand for up to 10^11 rows each, with sums of up to 37 digits."""
    from fractions import Fraction

    values = [-999_999_999_999, -999_999_999_999, 5, 999_999_999_999, 999_999_999_998]
    near = [999_999_999_999] * 4 + [999_999_999_998]
    for vals in (values, near, [7] * 5):
        bins = [("x", i, weight, Decimal(v * weight), Decimal(v * v * weight)) for i, v in enumerate(vals)]
        df = spark.createDataFrame(bins, "k string, _bin long, _n long, _s decimal(24,0), _q decimal(38,0)")
        got = spread._edge_bins(df, "k", 99).first()["deviation"]
        n, total = 5 * weight, sum(vals) * weight
        want = math.sqrt((Fraction(sum(v * v for v in vals) * weight) - Fraction(total * total, n)) / (n - 1))
        assert math.isclose(got, want, rel_tol=1e-14)

"""Per-key cost statistics and exact percentiles without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wardline.session import written

# Values are handled as whole hundredths; a bin holds at most BIN distinct ones.
BIN = 1_000_000


def hundredths(c: Column) -> Column:
    return (c * F.lit(100)).cast("decimal(14,0)").cast("long")


def cost_statistics(df: DataFrame, key: str, value: str, percent: int = 99) -> DataFrame:
    """One row per key: count, total and sample deviation (in hundredths), mean, percentile.

    Everything is exact integer arithmetic until the last step, so results do not depend on the
    order in which partial sums meet:

    * pass 1 sums per (key, bin) on the map side. One window over the bins of a key gives its
      totals and a running count, which tells the bins that hold the two ranks the percentile lies
      between. These rows, two per key at most, are written out;
    * pass 2 counts distinct values in just those bins and picks the two values.

    A window never covers more than the bins of a key or the distinct values of a bin.
    ``percentile_x100`` is 100 times the percentile in hundredths: ``lo * (100 - f) + hi * f``.
    """
    cents = df.filter(F.col(value).isNotNull()).select(key, hundredths(F.col(value)).alias("_v"))
    cents = cents.withColumn("_bin", F.floor(F.col("_v") / F.lit(BIN)).cast("long"))
    edges = written(_edge_bins(_bin_sums(cents, key), key, percent), "percentile-bins")

    needed = edges.select("_k", F.col("_bin").alias("_b"), "_before", "_lo", "_hi")
    counted = (
        cents.join(needed, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_bin") == F.col("_b")))
        .groupBy("_k", "_b", "_before", "_lo", "_hi", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    inside = W.partitionBy("_k", "_b").orderBy("_v")
    valued = counted.withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
    valued = valued.withColumn("_start", F.col("_end") - F.col("_n"))
    values = valued.groupBy(F.col("_k").alias("_vk")).agg(
        F.max(F.when(_covers("_lo", "_start", "_end"), F.col("_v"))).alias("_a"),
        F.max(F.when(_covers("_hi", "_start", "_end"), F.col("_v"))).alias("_z"),
    )
    per_key = edges.filter(_covers("_lo", "_before", "_upto"))  # exactly one bin per key
    stats = per_key.join(values, F.col("_k").eqNullSafe(F.col("_vk"))).select(
        F.col("_k").alias(key),
        "n",
        "total",
        "mean",
        "deviation",
        (F.col("_a") * (100 - F.col("_frac")) + F.col("_z") * F.col("_frac")).alias("percentile_x100"),
    )
    return written(stats, "statistics")


def _covers(rank: str, first: str, end: str) -> Column:
    return (F.col(rank) >= F.col(first)) & (F.col(rank) < F.col(end))


def _bin_sums(cents: DataFrame, key: str) -> DataFrame:
    big = F.col("_v").cast("decimal(14,0)")
    return cents.groupBy(key, "_bin").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(big).cast("decimal(24,0)").alias("_s"),
        F.sum((big * big).cast("decimal(28,0)")).alias("_q"),
    )


def _edge_bins(bins: DataFrame, key: str, percent: int) -> DataFrame:
    """The bins around the percentile, with the totals of their key."""
    running = W.partitionBy(key).orderBy("_bin")
    whole = running.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    n = F.col("n")
    tallied = bins.select(
        F.col(key).alias("_k"),
        "_bin",
        F.coalesce(F.sum("_n").over(running.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(running).alias("_upto"),
        F.sum("_n").over(whole).alias("n"),
        F.sum("_s").over(whole).cast("decimal(30,0)").alias("total"),
        F.sum("_q").over(whole).cast("decimal(38,0)").alias("_q"),
    ).withColumn("_frac", ((n - 1) * percent) % 100)
    tallied = tallied.withColumn("_lo", (((n - 1) * percent - F.col("_frac")) / 100).cast("long"))
    tallied = tallied.withColumn("_hi", F.col("_lo") + F.when(F.col("_frac") > 0, 1).otherwise(0))
    edges = tallied.filter(_covers("_lo", "_before", "_upto") | _covers("_hi", "_before", "_upto"))
    return edges.select(
        "_k", "_bin", "_before", "_upto", "_lo", "_hi", "_frac", "n", "total", _mean().alias("mean"), _deviation().alias("deviation")
    )


def _nearest() -> Column:
    """The whole number next to the mean (halves away from zero), from quotient and remainder."""
    wide, total = F.col("n").cast("decimal(18,0)"), F.col("total")
    left_over = total % wide
    cut = ((total - left_over) / wide).cast("decimal(24,0)")
    return cut + F.when(F.abs(left_over) * 2 >= wide, F.signum(left_over).cast("decimal(1,0)")).otherwise(0)


def _deviation() -> Column:
    """Sample deviation from whole-number sums around the whole number ``c`` next to the mean.

    The squared gaps to ``c`` sum to q - c (2 total - n c), and the gaps themselves to total - n c, both
    without rounding: up to 10^12 rows of a key these numbers have 38 digits at most. The second sum is n / 2 at
    most, and never above the first one, so what is left after the correction is at least half of it
    and the only rounding is that of the last three operations in double.
    """
    n, total = F.col("n"), F.col("total").cast("decimal(25,0)")
    wide, c = n.cast("decimal(13,0)"), _nearest().cast("decimal(13,0)")
    gaps = (total - (wide * c).cast("decimal(25,0)")).cast("decimal(25,0)")
    squares = F.col("_q") - (c * (total + gaps).cast("decimal(25,0)")).cast("decimal(38,0)")
    left = squares.cast("double") - gaps.cast("double") * (gaps.cast("double") / n)
    return F.sqrt(F.greatest(left, F.lit(0.0)) / F.when(n > 1, n - 1))


def _mean() -> Column:
    """Rounded half up to hundredths."""
    return (_nearest().cast("decimal(24,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(14,2)")


def z_score(value: Column) -> Column:
    """(value - mean) / deviation, 2 digits, over attached statistics; no deviation gives 0."""
    n = F.col("n")
    gap = (hundredths(value).cast("decimal(14,0)") * n.cast("decimal(18,0)")).cast("decimal(32,0)") - F.col("total")
    usable = F.col("deviation") > 0
    z = F.round(gap.cast("double") / (n.cast("double") * F.when(usable, F.col("deviation"))), 2)
    return F.when(F.col("deviation").isNull() | ~usable, F.lit(0.0)).otherwise(z)


def above_percentile(value: Column) -> Column:
    return F.coalesce(hundredths(value) * 100 > F.col("percentile_x100"), F.lit(False))


def attach(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Left join on the key, null-safe.

    The statistics are a written table, so Spark knows their size when it plans: below the
    broadcast threshold the rows are not shuffled at all, above it hot keys of the row side are
    split at run time.
    """
    renamed = stats.withColumnRenamed(key, "_k")
    return df.join(renamed, F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")

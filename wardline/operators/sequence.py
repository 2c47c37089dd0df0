"""Ordered numbering, group size and previous value per key, whatever the size of a group.

A window by key alone sends each key to one task, and a placeholder patient may hold a third of all
rows. So the rows of a key are first cut at points of their order, taken from a sample:

1. a sample of about ``SAMPLES`` rows per shuffle partition gives each key points ``SAMPLES`` sampled rows
   apart, so no piece holds much more than a partition's share. Keys with less than two shares,
   usually all of them, have no points and are one piece;
2. rows are numbered within (key, piece): one exchange, one sort, one window;
3. the pieces of the keys that were cut, as few as there are points, are counted, and each gets the rows
   before it, the key's total and the value before its first row.

The points only deal the work: any points, or none, give the same numbers.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wardline.session import written

SAMPLES = 20  # sampled rows per shuffle partition, and between two points of a key
PLACE = "struct<no_day:boolean,day:date,no_id:boolean,id:bigint>"


@dataclass(frozen=True)
class Sequence:
    """What to compute: order by ``day`` then ``id`` (NULL last) inside ``key``."""

    key: str
    day: str
    id: str
    seq: str
    total: str
    value: str | None = None  # date column carried over from the row before
    previous: str | None = None


def place_of(spec: Sequence) -> Column:
    """A row's place in its key's order."""
    day, ident = F.col(spec.day), F.col(spec.id).cast("long")
    return F.struct(day.isNull().alias("no_day"), day.alias("day"), ident.isNull().alias("no_id"), ident.alias("id"))


def cut_points(
    rows: DataFrame,
    spec: Sequence,
    samples: int = SAMPLES,
    sampled: int | None = None,
    places: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame | None:
    """(key, points): sorted places at which the large keys of ``rows`` are cut; None if no key is large.

    ``rows`` may be an earlier state of what is numbered; ``places`` makes key, day and id out of sampled rows.
    About ``sampled`` rows reach the driver, ``samples`` per shuffle partition unless said, and one point per
    ``samples`` of them comes out.
    """
    spark = rows.sparkSession
    wanted = sampled or samples * int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = rows.count()
    share = min(1.0, wanted / n) if n else 1.0
    if n and share == 1.0 and n < 2 * samples:
        return None
    picked = rows.sample(share, seed=1) if share < 1.0 else rows
    picked = (places(picked) if places else picked).select(F.col(spec.key).alias("key"), place_of(spec).alias("place"))
    by_key: dict[object, list] = {}
    for r in picked.collect():
        by_key.setdefault(r["key"], []).append(r["place"])
    order = lambda p: (p["no_day"], p["day"] if not p["no_day"] else 0, p["no_id"], p["id"] or 0)
    cut = [(k, sorted(places, key=order)[samples::samples]) for k, places in by_key.items() if len(places) >= 2 * samples]
    if not cut:
        return None
    kind = picked.schema["key"].dataType.simpleString()
    return spark.createDataFrame(cut, f"key {kind}, points array<{PLACE}>")


def _points_passed(points: Column, place: Column, most: int) -> Column:
    """How many of the sorted ``points`` (``most`` at most) are at or before ``place``, by halving."""
    size = F.coalesce(F.size(points), F.lit(0))
    between = F.struct(F.lit(0).alias("low"), size.alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = ((s["low"] + s["high"]) / 2).cast("int")
        before = F.get(points, middle) <= place
        low = F.when((s["low"] < s["high"]) & before, middle + 1).otherwise(s["low"])
        high = F.when((s["low"] < s["high"]) & ~before, middle).otherwise(s["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    steps = F.array(*[F.lit(i) for i in range(most.bit_length() + 1)])
    return F.when(points.isNull(), F.lit(0)).otherwise(F.aggregate(steps, between, halve)["low"])


def number_rows(
    df: DataFrame,
    spec: Sequence,
    sample_of: DataFrame | None = None,
    places: Callable[[DataFrame], DataFrame] | None = None,
    samples: int = SAMPLES,
    sampled: int | None = None,
) -> DataFrame:
    """Add ``seq``, ``total`` and, if asked, ``previous``. ``sample_of`` (``df`` unless given) and the others: see
    ``cut_points``."""
    points = cut_points(df if sample_of is None else sample_of, spec, samples, sampled, places)
    if points is None:
        return df.withColumns(_inside(spec, [spec.key]))
    most = points.agg(F.max(F.size("points"))).first()[0]
    same = F.col(spec.key).eqNullSafe(F.col("_pk"))
    # as many points as ``sampled / samples`` at most
    dealt = F.broadcast(points.select(F.col("key").alias("_pk"), F.col("points").alias("_points"), F.lit(True).alias("_cut")))
    piece = _points_passed(F.col("_points"), place_of(spec), most)
    rows = written(df.join(dealt, same, "left").withColumn("_piece", piece).drop("_pk", "_points"), "pieces")

    value = F.col(spec.value) if spec.previous else F.lit(None).cast("date")
    pieces = rows.filter("_cut").groupBy(F.col(spec.key).alias("_k"), F.col("_piece").alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.struct(place_of(spec).alias("place"), value.alias("value"))).alias("_last")
    )
    of_key = W.partitionBy("_k").orderBy("_p")
    pieces = pieces.select(
        "_k",
        "_p",
        F.coalesce(F.sum("_n").over(of_key.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"),
        F.sum("_n").over(of_key.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("_all"),
        F.lag("_last").over(of_key)["value"].alias("_before"),
    )
    numbered = rows.withColumns({**_inside(spec, [spec.key, "_piece"]), "_first": F.row_number().over(_ordered(spec, [spec.key, "_piece"])) == 1})
    at = F.col(spec.key).eqNullSafe(F.col("_k")) & (F.col("_piece") == F.col("_p"))
    joined = numbered.join(F.broadcast(pieces), at, "left")  # as many rows as points, and one per cut key
    out = {
        spec.seq: F.col(spec.seq) + F.coalesce("_base", F.lit(0)),
        spec.total: F.coalesce("_all", F.col(spec.total)),
    }
    if spec.previous:
        out[spec.previous] = F.when(F.col("_first"), F.col("_before")).otherwise(F.col(spec.previous))
    return joined.select(*df.columns, *[c.alias(name) for name, c in out.items()])


def _ordered(spec: Sequence, by: list[str]):
    return W.partitionBy(*by).orderBy(F.col(spec.day).asc_nulls_last(), F.col(spec.id).asc_nulls_last())


def _inside(spec: Sequence, by: list[str]) -> dict[str, Column]:
    # one (partition, order) pair for all, so Spark plans one exchange, one sort, one window
    ordered = _ordered(spec, by)
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    out = {
        spec.seq: F.row_number().over(ordered).cast("long"),
        spec.total: F.count(F.lit(1)).over(whole),
    }
    if spec.previous:
        out[spec.previous] = F.lag(spec.value).over(ordered)
    return out

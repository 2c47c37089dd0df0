"""Type-2 history: compare, close, open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from wardline.functions.dates import millis_text
from wardline.functions.keys import surrogate_key

NTZ = "timestamp_ntz"
META = ("version_id", "updated_at", "valid_from", "valid_to")


def version_meta(key: str, run_ts: Column) -> list[Column]:
    """Columns a new version gets: an id from key and change time, and an open interval."""
    at = run_ts.cast(NTZ)
    return [
        F.md5(F.concat_ws("|", F.col(key).cast("string"), millis_text(at))).alias("version_id"),
        at.alias("updated_at"),
        at.alias("valid_from"),
        F.lit(None).cast(NTZ).alias("valid_to"),
    ]


class RepeatedKeys(ValueError):
    """A source that holds a key twice has no one version to compare."""


def require_unique(source: DataFrame, key: str, named: int = 20) -> None:
    """Fail with the keys that occur more than once, before any of their copies are paired."""
    twice = source.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = twice.orderBy(key).limit(named + 1).collect()
    if first:
        more = " and more" if len(first) > named else ""
        raise RepeatedKeys(f"{key} repeated: " + ", ".join(f"{r[key]} ({r['n']} rows)" for r in first[:named]) + more)


def first_snapshot(source: DataFrame, key: str, run_ts: Column) -> DataFrame:
    return source.select("*", *version_meta(key, run_ts))


def next_snapshot(
    history: DataFrame,
    source: DataFrame,
    key: str,
    check: Sequence[str],
    run_ts: Column,
    hard_deletes: bool = True,
) -> DataFrame:
    """History after comparing its open versions with ``source`` at ``run_ts``.

    unchanged -> kept as it is; changed in a ``check`` column -> closed and reopened;
    new -> opened; gone -> closed if ``hard_deletes``. One full outer join emits the one or two
    versions of each key. A second run with the same source changes nothing.
    """
    attributes = source.columns
    columns = [*attributes, *META]
    history = history.select(*columns)
    closed = history.filter(F.col("valid_to").isNotNull())
    old = history.filter(F.col("valid_to").isNull()).select(F.struct(*columns).alias("old"))
    new = source.select("*", *version_meta(key, run_ts)).select(F.struct(*columns).alias("new"))

    pairs = old.join(new, F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}")), "full_outer")
    gone = F.col("new").isNull()
    same = F.lit(True)
    for c in check:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    at = run_ts.cast(NTZ)
    ended = F.col("old").withField("valid_to", at).withField("updated_at", at)
    versions = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(gone, F.array(ended if hard_deletes else F.col("old")))
        .when(same, F.array("old"))
        .otherwise(F.array(ended, F.col("new")))
    )
    return pairs.select(F.inline(versions)).unionByName(closed)


def overlapping_versions(history: DataFrame, key: str) -> DataFrame:
    """Versions that start before the one before them has ended; must be empty."""
    by_start = W.partitionBy(key).orderBy("valid_from")
    ordered = history.withColumns({"_n": F.row_number().over(by_start), "_until": F.lag("valid_to").over(by_start)})
    open_before = (F.col("_n") > 1) & F.col("_until").isNull()
    return ordered.filter(open_before | (F.col("_until") > F.col("valid_from"))).drop("_n", "_until")


def history_view(
    snapshot: DataFrame, key: str, attributes: Sequence[str], sk: str, floor: Column, ceiling: Column
) -> DataFrame:
    """Readable history: the first version reaches back to ``floor``, an open one up to ``ceiling``."""
    first = F.row_number().over(W.partitionBy(key).orderBy("valid_from")) == 1
    return snapshot.select(
        surrogate_key(F.col(key), millis_text(F.col("valid_from"))).alias(sk),
        *attributes,
        F.when(first, floor.cast(NTZ)).otherwise(F.col("valid_from")).alias("valid_from"),
        F.coalesce("valid_to", ceiling.cast(NTZ)).alias("valid_to"),
        F.col("valid_to").isNull().alias("is_current"),
    )


def empty_history(source: DataFrame) -> DataFrame:
    meta = [
        T.StructField("version_id", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("valid_from", T.TimestampNTZType()),
        T.StructField("valid_to", T.TimestampNTZType()),
    ]
    return source.sparkSession.createDataFrame([], T.StructType(list(source.schema.fields) + meta))

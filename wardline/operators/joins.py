"""Joins along keys and validity intervals.

No broadcast hints: Spark broadcasts a side only after its size estimate or, at run time, its
measured shuffle size passes the threshold; beyond that it sort-merges and splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def inner_equi_join(left: DataFrame, right: DataFrame, key: str, *take: str) -> DataFrame:
    return left.join(right.select(key, *take), key, "inner")


def asof_join(facts: DataFrame, versions: DataFrame, key: str, at: str, *take: Column) -> DataFrame:
    """The version of ``key`` valid at date ``at`` in the half-open ``[valid_from, valid_to)``.

    Equality on the key drives the join; the interval is a residual test on the matched versions.
    """
    v = versions.select(F.col(key).alias("_vk"), "valid_from", "valid_to", *take)
    moment = facts[at].cast("timestamp_ntz")
    hit = (facts[key] == v["_vk"]) & (moment >= v["valid_from"]) & (moment < v["valid_to"])
    return facts.join(v, hit).drop("_vk", "valid_from", "valid_to")


FIRST_YEAR, LAST_YEAR = 2000, 2049  # years told apart as parts of a join key; others count as the nearest


def year_part(at: Column) -> Column:
    return F.greatest(F.least(F.year(at), F.lit(LAST_YEAR)), F.lit(FIRST_YEAR))


def asof_join_by_part(facts: DataFrame, versions: DataFrame, key: str, at: str, *take: Column) -> DataFrame:
    """Same result as ``asof_join``, with the year as part of the join key.

    A version is listed under each year it touches, at most 50 of them however long it holds. A key with many
    rows is dealt over its years, and a row meets one year's versions, not a whole history.
    """
    years = F.sequence(year_part(F.col("valid_from")), year_part(F.col("valid_to")))
    v = versions.select(F.col(key).alias("_vk"), "valid_from", "valid_to", *take)
    v = v.filter("valid_from < valid_to").withColumn("_vy", F.explode(years))
    moment = facts[at].cast("timestamp_ntz")
    same = (facts[key] == v["_vk"]) & (year_part(facts[at]) == v["_vy"])
    hit = same & (moment >= v["valid_from"]) & (moment < v["valid_to"])
    return facts.join(v, hit).drop("_vk", "_vy", "valid_from", "valid_to")


def with_current(versions: DataFrame, key: str, *take: str) -> DataFrame:
    """Versions of keys that have a current one, with its columns as ``current_<column>`` beside their own."""
    of_key = W.partitionBy(key).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    now = {f"current_{c}": F.max(F.when(F.col("is_current"), F.col(c))).over(of_key) for c in take}
    return versions.withColumns({**now, "_has_current": F.max("is_current").over(of_key)}).filter("_has_current").drop("_has_current")


def asof_join_by_year(facts: DataFrame, versions: DataFrame, key: str, at: str, *take: Column) -> DataFrame:
    """Same result as ``asof_join`` for keys with very many versions.

    A version is listed under each year it touches, within the years the facts hold, and the year
    becomes part of the join key, so a fact row meets one year's versions and not a whole history.
    """
    span = facts.agg(F.year(F.min(at)).alias("lo"), F.year(F.max(at)).alias("hi")).first()
    first = F.greatest(F.year("valid_from"), F.lit(span["lo"]))
    last = F.least(F.year("valid_to"), F.lit(span["hi"]))
    v = versions.select(F.col(key).alias("_vk"), "valid_from", "valid_to", *take)
    v = v.withColumn("_vy", F.explode(F.when(first <= last, F.sequence(first, last))))
    moment = facts[at].cast("timestamp_ntz")
    hit = (
        (facts[key] == v["_vk"])
        & (F.year(facts[at]) == v["_vy"])
        & (moment >= v["valid_from"])
        & (moment < v["valid_to"])
    )
    return facts.join(v, hit).drop("_vk", "_vy", "valid_from", "valid_to")


def current_join(facts: DataFrame, versions: DataFrame, key: str, *take: Column) -> DataFrame:
    now = versions.filter("is_current").select(key, *take)
    return facts.join(now, key)


SENT_ROWS = 20_000  # facts about groups are sent to all rows up to this many
DEALS = 64


def about_group(rows: DataFrame, facts: DataFrame, key: str, most: int = SENT_ROWS) -> DataFrame:
    """``rows`` with the columns of their group's one row in ``facts``, however many rows a group has.

    Up to ``most`` facts, counted, are sent to the rows. Beyond, each fact is listed ``DEALS`` times and rows
    are dealt by key and the number of their input split, so that a group that holds most rows is spread over
    ``DEALS`` tasks. ``facts`` is a written table.
    """
    f = facts.withColumnRenamed(key, "_g")
    if facts.count() <= most:
        return rows.join(F.broadcast(f), F.col(key) == F.col("_g")).drop("_g")
    dealt = rows.withColumn("_deal", F.spark_partition_id() % DEALS)
    listed = f.withColumn("_d", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))))
    return dealt.join(listed, (F.col(key) == F.col("_g")) & (F.col("_deal") == F.col("_d"))).drop("_g", "_deal", "_d")


def _keys(keys: DataFrame, key: str) -> DataFrame:
    # a fresh column, so that keys taken from the joined table itself stay distinguishable
    return keys.select(F.col(key).alias("_key"))


def in_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``keys``; NULL matches NULL."""
    return df.join(_keys(keys, key), F.col(key).eqNullSafe(F.col("_key")), "left_semi")


def not_in_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(_keys(keys, key), F.col(key).eqNullSafe(F.col("_key")), "left_anti")


def in_either(df: DataFrame, first: DataFrame, first_key: str, second: DataFrame, second_key: str) -> DataFrame:
    """Rows with a match on one key or the other, each row once and without a disjunctive join.

    Two equi joins against de-duplicated key lists; a nested loop is never needed.
    """
    a = first.select(F.col(first_key).alias("_a")).distinct().withColumn("_in_a", F.lit(True))
    b = second.select(F.col(second_key).alias("_b")).distinct().withColumn("_in_b", F.lit(True))
    tagged = df.join(a, F.col(first_key).eqNullSafe(F.col("_a")), "left").join(
        b, F.col(second_key).eqNullSafe(F.col("_b")), "left"
    )
    return tagged.filter("_in_a or _in_b").select(*df.columns)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key).alias("_pk"))
    return child.filter(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_pk"), "left_anti")

"""Mixing sources to target weights by Sainte-Lague apportionment, DataFrame operations only.

Sources get targets (water filling under a cap), targets become integer quotas of equal-token
blocks (highest quotients), the part of a quota that is no whole pass over the source is divided
among the source's shards by the same rule, and each shard fills its quota from its documents in a
seeded order. A shard holds a bounded number of documents, so a source of any size is spread over
many tasks; only per-source and per-shard totals meet.

Defined results: null or empty text has size 0 and is never taken; a null source is a source of its
own, ordered last; an empty table gives an empty plan; rows that repeat (id and text) are taken alike,
and what a quota leaves for them is shared in whole words; further columns of the input are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import WORD
from wardline.session import written

CAP = 3  # a source, and a document, is taken this many times at most


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(seed: int) -> Column:
    """Seeded position of a document within its shard, the same in every run."""
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def source_targets(sources: DataFrame) -> DataFrame:
    """Adds ``weight`` and ``target`` to one row per source (``source``, ``source_size``).

    Targets share the sum of all sizes by weight; none exceeds CAP times its source, and what a
    capped source cannot take is shared again by weight. Sorted by CAP * size / weight the capped
    sources come first, and the level "remaining sum / remaining weight" rises up to the last capped
    source and falls afterwards, so its maximum is the final level.
    """
    all_sources = Window.partitionBy()
    ordered = sources.withColumn(
        "weight",
        (1 + (F.row_number().over(all_sources.orderBy(F.col("source").asc_nulls_last())) - 1) % 3).cast("double"),
    ).withColumn("limit", (CAP * F.col("source_size")).cast("double"))
    before = all_sources.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    level = (F.sum("source_size").over(all_sources) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(all_sources) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    return (
        ordered.withColumn("level", level)
        .withColumn("target", F.least(F.col("limit"), F.max("level").over(all_sources) * F.col("weight")))
        .drop("level", "limit")
    )


def apportion(parties: DataFrame, within: list[str], votes: str, seats: str, order: list[Column], out: str) -> DataFrame:
    """Integer seats for each party of a group by highest quotients votes / (k - 1/2).

    ``seats`` holds the group's number of seats on each of its rows. Two divisors bound each
    party's result from below and above, about two candidate seats per party remain, and only their
    quotients are ranked. Ties go by ``order``. Parties without votes get no seat.
    """
    group = Window.partitionBy(*within)
    total, n = F.sum(votes).over(group).cast("double"), F.count(F.lit(1)).over(group)
    bounded = (
        parties.withColumn("_total", total)
        .withColumn("_n", n)
        .withColumn(
            "_low",
            F.when(
                (F.col(seats) > F.col("_n") / 2) & (F.col("_total") > 0),
                F.greatest(
                    F.lit(0),
                    F.floor(F.col(votes) * (F.col(seats) - F.col("_n") / 2) / F.col("_total") + 0.5 - 1e-6),
                ),
            ).otherwise(F.lit(0)).cast("long"),
        )
        .withColumn(
            "_high",
            F.when(
                (F.col("_total") > 0) & (F.col(votes) > 0),
                F.floor(F.col(votes) * (F.col(seats) + F.col("_n") / 2) / F.col("_total") + 0.5) + 1,
            ).otherwise(F.col("_low")).cast("long"),
        )
        .withColumn("_left", F.col(seats) - F.sum("_low").over(group))
    )
    candidate = F.explode(
        F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low") + 1, F.col("_high"))).otherwise(
            F.array().cast("array<long>")
        )
    )
    keys = [c for c in parties.columns if c not in (votes, seats)]
    won = (
        bounded.select("*", candidate.alias("_k"))
        .withColumn("_rank", F.row_number().over(group.orderBy((F.col(votes) / (F.col("_k") - 0.5)).desc(), *order, "_k")))
        .filter(F.col("_rank") <= F.col("_left"))
        .select(*[F.col(c) for c in parties.columns], F.lit(1).alias("_won"), F.lit(0).cast("long").alias("_low"))
    )
    base = bounded.select(*parties.columns, F.lit(0).alias("_won"), "_low")
    return base.unionByName(won).groupBy(*keys, votes, seats).agg(F.sum(F.col("_won") + F.col("_low")).alias(out))


@dataclass(frozen=True)
class Plan:
    """What a document's part in the mix follows from: two small written tables."""

    sources: DataFrame  # source, source_size, shards, weight, target, quota_blocks, passes
    shards: DataFrame  # source, shard, whole_to, cut_key, cut_part
    seed: int


def plan(
    docs: DataFrame, block_tokens: int = 16, shard_rows: int = 4096, seed: int = 17, most_shards: int = 100_000
) -> Plan:
    """Quotas of the sources, and where each shard's quota ends.

    Documents of a shard are taken in the order of their keys: all with keys up to ``whole_to``, and
    ``cut_part`` words of ``cut_key``. Rows that repeat have one key and share what falls to it evenly,
    whole words each. ``shard_rows`` grows where there would be more than ``most_shards`` shards, so that the
    plan stays small beside the documents.
    """
    return _plan(written(_sized(docs, seed), "mix-sizes"), block_tokens, shard_rows, seed, most_shards)


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), row_key(seed).alias("row_key"))


def _plan(sized: DataFrame, block_tokens: int, shard_rows: int, seed: int, most_shards: int) -> Plan:
    per_shard_rows = max(shard_rows, -(-sized.count() // most_shards))
    sources = sized.groupBy("source").agg(
        F.sum("size").cast("long").alias("source_size"),
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / per_shard_rows)).cast("long").alias("shards"),
    )
    every = Window.partitionBy()
    targets = source_targets(sources).withColumn(
        "blocks", F.round(F.sum("source_size").over(every) / block_tokens).cast("long")
    )
    quotas = apportion(
        targets, [], "target", "blocks", [F.col("source").asc_nulls_last()], "quota_blocks"
    )
    words = F.least(F.col("quota_blocks") * block_tokens, CAP * F.col("source_size"))
    quotas = written(
        quotas.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest_blocks", F.round((words - F.col("passes") * F.col("source_size")) / block_tokens).cast("long"))
        .drop("blocks"),
        "mix-quotas",
    )
    dealt = _with_shard(sized, quotas)
    keys = written(
        dealt.groupBy("source", "shard", "row_key").agg(F.sum("size").cast("long").alias("words"), F.count(F.lit(1)).alias("copies")),
        "mix-keys",
    )
    per_shard = (
        keys.groupBy("source", "shard").agg(F.sum("words").cast("long").alias("shard_size")).alias("s")
        # A full third pass leaves nothing for a part: rounding may not exceed the cap.
        .join(
            quotas.select("source", F.when(F.col("passes") < CAP, F.col("rest_blocks")).otherwise(0).alias("rest_blocks")).alias("q"),
            F.col("s.source").eqNullSafe(F.col("q.source")),
        )
        .select("s.*", "rest_blocks")
    )
    shard_quota = apportion(per_shard, ["source"], "shard_size", "rest_blocks", [F.col("shard").asc()], "shard_blocks")
    filled = keys.alias("k").join(
        shard_quota.select("source", "shard", "shard_blocks").alias("s"),
        F.col("k.source").eqNullSafe(F.col("s.source")) & (F.col("k.shard") == F.col("s.shard")),
    ).select("k.*", "shard_blocks")
    order = Window.partitionBy("source", "shard").orderBy("row_key")
    earlier = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.greatest(F.lit(0), F.col("shard_blocks") * block_tokens - earlier)
    filled = filled.withColumn("left", left)
    whole, divided = F.col("left") >= F.col("words"), (F.col("left") > 0) & (F.col("left") < F.col("words"))
    shards = filled.groupBy("source", "shard").agg(
        F.max(F.when(whole, F.col("row_key"))).alias("whole_to"),
        F.max(F.when(divided, F.col("row_key"))).alias("cut_key"),
        F.max(F.when(divided, F.floor(F.col("left") / F.col("copies")))).cast("long").alias("cut_part"),
    )
    return Plan(quotas.drop("rest_blocks"), written(shards, "mix-shards"), seed)


def _with_shard(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` (source, row_key) with their ``shard``."""
    of = sources.select(F.col("source").alias("_s"), F.col("shards").alias("_shards"))
    return rows.join(of, F.col("source").eqNullSafe(F.col("_s"))).withColumn("shard", F.pmod("row_key", "_shards")).drop("_s", "_shards")


def _with_part(rows: DataFrame, made: Plan) -> DataFrame:
    """``rows`` (source, size, row_key) with ``shard``, ``passes`` and ``part``. Both tables of the plan are small
    and written, so Spark sends them to the rows; the rows stay where they are."""
    at = made.shards.select(F.col("source").alias("_s"), F.col("shard").alias("_h"), "whole_to", "cut_key", "cut_part")
    of = made.sources.select(F.col("source").alias("_q"), "passes")
    placed = _with_shard(rows, made.sources)
    placed = placed.join(at, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_h")))
    part = (
        F.when(F.col("row_key") <= F.col("whole_to"), F.col("size"))
        .when(F.col("row_key") == F.col("cut_key"), F.least("size", "cut_part"))
        .otherwise(F.lit(0))
    )
    placed = placed.withColumn("part", part.cast("long")).drop("_s", "_h", "whole_to", "cut_key", "cut_part")
    return placed.join(of, F.col("source").eqNullSafe(F.col("_q"))).drop("_q")


def mix(
    docs: DataFrame, block_tokens: int = 16, shard_rows: int = 4096, seed: int = 17, most_shards: int = 100_000
) -> DataFrame:
    """The mix of ``docs`` (doc_id, text, source), one row per document.

    Returns doc_id, row_key, source, size, source_size, weight, target, quota_blocks, shard, passes
    (whole passes over the document), part (further words taken once, from its beginning), taken.
    """
    sized = written(_sized(docs, seed), "mix-sizes")
    made = _plan(sized, block_tokens, shard_rows, seed, most_shards)
    of = made.sources.select(F.col("source").alias("_q"), "source_size", "weight", "target", "quota_blocks")
    return (
        _with_part(sized, made).join(of, F.col("source").eqNullSafe(F.col("_q")))
        .select("doc_id", "row_key", "source", "size", "source_size", "weight", "target", "quota_blocks", "shard", "passes", "part")
        .withColumn("taken", F.col("passes") * F.col("size") + F.col("part"))
    )


def mixed_documents(docs: DataFrame, made: Plan) -> DataFrame:
    """The rows that the mix takes: each document once per pass, and its first ``part`` words.

    A whole document keeps its text unchanged. A part keeps the text between its words. Rows that
    repeat are taken as often as ``mix`` says of each.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("_text"), "source",
        size_of(F.col("text")).alias("size"), row_key(made.seed).alias("row_key"),
    )
    copies = F.concat(
        F.array_repeat(F.col("size"), F.col("passes").cast("int")),
        F.when(F.col("part") > 0, F.array(F.col("part"))).otherwise(F.array().cast("array<long>")),
    )
    # Cut before each word that follows a separator: a piece is a word and what follows it.
    pieces = F.split("_text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(F.col("_text").rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    cut = F.array_join(F.slice(pieces, F.lit(1), (F.col("_words") + lead).cast("int")), "")
    taken = _with_part(rows, made).filter("size > 0").select("row", "_text", "size", F.explode(copies).alias("_words"))
    text = F.when(F.col("_words") == F.col("size"), F.col("_text")).otherwise(cut)
    taken = taken.withColumn("_text", text)
    out = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return taken.select(*[(out[c] if c in out else F.col("row")[c]).alias(c) for c in docs.columns])

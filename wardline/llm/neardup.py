"""Near-duplicate groups by MinHash with tensored banding.

Each text gets two small collections of sub-keys of ``rows`` minhashes. A table key combines one
sub-key of either collection, so ``bands`` + ``bands`` sub-keys give ``bands``^2 tables of 2 ``rows`` minhashes:
minhash work grows as the square root of the number of tables. Two texts of similarity s share a
table with probability (1 - (1 - s^rows)^bands)^2, 0.9996 at s = 0.8 and 0.999998 at 0.9
(3 rows, 12 bands).

Copies (equal shingle sets) are one class first. A class whose sub-keys nobody shares leaves early; of the
others, only shared sub-keys form table keys. Links are confirmed on full shingle sets:
1. each class is checked against the hub of each of its tables, the class whose sub-keys most classes
   share: of a group of near copies that is one with few changes, alike to most others. Confirmed
   links make components;
2. in each table that still holds several components, members of different components are checked, so
   that no link is lost to the choice of hubs. Members of one component are never paired, tables with the
   same members count once, and a pair meets in the first table that it shares only.
A pair is checked only if sizes and bit maps allow the threshold. A map of 512 bits holds the parity of the
shingles that fall on each bit; maps differ in at most as many bits as sets differ in shingles, so for sets of
up to 512 shingles this excludes no link. Larger sets map a fraction of their shingles, chosen by hash, and
the bound is four standard deviations wider (3 in 100,000 of the links at the threshold itself, fewer above).
No table is gathered in one task: tables are aggregated to their hub and joined back, and joins are
split where they are skewed.

Defined results: null, empty and word-less texts have no shingles and link with nothing; fewer words
than ``k`` are one shingle, the whole sequence; further columns are ignored; rows that repeat get a row
each; an id with several texts has a row and a group for each text, and links none of them; a null id is
no representative: the row takes the component of its class, or null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import partitions, per_text, remove_written, sole_cache, words
from wardline.session import written

CACHE_WORDS = 500_000
MAP_WORDS = 8
MAP_BITS = 64 * MAP_WORDS
MAP = ("level", *(f"bits{i}" for i in range(MAP_WORDS)))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word k-grams."""
    own = words(text)
    if not own:
        return np.zeros(0, "u8")
    if len(_hashes) > CACHE_WORDS:
        _hashes.clear()
    h = np.fromiter(map(_hashes.__getitem__, own), "u8", len(own))
    n = max(1, len(h) - k + 1)
    with np.errstate(over="ignore"):
        out = np.full(n, len(h) if len(h) < k else k, "u8")
        for i in range(min(k, len(h))):
            out = (out ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
    return np.unique(out)


def _copy_of(raw: bytes) -> list[int]:
    """Two hashes of a set: equal for copies."""
    return [xxhash.xxh64_intdigest(raw, seed) - 2**63 for seed in (1, 2)]


def _bit_map(s: np.ndarray) -> tuple[int, list[int]]:
    """Level and bit map of a set: parities of the shingles whose hash ends in ``level`` zero bits."""
    level = 0
    while len(s) >> level > MAP_BITS:
        level += 1
    with np.errstate(over="ignore"):
        h = s * np.uint64(0x9E3779B97F4A7C15)
    h = h[h & np.uint64((1 << level) - 1) == 0]
    odd = np.bincount((h >> np.uint64(64 - 9)).astype("i8"), minlength=MAP_BITS) & 1
    return level, np.packbits(odd.astype("u1")).view("i8").tolist()


def _full_set(text: str | None, k: int) -> tuple:
    s = shingles(text, k)
    level, bits = _bit_map(s)
    raw = s.tobytes()
    return _copy_of(raw), raw, len(s), level, *bits


def signatures(docs: DataFrame, k: int, rows: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, copy (two hashes of the set), left and right sub-keys."""
    count = 2 * rows * bands
    rng = np.random.default_rng(20)
    flips, factors = rng.integers(0, 2**64, (2, count), "u8")
    factors |= np.uint64(1)

    def start():
        sole_cache(_hashes)

        def one(text):
            s = shingles(text, k)
            if not len(s):
                return 0, None, None, None
            raw = s.tobytes()
            with np.errstate(over="ignore"):
                least = np.full(count, 2**64 - 1, "u8")
                for at in range(0, len(s), 2000):
                    x = (s[at : at + 2000, None] ^ flips) * factors
                    least = np.minimum(least, (x ^ (x >> np.uint64(32))).min(0))
                sub = least.reshape(2 * bands, rows)
                key = sub[:, 0].copy()
                for r in range(1, rows):
                    key = (key ^ (sub[:, r] >> np.uint64(7))) * np.uint64(0xD6E8FEB86659FD93) + sub[:, r]
            key = key.view("i8").tolist()
            return len(s), _copy_of(raw), key[:bands], key[bands:]

        return lambda texts: list(zip(*map(one, texts)))

    added = "n_shingles long, copy array<long>, left array<long>, right array<long>"
    return per_text(docs, ["doc_id"], added, start)


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each node reaches. nodes: id; edges: a, b.

    Least labels spread over the links, then each label is replaced by its own label; every round
    is written, so that a lost executor costs one round.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "dup-edges")
    labels = written(
        nodes.join(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")), "id", "left")
        .select("id", F.least("id", F.coalesce("m", "id")).alias("component")),
        "dup-labels",
    )
    while True:
        spread = (
            both.join(labels, F.col("b") == F.col("id")).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m"))
        )
        moved = labels.join(spread, "id", "left").select(
            "id", F.col("component").alias("old"), F.least("component", F.coalesce("m", "component")).alias("c")
        )
        of = labels.select(F.col("id").alias("c"), F.col("component").alias("cc"))
        after = written(
            moved.join(of, "c", "left").select("id", "old", F.least("c", F.coalesce("cc", "c")).alias("component")),
            "dup-labels",
        )
        if after.filter("old != component").isEmpty():
            return after.select("id", "component")
        labels = after.select("id", "component")


def numbered(components: DataFrame, size: int = 128) -> DataFrame:
    """(id, block): blocks of at most ``size`` ids, of one component or neighbouring ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            block = (at + np.arange(batch.num_rows)) // size * size
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(block)], ["id", "block"])

    parts = partitions(components.sparkSession)
    ordered = components.repartitionByRange(parts, "component", "id").sortWithinPartitions("component", "id")
    return written(ordered.select("id").mapInArrow(run, "id long, block long"), "dup-blocks")


def confirmed(pairs: DataFrame, sets: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of their shingle sets, a written table.

    Pairs are dealt by the blocks of their ends; a task loads each set of two blocks once, however
    many pairs it is in.
    """
    blocks = numbered(components)
    of = lambda node, name: blocks.select(F.col("id").alias(node), F.col("block").alias(name))
    dealt = written(pairs.join(of("a", "p"), "a").join(of("b", "q"), "b"), "dup-dealt")
    ends = dealt.select("p", "q", F.col("a").alias("id")).union(dealt.select("p", "q", "b")).distinct()
    loaded = ends.join(sets, "id").select(F.col("p").alias("r"), F.col("q").alias("s"), "id", "shingles")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        own = {i: np.frombuffer(x, "u8") for i, x in zip(right["id"], right["shingles"])}
        keep = []
        for a, b in zip(left["a"].tolist(), left["b"].tolist()):
            x, y = own[a], own[b]
            if len(x) > len(y):
                x, y = y, x
            both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        return left.loc[keep, ["a", "b"]] if len(left) else left[["a", "b"]]

    links = dealt.groupBy("p", "q").cogroup(loaded.groupBy("r", "s")).applyInPandas(run, "a long, b long")
    links = written(links, "dup-links")
    remove_written(dealt, blocks)
    return links


def allowed(x: str, y: str, percent: int) -> Column:
    """Whether sizes and bit maps of two sides leave room for the threshold."""
    small, large = F.least(f"{x}.n", f"{y}.n"), F.greatest(f"{x}.n", f"{y}.n")
    differing = sum(F.bit_count(F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}"))) for b in MAP[1:])
    level = F.col(f"{x}.level")
    most = (small + large) * ((100 - percent) / (100 + percent)) / F.pow(F.lit(2.0), level)
    room = most + F.when(level > 0, 4 * F.sqrt(most)).otherwise(1e-6)
    return (100 * small >= percent * large) & ((level != F.col(f"{y}.level")) | (differing <= room))


def hub_pairs(tables: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of each class and the hubs of its tables: at most one per class and table."""
    hubs = tables.groupBy("bucket").agg(F.max(F.struct("weight", "id")).alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = tables.join(hubs.select("bucket", F.col("hub.id").alias("hub")), "bucket").filter("id != hub").select(
        F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")
    ).distinct()
    x, y = described.alias("x"), described.alias("y")
    return pairs.join(x, F.col("a") == F.col("x.id")).join(y, (F.col("b") == F.col("y.id")) & allowed("x", "y", percent)).select("a", "b")


def mixed_tables(tables: DataFrame, components: DataFrame) -> DataFrame:
    """(bucket, i, j, id, component) of tables that hold several components; of tables with the same
    members only the first by sub-keys (i, j)."""
    placed = tables.select("bucket", "i", "j", "id").join(components, "id")
    own = F.xxhash64("id")
    groups = placed.groupBy("bucket").agg(
        F.min("component").alias("p"), F.max("component").alias("q"), F.min(F.col("i") * 64 + F.col("j")).alias("at"),
        F.count(F.lit(1)).alias("n"), F.bit_xor("id").alias("x"), F.bit_xor(own).alias("y"), F.min(own).alias("z"),
    ).filter("p != q")
    kept = groups.groupBy("n", "x", "y", "z").agg(F.min_by("bucket", "at").alias("bucket")).select("bucket")
    return placed.join(kept, "bucket")


def meeting(mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of mixed tables' rows that the threshold allows, each in the first table it shares only.

    A pair shares a table for each left and each right sub-key it has in common; the first is that of
    the least i and the least j. Sub-keys at different places come from different hash functions.
    """
    x, y = mixed.alias("x"), mixed.alias("y")
    met = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") < F.col("y.component")) & allowed("x", "y", percent)
    for at, side in (("i", "left"), ("j", "right")):
        earlier = F.slice(f"x.{side}", F.lit(1), F.col(f"x.{at}"))
        met &= ~F.arrays_overlap(earlier, f"y.{side}")
    return x.join(y, met).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))


def across_components(tables: DataFrame, components: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) that share a table, lie in different components, and whose sizes and bit maps
    allow the threshold. described: id, n, bit map and all sub-keys (left, right)."""
    mixed = written(mixed_tables(tables, components).join(described, "id"), "dup-mixed")
    pairs = written(meeting(mixed, percent).distinct(), "dup-across")
    remove_written(mixed)
    return pairs


def merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links (a, b) between their members."""
    if links.isEmpty():
        return components
    of = lambda node, name: components.select(F.col("id").alias(node), F.col("component").alias(name))
    ends = written(
        links.join(of("a", "p"), "a").join(of("b", "q"), "b").select(F.col("p").alias("a"), F.col("q").alias("b"))
        .filter("a != b").distinct(),
        "dup-ends",
    )
    joined = connected(ends.select(F.col("a").alias("id")).union(ends.select("b")).distinct(), ends)
    after = joined.select(F.col("id").alias("component"), F.col("component").alias("final"))
    return written(
        components.join(after, "component", "left").select("id", F.coalesce("final", "component").alias("component")),
        "dup-components",
    )


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, rows: int = 3, bands: int = 12) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs`` (doc_id, text)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(signatures(source, k, rows, bands), "dup-signatures")
    # Classes have numbers of their own: an id with two texts is in two classes.
    classes = written(
        signed.filter("n_shingles > 0 and doc_id is not null").groupBy("copy").agg(
            F.min("doc_id").alias("rep"), F.first("left").alias("left"), F.first("right").alias("right")
        ).withColumn("id", F.monotonically_increasing_id()),
        "dup-classes",
    )
    # Sub-keys that at least two classes share; per class the shared ones of either side, and how many
    # classes share them in all.
    sub = classes.select("id", F.posexplode(F.concat("left", "right")).alias("i", "key"))
    shared = sub.groupBy("i", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    alive = (
        sub.join(shared, ["i", "key"]).groupBy("id")
        .agg(
            F.collect_list(F.when(F.col("i") < bands, F.struct("i", "key"))).alias("l"),
            F.collect_list(F.when(F.col("i") >= bands, F.struct("i", "key"))).alias("r"),
            F.sum("n").alias("weight"),
        )
        .filter((F.size("l") > 0) & (F.size("r") > 0))
    )
    tables = written(
        alive.select("id", "weight", F.explode("l").alias("x"), "r").select("id", "weight", "x", F.explode("r").alias("y"))
        .select("id", "weight", F.xxhash64("x", "y").alias("bucket"), F.col("x.i").alias("i"), (F.col("y.i") - bands).alias("j")),
        "dup-tables",
    )
    nodes = written(tables.select("id").distinct(), "dup-nodes")
    reps = classes.select("id", "copy", "rep").join(nodes, "id")
    full = per_text(
        source, ["doc_id"],
        f"copy array<long>, shingles binary, n int, {', '.join(f'{c} long' for c in MAP)}",
        lambda: lambda texts: zip(*(_full_set(t, k) for t in texts)), among=("doc_id", reps.select("rep")),
    )
    # By copy, not by id: an id's other text is another class, and some other ids come along.
    sets = written(full.drop("doc_id").dropDuplicates(["copy"]).join(reps.select("copy", "id"), "copy").drop("copy"), "dup-sets")
    described = sets.select("id", "n", *MAP)
    first = written(hub_pairs(tables, described, percent), "dup-first")
    alone = nodes.select("id", F.col("id").alias("component"))
    components = connected(nodes, confirmed(first, sets, alone, percent))
    keyed = described.join(classes.select("id", "left", "right"), "id")
    rest = across_components(tables, components, keyed, percent).join(first, ["a", "b"], "left_anti")
    components = merged(components, confirmed(written(rest, "dup-rest"), sets, components, percent))
    remove_written(sets, tables)
    grouped = classes.select("copy", "rep", "id").join(components, "id", "left").select(
        "copy", "rep", F.coalesce("component", "id").alias("component")
    )
    smallest = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
    final = grouped.join(smallest, "component").select("copy", "component_id")
    return (
        signed.select("doc_id", "n_shingles", "copy").join(final, "copy", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )

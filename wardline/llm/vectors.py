"""Vector tables: usable rows, and blocks of neighbouring rows for array work inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import partitions, ship
from wardline.session import written


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>): one row per id, all components finite.

    A null id, a null vector and a vector with null or non-finite components take no part. Rows that
    repeat an id count once (the smallest vector).
    """
    ship(rows.sparkSession)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
        .filter(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
    )


def dimension(rows: DataFrame) -> int:
    """Longest vector; shorter ones count as padded with zeros."""
    return rows.agg(F.max(F.size("embedding"))).first()[0] or 0


def matrix(vectors, dim: int) -> np.ndarray:
    """Rows of equal length as float64, padded with zeros."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def sample(rows: DataFrame, size: int, seed: int) -> list:
    """At most ``size`` vectors, in an order fixed by the seed: a bounded set for the driver."""
    picked = rows.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(size)
    return [r[0] for r in picked.select("embedding").collect()]


def centroids(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """At most k centres of a bounded sample: farthest-first starts, then Lloyd rounds."""
    if not len(points):
        return points
    chosen = [0]
    gap = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(k, len(points)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(1))
    centres = points[chosen]
    for _ in range(rounds):
        near = squared(points, centres).argmin(1)
        centres = np.stack([points[near == i].mean(0) if (near == i).any() else c for i, c in enumerate(centres)])
    return centres


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T, 0)


BLOCKS = "block_id long, cell long, low double, high double, n long, ids binary, matrix binary"


def blocks(keyed: DataFrame, dim: int, block_rows: int) -> DataFrame:
    """Cut (cell, place, vec_id, embedding) into blocks of one cell and adjacent places.

    Ranges are split by the id too, so a cell, or a vector that occurs very often, is spread over
    as many tasks as its rows need.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        count = 0

        def block(part: pd.DataFrame):
            nonlocal count
            count += 1
            return {
                "block_id": (TaskContext.get().partitionId() << 32) + count,
                "cell": int(part["cell"].iloc[0]),
                "low": float(part["place"].iloc[0]),
                "high": float(part["place"].iloc[-1]),
                "n": len(part),
                "ids": part["vec_id"].to_numpy("<i8").tobytes(),
                "matrix": matrix(part["embedding"].to_list(), dim).tobytes(),
            }

        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            out, last = [], None
            for _, cell in held.groupby("cell", sort=False):
                if last is not None:
                    out += [block(last[i : i + block_rows]) for i in range(0, len(last), block_rows)]
                last = cell
            while last is not None and len(last) >= block_rows:
                out.append(block(last[:block_rows]))
                last = last[block_rows:]
            held = last
            if out:
                yield pd.DataFrame(out)
        if held is not None and len(held):
            yield pd.DataFrame([block(held)])

    return (
        keyed.repartitionByRange(partitions(keyed.sparkSession), "cell", "place", "vec_id")
        .sortWithinPartitions("cell", "place", "vec_id")
        .mapInPandas(cut, BLOCKS)
    )


def scan(probes: DataFrame, block_table: DataFrame, visit, schema: str, chunk: int = 2048) -> DataFrame:
    """Run ``visit(queries, block)`` for each block and the queries that probe it.

    ``probes`` has block_id, query_id and what visit needs. Queries of a block are dealt into
    groups of about ``chunk`` by hash, so that a task holds one block and one group of queries.
    """
    probes = written(probes, "probes")
    counts = probes.groupBy("block_id").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    dealt = probes.join(counts, "block_id").withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int"))
    copies = (
        block_table.withColumnRenamed("block_id", "block")
        .join(counts.select(F.col("block_id").alias("block"), F.col("chunks").alias("parts")), "block")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )

    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return visit(queries[:0], None)
        return visit(queries, block.iloc[0])

    return dealt.groupBy("block_id", "chunk").cogroup(copies.groupBy("block", "part")).applyInPandas(run, schema)

"""Exact top-k by inner product with a pivot-distance index.

Inner products become distances: with M the largest norm, a vector x is lifted by a further
component sqrt(M^2 - |x|^2), a query q by 0. All lifted vectors have norm M, so
|q - x|^2 = |q|^2 + M^2 - 2 q.x and the nearest are those of the highest product. Vectors are keyed by
(nearest pivot, distance to it) and stored as sorted annuli (blocks of one pivot and adjacent
distances). A query first scans the annulus that it falls into and a few next to it, which gives the
distance of its k-th best so far; by the triangle inequality a vector of pivot p can be nearer only
if its own distance to p is within that radius of the query's, so only those annuli are scanned, and
the search stops there. Nothing is approximate: the bounds carry a margin for rounding.

Defined results: vectors that are null or hold null or non-finite components take no part, nor null
ids; ids that repeat count once; shorter vectors are padded with zeros; equal scores go to the
smaller id; fewer candidates than k give fewer rows; further columns are ignored. Scores are 64-bit
integers and wrap like them beyond.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm import vectors as V
from wardline.session import written

EXACT = 2.0**53  # products and sums below are exact in doubles


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where all sums stay exact, else in 64-bit integers."""
    most = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, queries.shape[1])
    if most < EXACT:
        return (queries @ rows.T).astype("i8")
    return queries.astype("i8") @ rows.astype("i8").T


def top_k(
    table: DataFrame, k: int = 20, every: int = 20, pivots: int = 24, sample_rows: int = 2048,
    block_rows: int = 4096, seed: int = 7,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every`` the k highest
    integer products with all other rows. ``sample_rows`` bounds the sample that pivots come from;
    every row is indexed. Components are floor(64 x)."""
    scaled = V.usable(table).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x * 64).cast("double")).alias("embedding")
    )
    base = written(scaled, "topk-vectors")
    dim = V.dimension(base)
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    most = base.agg(F.max(norm)).first()[0] or 0.0
    points = V.matrix(V.sample(base, sample_rows, seed), dim)
    lifted_sample = np.c_[points, np.sqrt(np.maximum(most - (points**2).sum(1), 0))]
    centres = V.centroids(lifted_sample, pivots)
    slack = 1e-6 * (1 + np.sqrt(most))
    dtype = "<f8"

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x = V.matrix(b["embedding"].to_list(), dim)
            d = V.squared(np.c_[x, np.sqrt(np.maximum(most - (x**2).sum(1), 0))], centres)
            near = d.argmin(1)
            yield b.assign(cell=near.astype("i8"), place=np.sqrt(d[np.arange(len(b)), near]))

    schema = "vec_id long, embedding array<double>, cell long, place double"
    index = written(
        V.blocks(base.mapInPandas(keyed, schema), dim, block_rows), "topk-index"
    )
    # Annuli by place in their pivot's order; a table of one small row per block.
    rings = index.select("block_id", "cell", "low", "high", "n")
    asked = base.filter(F.col("vec_id") % every == 0)

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Distance of each query to each pivot, nearest first."""
        for b in batches:
            if not len(b):
                continue
            q = V.matrix(b["embedding"].to_list(), dim)
            d = np.sqrt(V.squared(np.c_[q, np.zeros(len(q))], centres))
            place = d.argsort(1).argsort(1)
            ids, n = b["vec_id"].to_numpy(), d.shape[1]
            yield pd.DataFrame({
                "query_id": np.repeat(ids, n), "cell": np.tile(np.arange(n), len(b)),
                "d": d.ravel(), "nth": place.ravel(), "norm": np.repeat((q**2).sum(1), n),
            })

    distances = written(
        asked.mapInPandas(reach, "query_id long, cell long, d double, nth long, norm double"), "topk-reach"
    )
    query_rows = asked.select(F.col("vec_id").alias("query_id"), "embedding")
    output = "query_id long, vec_id long, score long"

    def visit(queries: pd.DataFrame, block) -> pd.DataFrame:
        if block is None:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("i8")
        ids = np.frombuffer(block["ids"], "<i8")
        x = np.frombuffer(block["matrix"], dtype).reshape(len(ids), dim)
        found = []
        for i in range(0, len(queries), 256):
            part = queries.iloc[i : i + 256]
            own, least = part["query_id"].to_numpy("i8"), part["least"].to_numpy("i8")
            score = _products(V.matrix(part["embedding"].to_list(), dim), x)
            for r in range(len(part)):
                hit = np.flatnonzero((score[r] >= least[r]) & (ids != own[r]))
                if len(hit) > k:
                    hit = hit[np.lexsort((ids[hit], -score[r][hit]))[:k]]
                found.append((np.full(len(hit), own[r]), ids[hit], score[r][hit]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*found)))))

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    # Start: in the nearest pivot's cell, the annuli closest to the query that hold k others.
    gap = F.greatest(F.lit(0.0), F.col("low") - F.col("d"), F.col("d") - F.col("high"))
    nearest = Window.partitionBy("query_id").orderBy("nth", "gap", "block_id")
    seen = F.coalesce(F.sum("n").over(nearest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = (
        distances.filter("nth < 2").join(rings, "cell").withColumn("gap", gap)
        .withColumn("seen", seen).filter(F.col("seen") <= k)
        .select("query_id", "block_id")
    )
    first = written(first, "topk-first")
    lowest = -(2**63)
    start = written(
        V.scan(first.join(query_rows, "query_id").withColumn("least", F.lit(lowest)), index, visit, output)
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k),
        "topk-start",
    )
    bound = start.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    radius = F.sqrt(F.greatest(F.lit(0.0), F.col("norm") + most - 2.0 * F.col("least").cast("double"))) + slack
    wanted = (
        distances.join(bound, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(lowest)))
        .withColumn("radius", F.when(F.col("least") == lowest, float("inf")).otherwise(radius))
    )
    rest = (
        wanted.join(rings, "cell")
        .filter((F.col("low") <= F.col("d") + F.col("radius")) & (F.col("high") >= F.col("d") - F.col("radius")))
        .select("query_id", "block_id", "least")
        .join(first, ["query_id", "block_id"], "left_anti")
    )
    more = V.scan(rest.join(query_rows, "query_id"), index, visit, output)
    return (
        start.select("query_id", "vec_id", "score").unionByName(more)
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

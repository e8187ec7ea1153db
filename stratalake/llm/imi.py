"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves and each half is quantised with its own codebook, so a pair of centroids is a cell of
a fine grid. A query walks the grid by rising sum of its two centroid distances, kept in a heap, until the cells it
has passed hold a given share of the vectors; those are ranked by their true distance.

The codebooks are learned from a bounded sample; every vector is indexed. Cells with the same first centroid
are stored together and cut into blocks of bounded size, queries as well; each pair of blocks is one task's work.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import staged

K = 10
CENTROIDS = 64
SAMPLE_ROWS = 20_000
SHARE = 0.5
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
_FOUND = "query_id long, vec_id long, score double"


def k_means(points: np.ndarray, centroids: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Lloyd's rounds from random distinct points; a centroid that loses all points stays where it is."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centers = distinct[rng.permutation(len(distinct))[:centroids]].copy()
    for _ in range(rounds):
        nearest = _nearest(points, centers)
        n = np.bincount(nearest, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, points)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


def _nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(axis=1) - 2 * points @ centers.T, axis=1)


@dataclass
class Grid:
    """Two codebooks, and the number of vectors in each cell."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray | None = None

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two halves of each vector, for the cut between the codebooks' dimensions."""
        return x[:, : self.first.shape[1]], x[:, self.first.shape[1] :]

    def walk(self, a: np.ndarray, b: np.ndarray, wanted: int) -> np.ndarray:
        """Cells by rising ``a[i] + b[j]`` until they hold ``wanted`` vectors, as a boolean grid.

        ``a`` and ``b`` are a query's squared distances to the two codebooks. The heap holds the next
        unvisited cell of every opened row of the sorted grid.
        """
        rows, cols = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        a, b = a[rows].tolist(), b[cols].tolist()
        counts = self.counts[rows][:, cols].tolist()
        passed = np.zeros(self.counts.shape, bool)
        heap, have = [(a[0] + b[0], 0, 0)], 0
        taken: list[tuple[int, int]] = []
        while heap and have < wanted:
            _, i, j = heapq.heappop(heap)
            taken.append((i, j))
            have += counts[i][j]
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
            if j + 1 < len(b):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        at = np.array(taken)
        passed[rows[at[:, 0]], cols[at[:, 1]]] = True
        return passed


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def _best(query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and true distances of the k nearest by ``rough`` squared distances, ties to the smaller id."""
    if len(rough) > k:
        border = np.partition(rough, k - 1)[k - 1]
        # the expanded squares cancel, so their error grows with the norms, not with the distance
        slack = 1e-12 * ((query**2).sum() + (vectors**2).sum(axis=1).max())
        near = np.flatnonzero(rough <= border + slack)
        ids, vectors = ids[near], vectors[near]
    exact = np.sqrt(((vectors - query) ** 2).sum(axis=1))
    order = np.lexsort((ids, exact))[:k]
    return ids[order], exact[order]


def search(
    vectors: DataFrame,
    is_query: str,
    k: int = K,
    centroids: int = CENTROIDS,
    share: float = SHARE,
    sample_rows: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k nearest found for each query row: ``query_id, rank, vec_id, score`` (Euclidean distance, from 1).

    ``vectors`` has ``vec_id, embedding``; rows for which the SQL condition ``is_query`` holds are queries
    against all other ids. Null, zero and non-finite vectors, vectors with null components or of another length
    than most, and rows without id take no part. A query id that repeats is asked once, by its least
    vector; other rows that repeat an id are candidates once per row. Ties go to the smaller id; with fewer than k candidates all are returned; an empty table gives no rows. The codebooks
    come from at most ``sample_rows`` vectors, drawn by a hash of the id.
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
    usable = usable.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    lengths = usable.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if lengths is None:
        return empty
    usable = usable.where(F.size("embedding") == lengths.d)
    drawn = usable.orderBy(F.xxhash64(F.lit("codebook"), "vec_id"), "vec_id").limit(sample_rows).select("embedding").toPandas()
    sample = _matrix(drawn["embedding"])
    cut = lengths.d // 2 if lengths.d > 1 else 1
    grid = Grid(k_means(sample[:, :cut], centroids), k_means(sample[:, cut:], centroids))
    books = spark.sparkContext.broadcast(grid)  # two codebooks

    @F.pandas_udf("struct<i: int, j: int>")
    def cell(embeddings: pd.Series) -> pd.DataFrame:
        if not len(embeddings):
            return pd.DataFrame({"i": pd.Series(dtype="int32"), "j": pd.Series(dtype="int32")})
        left, right = books.value.halves(_matrix(embeddings))
        return pd.DataFrame({"i": _nearest(left, books.value.first), "j": _nearest(right, books.value.second)})

    indexed = staged(usable.withColumn("cell", cell("embedding")).select("vec_id", "embedding", "cell.i", "cell.j"), "index")
    counts = np.zeros((len(grid.first), len(grid.second)), np.int64)
    for r in indexed.groupBy("i", "j").count().collect():  # at most one row per cell of the grid
        counts[r.i, r.j] = r["count"]
    queries = indexed.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("query"))
    asked = queries.count()
    if asked == 0:
        return empty
    wanted = max(k + 1, math.ceil(share * counts.sum()))
    full = spark.sparkContext.broadcast(Grid(grid.first, grid.second, counts))
    parts = max(1, math.ceil(asked / query_rows))
    blocks = [max(1, math.ceil(n / block_rows)) for n in counts.sum(axis=1).tolist()]

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The cells of each query, by first centroid."""
        known = full.value
        for batch in batches:
            for query_id, vector in zip(batch["query_id"], batch["query"]):
                left, right = known.halves(np.asarray(vector, np.float64)[None, :])
                a, b = ((known.first - left) ** 2).sum(axis=1), ((known.second - right) ** 2).sum(axis=1)
                passed = known.walk(a, b, wanted)
                rows = np.flatnonzero(passed.any(axis=1))
                yield pd.DataFrame({
                    "query_id": query_id, "query": [vector] * len(rows), "i": rows.astype(np.int32),
                    "cells": [np.flatnonzero(passed[r]).astype(np.int32) for r in rows],
                })

    probes = queries.mapInPandas(probe, "query_id long, query array<double>, i int, cells array<int>")
    per_row = F.element_at(F.array(*[F.lit(b) for b in blocks]), F.col("i") + 1)
    probes = probes.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts))).withColumn("block", F.explode(F.sequence(F.lit(0), per_row - 1)))
    held = indexed.withColumn("block", F.pmod(F.xxhash64("vec_id"), per_row).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    )

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, cells, x = right["vec_id"].to_numpy(), right["j"].to_numpy(), _matrix(right["embedding"])
            q = _matrix(left["query"])
            rough = (q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1) - 2 * q @ x.T
            for n, (query_id, wanted_cells) in enumerate(zip(left["query_id"], left["cells"])):
                use = np.flatnonzero(np.isin(cells, wanted_cells) & (ids != query_id))
                found, scores = _best(q[n], ids[use], x[use], rough[n, use], k)
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": found, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    key = ["i", "block", "part"]
    found = probes.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(rerank, _FOUND)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Exact nearest neighbours by cosine.

Both sides are cut into blocks by a hash of the id and each pair of blocks is one task, which holds one block of
either side; a matrix product keeps k rows per query and a grouped top k reduces them. A query set below the block
size is one block, so the vectors move once. With ``within`` only rows of one group meet, and a large group is
cut like a whole table.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.dedup import top_k_per_key

# the tasks get this module's functions with the job, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERY_BLOCK_ROWS = 16_384
VECTOR_BLOCK_ROWS = 8192
_STEP = 512


@dataclass(frozen=True)
class _Scoring:
    k: int
    exclude_self: bool
    places: int
    guard: float

    def top(self, q_ids: np.ndarray, q: np.ndarray, v_ids: np.ndarray, v: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """Query ids, vector ids and scores of the k best vectors of one block for each query."""
        place = np.empty(len(v_ids), np.int64)
        place[np.argsort(v_ids, kind="stable")] = np.arange(len(v_ids))  # ids may be of any type that sorts
        out = []
        for at in range(0, len(q), _STEP):
            part, ids = q[at : at + _STEP], q_ids[at : at + _STEP]
            norms = np.outer(np.linalg.norm(part, axis=1), np.linalg.norm(v, axis=1))
            scores = np.round(part @ v.T / (norms + self.guard), self.places)
            if self.exclude_self:
                scores[ids[:, None] == v_ids[None, :]] = -np.inf
            scores[~np.isfinite(scores)] = -np.inf
            for query_id, row in zip(ids, scores):
                best = _best(row, place, self.k)
                best = best[np.isfinite(row[best])]
                out.append((np.full(len(best), query_id, ids.dtype), v_ids[best], row[best]))
        return out


def _best(scores: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, the smaller id first among equals."""
    if len(scores) > k:
        border = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= border)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((place[near], -scores[near]))][:k]


def _matrix(vectors) -> np.ndarray:
    return np.stack(list(vectors)).astype(np.float64)


def finite(vector: Column) -> Column:
    """Whether no component is null, NaN or infinite; false for a null vector."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(whole, F.lit(False))


def knn(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    exclude_self: bool = False,
    places: int = 6,
    guard: float = 1e-9,
    within: Sequence[str] = (),
    query_rows: int = QUERY_BLOCK_ROWS,
    vector_rows: int = VECTOR_BLOCK_ROWS,
) -> DataFrame:
    """The k most similar vectors of every query as ``query_id, vec_id, score, rank`` (J-9).

    Both inputs have ``id, vector`` with unique ids of one type, and the columns ``within`` whose values must be
    equal (null meets null). Scores are rounded to ``places`` before they are ranked, equal scores go by id.
    ``exclude_self`` leaves out the row with the query's own id. Vectors that are null or hold null, NaN or
    infinite components take no part.
    """
    within = list(within)
    queries, vectors = (
        df.where(F.col("id").isNotNull() & finite(F.col("vector"))).select("id", "vector", *within) for df in (queries, vectors)
    )
    schema = f"query_id {dict(queries.dtypes)['id']}, vec_id {dict(vectors.dtypes)['id']}, score double"
    scoring = _Scoring(k, exclude_self, places, guard)

    def blocks_of(df: DataFrame, rows: int) -> int:
        """Blocks that keep the largest group's parts below ``rows``."""
        largest = df.groupBy(*within).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        return max(1, -(-largest // rows))

    query_blocks, vector_blocks = blocks_of(queries, query_rows), blocks_of(vectors, vector_rows)
    key = [*within, "_qb", "_vb"]

    def cut(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.lit(n)).alias(own)
        return df.select("id", "vector", *within, block, F.explode(F.expr(f"sequence(0L, {m - 1}L)")).alias(other))

    def score_cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        q_ids, v_ids = left["id"].to_numpy(), right["id"].to_numpy()
        found = [(q_ids[:0], v_ids[:0], np.zeros(0))]
        if len(left) and len(right):
            found += scoring.top(q_ids, _matrix(left["vector"]), v_ids, _matrix(right["vector"]))
        columns = [np.concatenate(c) for c in zip(*found)]
        return pd.DataFrame({n: pd.Series(c, dtype=c.dtype) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    left = cut(queries, "_qb", query_blocks, "_vb", vector_blocks).groupBy(*key)
    right = cut(vectors, "_vb", vector_blocks, "_qb", query_blocks).groupBy(*key)
    partial = left.cogroup(right).applyInPandas(score_cell, schema)
    return top_k_per_key(partial, ["query_id"], [F.desc("score"), "vec_id"], k, rank_as="rank")


def centroids(vectors: DataFrame, label: str) -> DataFrame:
    """Mean vector per label as ``id, vector``; each task sums its own vectors first."""
    mean = Summarizer.mean(array_to_vector(F.col("vector")))
    grouped = vectors.where("vector IS NOT NULL").groupBy(F.col(label).cast("long").alias("id"))
    return grouped.agg(vector_to_array(mean).alias("vector"))

"""One row, or the top k rows, per key.

``row_number() <= k`` is the shape for which Spark plans a WindowGroupLimit before the shuffle: every
map task keeps at most k rows of a key, so a key that holds a third of all rows never lands whole in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_columns(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    k: int,
    rank_as: str | None = None,
) -> DataFrame:
    """First ``k`` rows of every key in the given order; ``rank_as`` keeps the 1-based rank (W-2)."""
    rank = rank_as or "_rank"
    window = Window.partitionBy(*keys).orderBy(*_as_columns(order_by))
    out = df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
    return out if rank_as else out.drop(rank)


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    keep: str = "first",
) -> DataFrame:
    """Earliest row per key (W-1); ``keep="any"`` takes whichever comes first (W-3).

    Ties are broken by a hash of the whole row, so the result does not depend on task order.
    """
    if keep == "any":
        return df.dropDuplicates(list(keys))
    if keep != "first":
        raise ValueError(f"keep must be 'first' or 'any', got {keep!r}")
    return top_k_per_key(df, keys, [*order_by, F.xxhash64(*df.columns)], 1)

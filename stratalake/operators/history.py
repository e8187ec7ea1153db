"""Neighbouring rows and validity intervals per key.

A plain ``lag`` sorts a whole key in one task. With ``slice_of`` (any expression that never falls as the
order rises, such as the day) the window runs per key and slice; only one edge row per slice crosses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    columns: Sequence[str],
    into: str,
    ahead: bool = False,
    slice_of: Column | None = None,
) -> DataFrame:
    """Struct ``into`` with ``columns`` of the previous (or next) row of the key; NULL at the end."""
    keys, order_by = list(keys), list(order_by)
    shift = F.lead if ahead else F.lag
    row = F.struct(*columns)
    if slice_of is None:
        return df.withColumn(into, shift(row).over(Window.partitionBy(*keys).orderBy(*order_by)))
    # one struct for key and slice: never NULL itself, so a plain equi join also matches NULL keys and
    # finds the rows already partitioned by the window below it
    sliced = df.withColumn("_slice", F.struct(*keys, slice_of.alias("_at")))
    edge = F.min_by if ahead else F.max_by
    edges = sliced.groupBy("_slice").agg(edge(row, F.struct(*order_by)).alias("_edge"))
    by_key = [F.col("_slice")[k] for k in keys]
    across = shift("_edge").over(Window.partitionBy(*by_key).orderBy(F.col("_slice")["_at"]))
    edges = edges.select("_slice", across.alias("_carried"))
    inner = shift(row).over(Window.partitionBy("_slice").orderBy(*order_by))
    joined = sliced.withColumn("_near", inner).join(edges, "_slice", "left")
    return joined.select(*df.columns, F.coalesce("_near", "_carried").alias(into))


def scd2_intervals(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    state: Sequence[str],
    ts: str,
    slice_of: Column | None = None,
) -> DataFrame:
    """Change feed → one row per run of equal ``state`` with ``valid_from, valid_to, is_current`` (C-3)."""
    seen = neighbour(df, keys, order_by, state, "_before", slice_of=slice_of)
    moved = seen.where(~F.struct(*state).eqNullSafe(F.col("_before"))).drop("_before")
    closed = neighbour(moved, keys, order_by, [ts], "_after", ahead=True, slice_of=slice_of)
    valid_to = F.col("_after")[ts]
    return closed.select(
        *keys,
        *state,
        F.col(ts).alias("valid_from"),
        valid_to.alias("valid_to"),
        F.col("_after").isNull().alias("is_current"),
    )

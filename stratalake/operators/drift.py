"""Change of a score's distribution between two periods (M-24)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.measures import rounded
from stratalake.sources.parquet import staged

CELLS = 1000
LEAST_SHARE = 1e-4


def distribution_drift(
    rows: DataFrame, keys: Sequence[str], score: str, late: Column, bins: int = 10, lowest: float = 0.0, highest: float = 1.0
) -> DataFrame:
    """``keys, scores_before, scores_after, ks, psi`` of every key.

    ``ks`` is the two-sample Kolmogorov-Smirnov distance, the largest difference of the two cumulative shares;
    ``psi`` the population stability index over ``bins`` equal ranges, an empty range counting as ``LEAST_SHARE``.
    Scores beyond ``lowest`` and ``highest`` fall into the outer ranges. Null and NaN scores and rows without a
    period are left out; a key with one period only has null measures; null keys are one key.

    Equal scores are counted before the shuffle. Cumulative counts are sums within a cell of scores plus the sums of
    the cells before, so no task sorts all scores of a key.
    """
    keys = list(keys)
    valid = rows.where(F.col(score).isNotNull() & ~F.isnan(score) & late.isNotNull())
    counted = valid.groupBy(*keys, F.col(score).cast("double").alias("_score")).agg(
        F.count_if(~late).alias("_before"), F.count_if(late).alias("_after")
    )
    place = (F.col("_score") - lowest) / (highest - lowest)
    last = {"_cell": CELLS, "_bin": bins}
    counted = staged(
        counted.withColumns({n: F.greatest(F.lit(0), F.least(F.lit(k - 1), F.floor(place * k))).cast("int") for n, k in last.items()}), "scores"
    )
    sums = [F.sum(c).alias(c) for c in ("_before", "_after")]
    cells = counted.groupBy(*keys, "_cell").agg(*sums)
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    starts = cells.select(
        *keys, "_cell",
        *[F.coalesce(F.sum(f"_{p}").over(earlier), F.lit(0)).alias(f"_{p}_start") for p in ("before", "after")],
        *[F.sum(f"_{p}").over(whole).alias(f"_{p}_all") for p in ("before", "after")],
    )
    inside = Window.partitionBy(*keys, "_cell").orderBy("_score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = counted.select(*keys, "_cell", *[F.sum(f"_{p}").over(inside).alias(f"_{p}_in") for p in ("before", "after")])
    met = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in [*keys, "_cell"]]
    placed = inner.join(starts.withColumnsRenamed({k: f"_k_{k}" for k in [*keys, "_cell"]}), met)
    before, after = (F.try_divide(F.col(f"_{p}_start") + F.col(f"_{p}_in"), F.col(f"_{p}_all")) for p in ("before", "after"))
    distance = placed.groupBy(*keys).agg(
        F.max("_before_all").alias("scores_before"), F.max("_after_all").alias("scores_after"), rounded(F.max(F.abs(before - after)), 6).alias("ks")
    )
    binned = counted.groupBy(*keys, "_bin").agg(*sums)
    shares = binned.select(
        *keys, *[F.greatest(F.try_divide(F.col(f"_{p}"), F.sum(f"_{p}").over(whole)), F.lit(LEAST_SHARE)).alias(f"_{p}") for p in ("before", "after")]
    )
    term = (F.col("_after") - F.col("_before")) * F.ln(F.col("_after") / F.col("_before"))
    index = shares.groupBy(*keys).agg(rounded(F.sum(term), 6).alias("_psi")).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    met = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    both = (F.col("scores_before") > 0) & (F.col("scores_after") > 0)
    return distance.join(index, met).select(
        *keys, "scores_before", "scores_after", F.when(both, F.col("ks")).alias("ks"), F.when(both, F.col("_psi")).alias("psi")
    )

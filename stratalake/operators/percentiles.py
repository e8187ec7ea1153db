"""Exact interpolated percentiles that never gather a large group in one task.

The built-in ``percentile`` holds every distinct value of a group in one buffer. So equal values are counted
first (shuffled on group *and* value, which spreads a hot group) and the counts are staged. If no group
has more than ``in_memory`` distinct values, the built-in finishes on the counts. Otherwise the value of a
wanted rank is found by narrowing:

1. values fall into logarithmic bins, whose number is bounded by the range of a double;
2. the bin that holds the wanted rank is cut into equal cells between its least and its largest value and the cell
   that holds the rank is picked, again and again while the cell has more values than one task may order;
3. only the values of that cell are ordered.

Every step is a partial aggregation or an equi join with the few picked bins. Nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.joins import null_safe_join
from stratalake.sources.parquet import staged

# bins per unit of log1p(|value|): a bin spans about 0.1 % of the value
_BINS = 1024
_CELLS = 4096
_TOP_BIN = 2_000_000
# distinct values of one group that may share a buffer
IN_MEMORY = 100_000
# distinct values of one cell that may be put in order by one task
ORDERED = 10_000


def _bin(v: Column) -> Column:
    magnitude = F.floor(F.log1p(F.abs(v)) * F.lit(_BINS))
    infinite = F.abs(v) == F.lit(float("inf"))
    signed = F.when(v < 0, -magnitude).otherwise(magnitude)
    return (
        F.when(F.isnan(v), F.lit(_TOP_BIN + 1))
        .when(infinite, F.when(v < 0, F.lit(-_TOP_BIN)).otherwise(F.lit(_TOP_BIN)))
        .otherwise(signed)
        .cast("long")
    )


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    wanted: Mapping[str, tuple[str, float]],
    in_memory: int = IN_MEMORY,
    ordered: int = ORDERED,
) -> DataFrame:
    """One row per group with ``keys`` and one double per entry of ``wanted`` (A-8).

    ``wanted`` maps a result name to a numeric column and a fraction. NULLs are left out; a group without
    any value has no row. Runs a job: the counted values are written to the shared folder, so the input
    is read once whatever number of columns is asked for.
    """
    columns = sorted({c for c, _ in wanted.values()})
    values = F.array(*[F.struct(F.lit(c).alias("_col"), (F.col(c).cast("double") + 0.0).alias("_v")) for c in columns])
    by = list(keys) or ["_all"]
    tall = df.select(*(keys or [F.lit(1).alias("_all")]), F.inline(values)).where(F.col("_v").isNotNull())
    counted = staged(tall.groupBy(*by, "_col", "_v").agg(F.count(F.lit(1)).alias("_n")), "counted")
    sizes = counted.groupBy(*by, "_col").agg(F.count(F.lit(1)).alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= in_memory:
        points = [
            F.percentile(F.when(F.col("_col") == c, F.col("_v")), float(p), F.col("_n")).alias(name)
            for name, (c, p) in wanted.items()
        ]
        out = counted.groupBy(*by).agg(*points)
    else:
        out = _narrowed(counted, by, wanted, ordered)
    return out if keys else out.drop("_all")


def _narrowed(counted: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[str, float]], ordered: int) -> DataFrame:
    by = [*keys, "_col"]
    counted = counted.withColumn("_bin", _bin(F.col("_v")))
    bins = counted.groupBy(*by, "_bin").agg(
        F.sum("_n").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    group = Window.partitionBy(*by)
    upto = group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("_end", F.sum("_n").over(upto)).withColumn("_total", F.sum("_n").over(group))

    asks = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(c).alias("col"), F.lit(float(p)).alias("p"), F.lit(up).alias("up"))
            for name, (c, p) in wanted.items()
            for up in (False, True)
        ]
    )
    pos = F.col("_ask.p") * (F.col("_total") - 1)
    rank = F.when(F.col("_ask.up"), F.ceil(pos)).otherwise(F.floor(pos))
    start = F.col("_end") - F.col("_n")
    ask_key = ["_name", "_up"]
    picked = (
        bins.withColumn("_ask", F.explode(asks))
        .where(F.col("_ask.col") == F.col("_col"))
        .withColumn("_rank", rank)
        .where((F.col("_rank") >= start) & (F.col("_rank") < F.col("_end")))
        .select(
            *by,
            "_bin",
            F.col("_ask.name").alias("_name"),
            F.col("_ask.up").alias("_up"),
            (F.col("_rank") - start).alias("_rank"),
            (pos - F.floor(pos)).alias("_frac"),
            "_lo",
            "_hi",
        )
    )

    ask = [*by, *ask_key]
    inside = staged(null_safe_join(counted, picked.drop("_lo", "_hi"), [*by, "_bin"]).select(*ask, "_v", "_n", "_rank", "_frac"), "inside")
    while True:
        ends = staged(
            inside.groupBy(*ask).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_values")), "ends"
        )
        if (ends.agg(F.max("_values")).first()[0] or 0) <= ordered:
            break
        inside = staged(_one_cell(inside, ends, ask), "inside")

    upto = Window.partitionBy(*ask).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = inside.withColumn("_end", F.sum("_n").over(upto)).where(
        (F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_n"))
    )

    def pick(name: str, up: bool, col: str) -> Column:
        return F.max(F.when((F.col("_name") == name) & (F.col("_up") == F.lit(up)), F.col(col)))

    def interpolated(name: str) -> Column:
        low, high, frac = pick(name, False, "_v"), pick(name, True, "_v"), pick(name, False, "_frac")
        return F.when(frac == 0, low).otherwise(low * (1 - frac) + high * frac)

    return found.groupBy(*keys).agg(*[interpolated(name).alias(name) for name in wanted])


def _one_cell(inside: DataFrame, ends: DataFrame, ask: Sequence[str]) -> DataFrame:
    """The values of the cell that holds the wanted rank, with the rank inside it.

    The least and the largest value fall into different cells, so every round gets on.
    """
    width = F.col("_hi") - F.col("_lo")
    cell = F.least(F.floor((F.col("_v") - F.col("_lo")) / width * _CELLS), F.lit(_CELLS - 1))
    marked = null_safe_join(inside, ends, ask).withColumn("_cell", F.when(width > 0, cell).otherwise(F.lit(0)).cast("long"))
    cells = marked.groupBy(*ask, "_cell").agg(F.sum("_n").alias("_m"), F.first("_rank").alias("_r"))
    upto = Window.partitionBy(*ask).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("_end") - F.col("_m")
    cells = cells.withColumn("_end", F.sum("_m").over(upto)).where((F.col("_r") < F.col("_end")) & (F.col("_r") >= start))
    cells = cells.select(*ask, "_cell", (F.col("_r") - start).alias("_rest"))
    kept = null_safe_join(marked, cells, [*ask, "_cell"])
    return kept.select(*ask, "_v", "_n", F.col("_rest").alias("_rank"), "_frac")


def percentile_columns(value: str, wanted: Mapping[str, float], exact: bool = True) -> list[Column]:
    """Aggregate columns for values of a small, known domain, or approximate ones (A-8, A-9)."""
    if exact:
        return [F.percentile(value, float(p)).alias(name) for name, p in wanted.items()]
    return [F.percentile_approx(value, float(p)).alias(name) for name, p in wanted.items()]

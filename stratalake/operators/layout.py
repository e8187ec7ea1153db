"""Physical layout: file sizes, clustering, file ranges and pruning."""

from __future__ import annotations

import math
import os.path
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def coalesce_to_size(df: DataFrame, files: int) -> DataFrame:
    """Merge the scan's splits into ``files`` outputs without a shuffle (P-1).

    Spark already packs small files into splits; when there are fewer splits than wanted files, the rows
    are spread instead.
    """
    return df.coalesce(files) if df.rdd.getNumPartitions() >= files else df.repartition(files)


def cluster(df: DataFrame, cols: Sequence[str], files: int, within: Sequence[str] = ()) -> DataFrame:
    """Range-partition and sort by one column (P-2) or by the Z-value of several (P-3).

    ``within`` names the partition columns of the table: they lead the range key, so that a task writes
    to few partitions. A hash of the row ends the key, so a value that holds a third of all rows is spread
    over several files and still stays together in range.
    """
    # cells several times finer than files, whatever their number
    bits = max(4, math.ceil((math.log2(max(files, 1)) + 4) / len(cols)))
    order = F.col(cols[0]) if len(cols) == 1 else z_value(df, cols, bits)
    marked = df.withColumn("_z", order)
    spread = marked.repartitionByRange(files, *within, "_z", F.xxhash64(*df.columns))
    return spread.sortWithinPartitions(*within, "_z").drop("_z")


def z_value(df: DataFrame, cols: Sequence[str], bits: int) -> Column:
    """Interleaved bits of the rank bucket of each column.

    Buckets are cut at approximate quantiles, which balances them and moves at most ``2**bits`` numbers
    per column through the driver. They steer only where rows are stored, never which rows exist. One
    pass finds the cuts of all columns; text columns need one more for their common prefixes.
    """
    numbers = _as_numbers(df, cols)
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(n, steps, 10_000) for n in numbers]).first()
    z = F.lit(0).cast("long")
    for i, (number, found) in enumerate(zip(numbers, cuts)):
        bucket = _cuts_below(found or [], number)
        for bit in range(bits):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(one, bit * len(cols) + i))
    return z


def _cuts_below(cuts: Sequence[float], number: Column) -> Column:
    bounds = F.array(*[F.lit(float(c)) for c in sorted(set(cuts))]).cast("array<double>")
    return F.size(F.filter(bounds, lambda b: b < number)).cast("long")


def _as_numbers(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Each column as a double that keeps its order; text by the six bytes after its common prefix."""
    texts = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    ends = df.agg(*[e for c in texts for e in (F.min(c), F.max(c))]).first() if texts else ()
    prefix = {c: _shared(ends[2 * i], ends[2 * i + 1]) for i, c in enumerate(texts)}
    return [_as_number(df, c, prefix.get(c, 0)) for c in cols]


def _shared(low: str | None, high: str | None) -> int:
    """Bytes that all values between ``low`` and ``high`` start with."""
    return len(os.path.commonprefix([(low or "").encode(), (high or "").encode()]))


def _as_number(df: DataFrame, name: str, skip: int) -> Column:
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.StringType):
        raw = F.expr(f"substring(encode(`{name}`, 'UTF-8'), {skip + 1}, 6)")
        return F.conv(F.rpad(F.hex(raw), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return col.cast("double")


def file_stats(scan: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows and min/max of ``cols`` per file; ``scan`` must be a direct file scan (P-4)."""
    ranges = [e for c in cols for e in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
    return scan.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), *ranges
    )


def pruned_ratio(stats: DataFrame, column: str, value) -> DataFrame:
    """Files, files whose range covers ``value`` and their ratio (P-5)."""
    covers = (F.col(f"min_{column}") <= F.lit(value)) & (F.col(f"max_{column}") >= F.lit(value))
    return stats.agg(F.count(F.lit(1)).alias("files"), F.count_if(covers).alias("covering")).withColumn(
        "ratio", F.col("files") / F.greatest(F.col("covering"), F.lit(1))
    )

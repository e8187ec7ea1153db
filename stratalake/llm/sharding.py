"""Shards of near equal bytes by sampled splitters (DataFrame functions only).

The sort key is a hash of the text, so equal texts lie together. Keys are sampled in proportion to size, the
quantiles of the sample are the range boundaries, and the ranges are measured. A text whose copies hold more
than a small part of a shard would overfill its range: its rows are dealt to sub-ranges and may be cut at any row.
All other groups of equal texts stay in one shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import bucket_of, staged, whole_text

SHARDS = 40
RANGES_PER_SHARD = 4
SAMPLES_PER_RANGE = 16
PARTS_PER_SHARD = 64
OVERHEAD = 16
DRAW_SEED = 8


def splitters(rows: DataFrame, total: int, ranges: int, samples: int = SAMPLES_PER_RANGE) -> list[int]:
    """Quantile cuts of keys drawn in proportion to size.

    A row is drawn with probability ``size / step``, by its own random number, so the expected sample is
    ``ranges * samples`` keys whatever the table and however many rows are equal; the largest rows are drawn
    with certainty and count once.
    """
    step = max(1.0, total / (ranges * samples))
    keys = sorted(r.key for r in rows.where(F.col("draw") < F.col("size") / F.lit(step)).select("key").collect())
    return sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, key, draw`` of every row, staged; ``draw`` is a random number of the row, stored once."""
    text = whole_text()
    return staged(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.rand(DRAW_SEED).alias("draw"),
        ),
        "sizes",
    )


def ranged(rows: DataFrame, total: int, shards: int, ranges_per_shard: int, parts_per_shard: int) -> DataFrame:
    """Measured rows with their range between sampled splitters, staged; ``cut`` groups are dealt to sub-ranges ``sub``.

    A sub-range gets about ``1 / parts_per_shard`` of a shard. Rows are dealt to them by their random number, so a
    group is cut even if all its rows are equal or have no id.
    """
    part = max(1.0, total / (shards * parts_per_shard))
    # at most shards * parts_per_shard groups can be this large
    large = staged(rows.groupBy("key").agg(F.sum("size").alias("group_size")).where(F.col("group_size") > F.lit(part)), "large")
    cuts = splitters(rows, total, shards * ranges_per_shard)
    return staged(
        rows.join(F.broadcast(large), "key", "left").select(
            "doc_id", "size", "text_crc32", "key", F.col("group_size").isNotNull().alias("cut"),
            bucket_of(F.col("key"), cuts).alias("range"),
            F.when(F.col("group_size").isNull(), F.lit(0))
            .otherwise(1 + F.floor(F.col("draw") * F.ceil(F.col("group_size") / F.lit(part))))
            .cast("long")
            .alias("sub"),
        ),
        "ranges",
    )


def shard(docs: DataFrame, shards: int = SHARDS, ranges_per_shard: int = RANGES_PER_SHARD, parts_per_shard: int = PARTS_PER_SHARD) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``docs`` (``doc_id, text``).

    Size is the UTF-8 length plus 16; null texts count as empty. A shard is the part of the byte line in which
    the middle of the row's group of equal texts falls, so shards differ by less than one group; a group of more
    than ``1 / parts_per_shard`` of a shard is cut by rows. Slots number a shard's rows from 0 without gaps.
    Null ids and repeated rows are rows like any other; an empty table gives no rows.
    """
    rows = measured(docs)
    total = rows.agg(F.sum("size").alias("s")).first().s or 0
    placed = ranged(rows, total, shards, ranges_per_shard, parts_per_shard)
    cell = ["range", "sub_key", "sub"]
    keyed = placed.withColumn("sub_key", F.when(F.col("cut"), F.col("key")).otherwise(F.lit(0)))
    cells = keyed.groupBy(*cell).agg(F.sum("size").alias("bytes"))
    before = Window.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)  # a few rows per range and large group
    starts = cells.select(*cell, F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("cell_start"))
    inside = Window.partitionBy(*cell)
    order = inside.orderBy("key", "doc_id", "size")
    group = Window.partitionBy(*cell, "key")
    summed = (
        keyed.withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("middle", F.when(F.col("cut"), F.col("upto") - F.col("size") / 2).otherwise(
            (F.min(F.col("upto") - F.col("size")).over(group) + F.max("upto").over(group)) / 2
        ))
        .join(F.broadcast(starts), cell)
    )
    number = F.floor((F.col("cell_start") + F.col("middle")) * shards / F.lit(float(max(total, 1))))
    dealt = staged(
        summed.select("doc_id", "size", "text_crc32", "key", *cell, F.least(F.greatest(number, F.lit(0)), F.lit(shards - 1)).cast("int").alias("shard")),
        "dealt",
    )
    counts = dealt.groupBy("shard", *cell).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", *cell, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    nth = F.row_number().over(Window.partitionBy("shard", *cell).orderBy("key", "doc_id", "size"))
    return (
        dealt.withColumn("nth", nth)
        .join(F.broadcast(offsets), ["shard", *cell])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("nth") - 1).alias("slot"))
    )

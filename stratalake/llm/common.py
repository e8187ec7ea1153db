"""Helpers that several operators share: whole texts, narrow staged tables, global order, components."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.sources.parquet import load, staged

WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "bucket_of", "components", "global_row_number", "label_sample", "load", "parts", "running_sums", "shipped", "staged", "unused", "whole_text"]


def whole_text(column: str = "text") -> Column:
    """The text itself, a null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def parts(batches: Iterator[Any], rows: int = 64) -> Iterator[Any]:
    """Small parts of Arrow batches, so that a worker holds few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def shipped(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A broadcast of ``value``, opened in a task by the call; its class travels along, so workers need not have it."""
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(data.value)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bucket_of(key: Column, cuts: list[int], first: int = 0) -> Column:
    """Number of cuts that are at most the key: a balanced tree of comparisons, evaluated in generated code."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    return F.when(key < F.lit(cuts[mid]), bucket_of(key, cuts[:mid], first)).otherwise(bucket_of(key, cuts[mid + 1 :], first + mid + 1))


def label_sample(labels: DataFrame, column: str, usable: Column, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids as ``doc_id, label``, drawn by a hash of the id among ``usable`` rows."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & usable)
    known = known.groupBy("doc_id").agg((F.max(column) > 0).cast("int").alias("label"))
    return known.orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(rows)


def global_row_number(df: DataFrame, order: list[str], alias: str) -> DataFrame:
    """Number rows from 0 in the order of distinct keys, without one task that sees them all.

    Rows are range-partitioned by key and staged with their partition; the only window over the whole
    table runs over one count per partition.
    """
    parts = staged(
        df.repartitionByRange(*[F.col(c).asc() for c in order]).withColumn("_part", F.spark_partition_id()), "ranked"
    )
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        parts.withColumn("_inner", inner)
        .join(starts, "_part")
        .withColumn(alias, F.col("_start") + F.col("_inner") - 1)
        .drop("_part", "_inner", "_start")
    )


def running_sums(df: DataFrame, group: list[str], bucket: str, order: list[str], values: dict[str, str]) -> DataFrame:
    """Sums over the rows before each row of its group, in the order (``bucket``, ``order``), as new columns.

    ``values`` maps each new column to the one it sums. A group may hold most rows: only (group, bucket) cells
    meet in one task, and one sum per cell is added up over the group. ``group`` and ``bucket`` must not be null.
    """
    cell = [*group, bucket]
    before = Window.unboundedPreceding, -1
    sums = df.groupBy(*cell).agg(*[F.sum(v).alias(f"_{n}_sum") for n, v in values.items()])
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(*before)
    starts = sums.select(*cell, *[F.coalesce(F.sum(f"_{n}_sum").over(earlier), F.lit(0)).alias(f"_{n}_start") for n in values])
    inside = Window.partitionBy(*cell).orderBy(*order).rowsBetween(*before)
    inner = df.withColumns({f"_{n}_inner": F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in values.items()})
    whole = {n: F.col(f"_{n}_start") + F.col(f"_{n}_inner") for n in values}
    return inner.join(starts, cell).withColumns(whole).drop(*[f"_{n}_{x}" for n in values for x in ("start", "inner")])


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the edges ``a, b``: each linked node with the smallest node it reaches.

    Alternates the large-star and small-star steps on staged edge tables until they stay the same, which
    takes a logarithmic number of rounds. Minima are partial sums before any shuffle, so a node with very
    many edges is no hot group; the join that hands its minimum back may be split by adaptive execution.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    current = staged(edges.where("a <> b").select(high, low).distinct(), "edges")
    seen = _signature(current)
    for _ in range(rounds):
        if seen[0] == 0:
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = staged(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = staged(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = _signature(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")).alias("s")
    ).first()
    return row.n, row.x, row.s

"""Streaming ingest: upsert into a table, replay-safe dedup, windowed dashboard."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.sources import snapshots

# what a caller passes to writeStream.trigger: everything that has landed, or a batch every five minutes
ONCE = {"availableNow": True}
EVERY_FIVE_MINUTES = {"processingTime": "5 minutes"}


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    on: Sequence[str],
    name: str,
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    trigger: dict | None = None,
    output_mode: str = "append",
    **merge_options,
) -> StreamingQuery:
    """Merge every micro-batch into the table at ``path``, which must exist (R-1, R-3, R-5).

    The commit carries the id of the checkpoint's query and of the batch, so a batch that is replayed after a
    failure changes nothing, and a new checkpoint, which counts its batches from 0 again, loses nothing.
    """
    spark = stream.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        run = spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id
        snapshots.merge_table(transform(batch), path, on, batch_id=f"{name}:{run}:{batch_id}", session=spark, **merge_options)

    writer = stream.writeStream.foreachBatch(apply).outputMode(output_mode).option("checkpointLocation", checkpoint)
    return writer.queryName(name).trigger(**(trigger or EVERY_FIVE_MINUTES)).start()


def create_empty(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Table with the schema of ``df`` and no rows."""
    empty = df.sparkSession.createDataFrame([], df.schema).limit(0)  # planned as empty: no Python worker starts
    return snapshots.write_table(empty, path, partition_by=partition_by, operation="CREATE")


def replay_safe(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeats that arrive within ``delay``; state older than that is released (R-2)."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def tumbling(
    stream: DataFrame,
    event_time: str,
    width: str,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    delay: str,
) -> DataFrame:
    """Measures per tumbling window and key with a bound on late rows (R-4, R-5)."""
    return (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, width).alias("_w"), *keys)
        .agg(*[m.alias(n) for n, m in measures.items()])
        .select(F.col("_w.start").alias("window_start"), *keys, *measures)
    )


def run_once(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` run to end and pass on its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()

"""Late rows are routed beside the others instead of being dropped, so a window that has closed can be corrected."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratalake.sources.parquet import folders
from stratalake.streaming.jobs import EVERY_FIVE_MINUTES

_PLACE = T.StructType().add("run", "string").add("batch", "long")


def _micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def window_start(event_time: str, width: timedelta) -> Column:
    """Start of the tumbling window; NULL for rows without a time."""
    at = F.unix_micros(event_time)
    return F.timestamp_micros(at - F.pmod(at, F.lit(_micros(width))))


def _newest(spark: SparkSession, path: str, run: str, batch_id: int) -> int | None:
    """Newest event time, in microseconds, of all batches before this one."""
    if not folders(spark, f"{path}/marks"):
        return None
    marks = spark.read.schema(T.StructType().add("newest", "long").add("run", "string").add("batch", "long")).parquet(f"{path}/marks")
    return marks.where((F.col("run") != run) | (F.col("batch") < batch_id)).agg(F.max("newest")).first()[0]


def route_late(
    stream: DataFrame, path: str, checkpoint: str, event_time: str, width: timedelta, delay: timedelta, name: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write every row of the stream once, below ``late=false`` or ``late=true`` (R-5).

    A row is late if its window ended at or before the newest event time of earlier batches less ``delay``, or if it has
    no time. Each batch is one pass over its rows and one folder, named by the checkpoint's query and the batch, and
    reads the marks of batches before it only: a replay writes the same rows over the same folder, a new checkpoint adds
    folders. Nothing is held in state; a mark of one row per batch is all that grows.
    """
    spark = stream.sparkSession
    clash = {"late", "run", "batch"} & {c.lower() for c in stream.columns}
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)}")

    def apply(batch: DataFrame, batch_id: int) -> None:
        run = spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id
        newest = _newest(spark, path, run, batch_id)
        closed = F.lit(False)
        if newest is not None:
            closed = F.unix_micros(window_start(event_time, width)) + _micros(width) <= newest - _micros(delay)
        seen = Observation()
        routed = batch.withColumn("late", F.coalesce(closed & F.col(event_time).isNotNull(), F.lit(False)) | F.col(event_time).isNull())
        routed = routed.observe(seen, F.max(F.unix_micros(event_time)).alias("newest"))
        place = f"run={run}/batch={batch_id}"
        routed.write.mode("overwrite").partitionBy("late").parquet(f"{path}/rows/{place}")
        mark = spark.range(1).select(F.lit(seen.get.get("newest")).cast("long").alias("newest"))
        mark.write.mode("overwrite").parquet(f"{path}/marks/{place}")

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).queryName(name)
    return writer.trigger(**(trigger or EVERY_FIVE_MINUTES)).start()


def routed_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows routed so far with ``late``, ``run`` and ``batch``; ``where("late")`` reads only the late folders."""
    columns = T.StructType([*schema.fields, T.StructField("late", T.BooleanType()), *_PLACE.fields])
    return spark.read.schema(columns).parquet(f"{path}/rows")

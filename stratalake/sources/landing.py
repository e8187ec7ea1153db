"""File streams in place of the message topics (S16): same rows, picked up as files land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def landing_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of the Parquet files at ``path``; the schema is a contract and never inferred."""
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def with_event_time(stream: DataFrame, ts: str = "ts", into: str = "event_time") -> DataFrame:
    """Zone-less times as instants, which watermarks need."""
    return stream.withColumn(into, F.col(ts).cast("timestamp"))

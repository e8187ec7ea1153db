"""Streaming jobs run over all landed rows and compared with their batch twins."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from stratalake.catalog.derive import (
    CALLS_SQL,
    CHUNK_OVERLAP,
    CHUNK_SIZE,
    DOCS_SQL,
    RETRIEVAL_SQL,
    raw_calls,
    raw_documents,
    raw_retrieval_logs,
)
from stratalake.catalog.registry import Registry
from stratalake.operators.dedup import first_per_key
from stratalake.plans.llm_calls import silver_calls
from stratalake.plans.rag import document_chunks, retrieval_events
from stratalake.session import fresh_path
from stratalake.sources import snapshots
from stratalake.sources.landing import landing_stream, with_event_time
from stratalake.sources.parquet import load
from stratalake.streaming import jobs, late

registry = Registry()
query = registry.query

FILES_PER_TRIGGER = 2


def _landed(spark, df):
    """Bronze rows written to a landing folder, and the stream that picks them up two files at a time.

    Four files at least; a larger table keeps the splits it has, and so takes more batches.
    """
    path = fresh_path(spark, "landing")
    files = df.rdd.getNumPartitions()
    spread = df if files >= 4 else df.repartition(4)
    spread.write.parquet(path)
    return landing_stream(spark, path, df.schema, files_per_trigger=FILES_PER_TRIGGER)


@query(f"WITH {CALLS_SQL} SELECT * FROM silver")
def stream_silver_calls(spark, sf):
    """Bronze to Silver in micro-batches; a call seen earlier than the stored one replaces it."""
    raw = raw_calls(spark, sf)
    path = fresh_path(spark, "silver")
    jobs.create_empty(silver_calls(raw), path, partition_by=["date"])
    run = jobs.upsert_stream(
        _landed(spark, raw),
        path,
        fresh_path(spark, "checkpoint"),
        ["request_id"],
        "silver_calls",
        transform=silver_calls,
        trigger=jobs.ONCE,
        condition=F.col("s.ts") < F.col("t.ts"),
        on_duplicate="trust",
    )
    jobs.run_once(run)
    return snapshots.read_table(spark, path)


@query(f"WITH {RETRIEVAL_SQL} SELECT event_id, user_id, tenant_id, top1_score, is_zero_hit, event_ts, bronze_kafka_offset FROM retrieval")
def stream_replay_dedup(spark, sf):
    """The log lands twice; offsets dedup the replay under a watermark."""
    logs = raw_retrieval_logs(spark, sf)
    stream = _landed(spark, logs.unionByName(logs))
    fresh = jobs.replay_safe(with_event_time(stream, "ingest_ts"), ["kafka_offset"], "event_time", "60 days")
    path = fresh_path(spark, "events")
    jobs.create_empty(retrieval_events(logs), path, partition_by=["event_date"])
    run = jobs.upsert_stream(
        retrieval_events(fresh),
        path,
        fresh_path(spark, "checkpoint"),
        ["event_id"],
        "replay_dedup",
        trigger=jobs.ONCE,
        on_duplicate="trust",
    )
    jobs.run_once(run)
    columns = "event_id user_id tenant_id top1_score is_zero_hit event_ts bronze_kafka_offset".split()
    return snapshots.read_table(spark, path).select(*columns)


@query("""SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, event_type AS tenant, count(*) AS calls,
  CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS latency_sum, max(value) AS latency_max
FROM events GROUP BY 1, 2""")
def stream_dashboard(spark, sf):
    """Five-minute windows per tenant, upserted while they are still open."""
    events = load(spark, sf, "events").withColumnRenamed("event_type", "tenant")
    stream = with_event_time(_landed(spark, events))
    windows = jobs.tumbling(
        stream,
        "event_time",
        "5 minutes",
        ["tenant"],
        {
            "calls": F.count(F.lit(1)),
            "latency_sum": F.sum(F.col("value").cast("decimal(18,2)")).cast("double"),
            "latency_max": F.max("value"),
        },
        "60 days",
    ).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    path = fresh_path(spark, "dashboard")
    jobs.create_empty(windows, path)
    run = jobs.upsert_stream(
        windows,
        path,
        fresh_path(spark, "checkpoint"),
        ["window_start", "tenant"],
        "dashboard",
        trigger=jobs.ONCE,
        output_mode="update",
        on_duplicate="trust",
    )
    jobs.run_once(run)
    return snapshots.read_table(spark, path)


@query("""SELECT user_id, event_type, ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def stream_latest_state(spark, sf):
    """Latest event per user; files land out of order and late rows never overwrite newer ones."""
    events = load(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    newest = [F.desc("ts"), F.desc("event_id")]
    path = fresh_path(spark, "state")
    jobs.create_empty(events, path)
    run = jobs.upsert_stream(
        _landed(spark, events),
        path,
        fresh_path(spark, "checkpoint"),
        ["user_id"],
        "latest_state",
        transform=lambda batch: first_per_key(batch, ["user_id"], newest),
        trigger=jobs.ONCE,
        condition=F.struct("s.ts", "s.event_id") > F.struct("t.ts", "t.event_id"),
        on_duplicate="trust",
    )
    jobs.run_once(run)
    return snapshots.read_table(spark, path)


@query(f"WITH {DOCS_SQL} SELECT chunk_id, doc_id, doc_version_hash, chunk_index, chunk_text, char_count, token_estimate FROM chunks")
def stream_document_chunks(spark, sf):
    """Documents land in files and are cut into chunks batch by batch."""
    docs = raw_documents(spark, sf)
    path = fresh_path(spark, "chunks")
    jobs.create_empty(document_chunks(docs, CHUNK_SIZE, CHUNK_OVERLAP, "run-1"), path)
    run = jobs.upsert_stream(
        document_chunks(_landed(spark, docs), CHUNK_SIZE, CHUNK_OVERLAP, "run-1"),
        path,
        fresh_path(spark, "checkpoint"),
        ["chunk_id"],
        "document_chunks",
        trigger=jobs.ONCE,
    )
    jobs.run_once(run)
    columns = "chunk_id doc_id doc_version_hash chunk_index chunk_text char_count token_estimate".split()
    return snapshots.read_table(spark, path).select(*columns)


_LATE = "INTERVAL '1 day'"


def _three_batches(spark, sf):
    """The events landed in three turns, one batch each."""
    events = load(spark, sf, "events").withColumnRenamed("event_type", "tenant")
    path = fresh_path(spark, "landing")
    files = events.rdd.getNumPartitions()
    for turn in range(3):
        events.where(F.col("event_id") % 3 == turn).repartition(files).write.mode("append").parquet(path)
    return with_event_time(landing_stream(spark, path, events.schema, files_per_trigger=files))


@query(f"""WITH marks AS (SELECT max(ts) - {_LATE} AS mark FROM events WHERE event_id % 3 = 0)
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type AS tenant, count(*) AS calls FROM events, marks
WHERE event_id % 3 < 2 OR time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' > mark GROUP BY 1, 2""")
def stream_late_rows(spark, sf):
    """Three batches of interleaved rows: what the third brings for windows behind the watermark is too late.

    The watermark of the first batch holds for late rows from the third on.
    """
    stream = _three_batches(spark, sf)
    windows = jobs.tumbling(stream, "event_time", "1 hour", ["tenant"], {"calls": F.count(F.lit(1))}, "1 day")
    windows = windows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    target = fresh_path(spark, "hourly")
    jobs.create_empty(windows, target)
    run = jobs.upsert_stream(
        windows, target, fresh_path(spark, "checkpoint"), ["window_start", "tenant"], "late_rows",
        trigger=jobs.ONCE, output_mode="update", on_duplicate="trust",
    )
    jobs.run_once(run)
    return snapshots.read_table(spark, target)


@query(f"""WITH marks AS (SELECT max(ts) FILTER (WHERE event_id % 3 = 0) - {_LATE} AS first, max(ts) FILTER (WHERE event_id % 3 < 2) - {_LATE} AS second FROM events),
rows AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type AS tenant, ts,
  CASE event_id % 3 WHEN 0 THEN FALSE WHEN 1 THEN time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= first
    ELSE time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= second END AS late FROM events, marks)
SELECT window_start, tenant, count(*) FILTER (WHERE NOT late) AS calls, count(*) FILTER (WHERE late) AS late_calls, max(ts) AS newest
FROM rows GROUP BY 1, 2""")
def stream_routed_late(spark, sf):
    """The same three batches with late rows kept: hourly calls on time, late ones beside them, both in the corrected newest time."""
    stream = _three_batches(spark, sf)
    path, hour = fresh_path(spark, "routed"), timedelta(hours=1)
    run = late.route_late(stream, path, fresh_path(spark, "checkpoint"), "event_time", hour, timedelta(days=1), "routed_late", jobs.ONCE)
    jobs.run_once(run)
    start = late.window_start("event_time", hour).cast("timestamp_ntz").alias("window_start")
    rows = late.routed_rows(spark, path, stream.schema)
    return rows.groupBy(start, "tenant").agg(
        F.count_if(~F.col("late")).alias("calls"), F.count_if("late").alias("late_calls"), F.max("ts").alias("newest")
    )

"""Compaction, clustering and file pruning on ``events`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.catalog.registry import Registry
from stratalake.functions.measures import rounded
from stratalake.operators.layout import pruned_ratio
from stratalake.session import fresh_path
from stratalake.sources import snapshots
from stratalake.sources.parquet import load

registry = Registry()
query = registry.query

# the least number of files; larger tables get more
SMALL_FILES = 200
CLUSTERED_FILES = 50


def _small_files(spark, sf):
    """``events`` in 200 files, or in as many as the scan has splits where that is more."""
    path = fresh_path(spark, "small-files")
    events = load(spark, sf, "events")
    snapshots.write_table(events, path, files=max(SMALL_FILES, events.rdd.getNumPartitions()))
    return path


@query("SELECT * FROM events")
def compacted_rows(spark, sf):
    path = _small_files(spark, sf)
    snapshots.optimize(spark, path, target_bytes=128 << 20)
    return snapshots.read_table(spark, path)


@query("SELECT * FROM events")
def clustered_rows(spark, sf):
    path = _small_files(spark, sf)
    snapshots.optimize(spark, path, target_bytes=128 << 20, cluster_by=["user_id"], min_files=CLUSTERED_FILES)
    return snapshots.read_table(spark, path)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_shipdate FROM lineitem")
def z_ordered_rows(spark, sf):
    path = fresh_path(spark, "lines")
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_shipdate")
    snapshots.write_table(lines, path)
    snapshots.optimize(spark, path, 128 << 20, cluster_by=["l_partkey", "l_shipdate"], min_files=16)
    return snapshots.read_table(spark, path)


@query("SELECT event_id, ts, value FROM events WHERE user_id = 42 AND event_type = 'purchase'")
def pruned_point_read(spark, sf):
    path = _small_files(spark, sf)
    snapshots.optimize(spark, path, 128 << 20, cluster_by=["user_id"], min_files=CLUSTERED_FILES)
    found = snapshots.read_pruned(spark, path, "user_id", 42)
    return found.where("event_type = 'purchase'").select("event_id", "ts", "value")


@query("SELECT CAST(count(*) AS BIGINT) AS rows, min(user_id) AS lowest, max(user_id) AS highest FROM events")
def file_range_totals(spark, sf):
    ranges = snapshots.file_ranges(spark, _small_files(spark, sf), ["user_id"])
    return ranges.agg(
        F.sum("rows").alias("rows"), F.min("min_user_id").alias("lowest"), F.max("max_user_id").alias("highest")
    )


@query(f"""SELECT 'scattered' AS layout, CAST({SMALL_FILES} AS BIGINT) AS files, FALSE AS tenfold
UNION ALL SELECT 'clustered', {CLUSTERED_FILES}, TRUE""")
def pruning_gain(spark, sf):
    """Files to open for one event id, before and after clustering."""
    path = _small_files(spark, sf)
    median = load(spark, sf, "events").agg(F.percentile_approx("event_id", 0.5).alias("m")).first().m

    def measured(layout):
        gain = pruned_ratio(snapshots.file_ranges(spark, path, ["event_id"]), "event_id", median)
        return gain.select(F.lit(layout).alias("layout"), "files", (F.col("ratio") >= 10).alias("tenfold"))

    before = measured("scattered")
    snapshots.optimize(spark, path, 128 << 20, cluster_by=["event_id"], min_files=CLUSTERED_FILES)
    return before.union(measured("clustered"))


@query("""SELECT 'small' AS layout, CAST(200 AS BIGINT) AS files, count(*) AS rows FROM events
UNION ALL SELECT 'compact', 1, count(*) FROM events""")
def file_counts(spark, sf):
    path = _small_files(spark, sf)
    snapshots.optimize(spark, path, target_bytes=128 << 20)
    parts = [
        snapshots.table_stats(spark, path, v).select(F.lit(n).alias("layout"), "files", "rows")
        for n, v in (("small", 0), ("compact", 1))
    ]
    return parts[0].union(parts[1])


@query("""SELECT event_type, CAST(round(CAST(avg(value) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS mean, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' GROUP BY event_type""")
def partition_pruned_days(spark, sf):
    path = fresh_path(spark, "by-day")
    events = load(spark, sf, "events").withColumn("day", F.to_date("ts"))
    snapshots.write_table(events, path, partition_by=["day"])
    days = snapshots.read_table(spark, path).where("day BETWEEN DATE'2024-01-10' AND DATE'2024-01-11'")
    return days.groupBy("event_type").agg(rounded(F.avg("value"), 4).alias("mean"), F.count(F.lit(1)).alias("n"))

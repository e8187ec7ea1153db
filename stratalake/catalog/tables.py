"""Snapshot tables: versions, restore, evolution, erasure. Each call uses a fresh path in the shared folder."""

from __future__ import annotations

from datetime import timedelta, timezone

from pyspark.sql import functions as F

from stratalake.catalog.derive import raw_documents, raw_retrieval_logs
from stratalake.catalog.registry import Registry
from stratalake.functions.measures import rounded
from stratalake.functions.vectors import l2_norm
from stratalake.plans.rag import ingest_bronze
from stratalake.session import fresh_path
from stratalake.sources import snapshots
from stratalake.sources.parquet import load

registry = Registry()
query = registry.query


def _tier(balance):
    return F.when(balance > 5000, "gold").otherwise("silver")


def _customer_versions(spark, sf):
    """v0 load without one segment, v1 adds ``tier``, v2 upsert, v3 faulty append, v4 restore of v2."""
    path = fresh_path(spark, "customers")
    customers = load(spark, sf, "customer")
    first = customers.where("c_mktsegment <> 'BUILDING'")
    snapshots.write_table(first, path, partition_by=["c_nationkey"])
    tiered = snapshots.read_table(spark, path).withColumn("tier", _tier(F.col("c_acctbal")))
    snapshots.write_table(tiered, path, schema_mode="overwrite")
    feed = customers.where("c_mktsegment IN ('BUILDING', 'MACHINERY')").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.lit(999.0).alias("c_acctbal"),
        F.lit("VIP").alias("c_mktsegment"),
        F.lit("platinum").alias("tier"),
    )
    snapshots.merge_table(feed, path, ["c_custkey"])
    bad = customers.where("c_acctbal < 0").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.lit(-1.0).alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"),
        F.lit("UNKNOWN").alias("tier"),
    )
    snapshots.write_table(bad, path, mode="append")
    snapshots.restore(spark, path, 2)
    return path


VERSIONS_SQL = """
v0 AS (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'),
v1 AS (SELECT *, CASE WHEN c_acctbal > 5000 THEN 'gold' ELSE 'silver' END AS tier FROM v0),
feed AS (SELECT c_custkey, c_name, c_nationkey, 999.0::DOUBLE AS c_acctbal, 'VIP' AS c_mktsegment, 'platinum' AS tier
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
v2 AS (SELECT * FROM v1 WHERE c_custkey NOT IN (SELECT c_custkey FROM feed) UNION ALL SELECT * FROM feed),
v3 AS (SELECT * FROM v2 UNION ALL
  SELECT c_custkey, c_name, c_nationkey, -1.0, NULL, 'UNKNOWN' FROM customer WHERE c_acctbal < 0)
"""


@query(f"""WITH {VERSIONS_SQL}
SELECT 0 AS version, count(*) AS rows, count(*) FILTER (WHERE c_acctbal = -1) AS bad_rows FROM v0
UNION ALL SELECT 1, count(*), count(*) FILTER (WHERE c_acctbal = -1) FROM v1
UNION ALL SELECT 2, count(*), count(*) FILTER (WHERE c_acctbal = -1) FROM v2
UNION ALL SELECT 3, count(*), count(*) FILTER (WHERE c_acctbal = -1) FROM v3
UNION ALL SELECT 4, count(*), count(*) FILTER (WHERE c_acctbal = -1) FROM v2""")
def time_travel_counts(spark, sf):
    path = _customer_versions(spark, sf)
    parts = [
        snapshots.read_table(spark, path, v).agg(
            F.lit(v).alias("version"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("c_acctbal") == -1).alias("bad_rows"),
        )
        for v in range(5)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@query(f"WITH {VERSIONS_SQL} SELECT * FROM v2")
def restored_rows(spark, sf):
    return snapshots.read_table(spark, _customer_versions(spark, sf))


@query(f"WITH {VERSIONS_SQL} SELECT * FROM v0")
def rows_as_of_first_version(spark, sf):
    return snapshots.read_table(spark, _customer_versions(spark, sf), 0)


@query(f"""WITH {VERSIONS_SQL}, m AS (SELECT count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS updated,
  count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS inserted FROM customer)
SELECT CAST(4 AS BIGINT) AS version, 'RESTORE' AS operation, CAST(NULL AS BIGINT) AS rows_updated, CAST(NULL AS BIGINT) AS rows_inserted
UNION ALL SELECT 3, 'APPEND', NULL, NULL UNION ALL SELECT 2, 'MERGE', updated, inserted FROM m
UNION ALL SELECT 1, 'OVERWRITE', NULL, NULL UNION ALL SELECT 0, 'OVERWRITE', NULL, NULL""")
def table_history(spark, sf):
    log = snapshots.history(spark, _customer_versions(spark, sf))
    return log.select(
        "version",
        "operation",
        F.try_element_at("metrics", F.lit("rows_updated")).alias("rows_updated"),
        F.try_element_at("metrics", F.lit("rows_inserted")).alias("rows_inserted"),
    )


@query(f"""WITH {VERSIONS_SQL} SELECT c_nationkey, count(*) AS rows FROM v3 GROUP BY c_nationkey""")
def active_file_rows(spark, sf):
    path = _customer_versions(spark, sf)
    files = snapshots.active_files(spark, path, 3)
    nation = F.regexp_extract("file", r"c_nationkey=([0-9]+)", 1).cast("int")
    return files.groupBy(nation.alias("c_nationkey")).agg(F.sum("rows").alias("rows"))


@query("""SELECT 'raw_documents' AS "table", CAST(TIMESTAMP '2026-01-01' + to_minutes(doc_id * 37 % 43200) AS DATE) AS ingest_date, count(*) AS rows
FROM documents GROUP BY 2 UNION ALL SELECT 'raw_retrieval_logs', CAST(ts AS DATE), count(*) FROM events GROUP BY 2""")
def bronze_ingest(spark, sf):
    paths = ingest_bronze(raw_documents(spark, sf), raw_retrieval_logs(spark, sf), fresh_path(spark, "bronze"))
    parts = [
        snapshots.read_table(spark, path)
        .groupBy(F.lit(name).alias("table"), "ingest_date")
        .agg(F.count(F.lit(1)).alias("rows"))
        for name, path in paths.items()
    ]
    return parts[0].union(parts[1])


@query("""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, NULL::VARCHAR AS tier FROM customer WHERE c_acctbal <= 5000
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'gold' FROM customer WHERE c_acctbal > 5000""")
def append_evolved(spark, sf):
    path = fresh_path(spark, "evolved")
    customers = load(spark, sf, "customer")
    snapshots.write_table(customers.where("c_acctbal <= 5000"), path)
    richer = customers.where("c_acctbal > 5000").withColumn("tier", _tier(F.col("c_acctbal")))
    snapshots.write_table(richer, path, mode="append", schema_mode="merge")
    return snapshots.read_table(spark, path)


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
  CAST(o_orderdate AS DATE) AS o_date, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders""")
def merge_into_partitions(spark, sf):
    """Upsert that touches the partitions of two years only."""
    path = fresh_path(spark, "orders")
    orders = load(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.to_date("o_orderdate").alias("o_date"),
        F.year("o_orderdate").alias("o_year"),
    )
    snapshots.write_table(orders, path, partition_by=["o_year"])
    feed = orders.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("O"))
    snapshots.merge_table(feed, path, ["o_orderkey"])
    return snapshots.read_table(spark, path)


@query("""WITH e AS (SELECT event_type AS tenant, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1)
SELECT 'events' AS entry, tenant, n AS rows FROM e WHERE tenant <> 'click'
UNION ALL SELECT 'users', tenant, users FROM e WHERE tenant <> 'click'
UNION ALL SELECT 'audit of events', 'click', n FROM e WHERE tenant = 'click'
UNION ALL SELECT 'audit of users', 'click', users FROM e WHERE tenant = 'click'""")
def erased_tenant(spark, sf):
    """One tenant goes from two tables; what is left of both, and what the audit says."""
    paths = {name: fresh_path(spark, name) for name in ("events", "users")}
    audit = fresh_path(spark, "audit")
    events = load(spark, sf, "events").select(F.col("event_type").alias("tenant"), "event_id", "user_id", "value")
    snapshots.write_table(events, paths["events"], partition_by=["tenant"])
    snapshots.write_table(events.select("tenant", "user_id").distinct(), paths["users"])
    snapshots.erase(spark, list(paths.values()), F.col("tenant") == "click", audit, "click", "privacy office")
    out = snapshots.read_table(spark, audit)
    named = F.when(F.col("path") == paths["events"], "audit of events").otherwise("audit of users")
    out = out.select(named.alias("entry"), F.col("subject").alias("tenant"), F.col("rows_deleted").alias("rows"))
    for name, path in paths.items():
        left = snapshots.read_table(spark, path).groupBy("tenant").agg(F.count(F.lit(1)).alias("rows"))
        out = out.unionByName(left.withColumn("entry", F.lit(name)))
    return out


@query("""SELECT day, sum(n)::BIGINT AS calls, CAST(round(CAST(sum(v) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS total FROM (
  SELECT CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(CAST(CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value ELSE 0 END AS DECIMAL(18, 2))) AS DOUBLE) AS v
  FROM events GROUP BY 1) GROUP BY day""")
def backfilled_days(spark, sf):
    """A daily mart is loaded without values, then the later days are rebuilt in place."""
    path = fresh_path(spark, "daily")
    daily = load(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("calls"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    )
    snapshots.write_table(daily.withColumn("total", F.lit(0.0)), path, partition_by=["day"])
    snapshots.overwrite_partitions(daily.where("day >= DATE'2024-01-15'"), path)
    return snapshots.read_table(spark, path)


@query("""SELECT * FROM (VALUES ('healthy', CAST(0 AS BIGINT)), ('faulty', (SELECT count(*) FROM embeddings WHERE label = 3)), ('restored', CAST(0 AS BIGINT))) t(state, zero_norms)""")
def rollback_drill(spark, sf):
    """A faulty re-embed writes zero vectors for one label; RESTORE takes them back."""
    path = fresh_path(spark, "vectors")
    vectors = load(spark, sf, "embeddings")
    snapshots.write_table(vectors.withColumn("norm", l2_norm(F.col("embedding"))), path)
    healthy = snapshots.table_version(spark, path)
    zero = vectors.where("label = 3").select(
        "vec_id", F.transform("embedding", lambda x: F.lit(0.0).cast("float")).alias("embedding"), "label"
    )
    changes = {"embedding": F.col("s.embedding"), "norm": F.lit(0.0)}
    faulty = snapshots.merge_table(zero, path, ["vec_id"], matched=changes, not_matched=None)
    restored = snapshots.restore(spark, path, healthy)

    def zeros(state, version):
        counted = snapshots.read_table(spark, path, version).agg(F.count_if(F.col("norm") == 0).alias("zero_norms"))
        return counted.select(F.lit(state).alias("state"), "zero_norms")

    return zeros("healthy", healthy).union(zeros("faulty", faulty)).union(zeros("restored", restored))


@query("""SELECT 'bronze' AS "table", CAST(0 AS BIGINT) AS version, (SELECT count(*) FROM events) AS rows
UNION ALL SELECT 'gold', 0, (SELECT count(*) FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) FROM events))""")
def layer_overview(spark, sf):
    bronze, gold = fresh_path(spark, "bronze"), fresh_path(spark, "gold")
    events = load(spark, sf, "events")
    snapshots.write_table(events, bronze)
    day = F.to_date("ts").alias("day")
    mart = snapshots.read_table(spark, bronze).groupBy("event_type", day).agg(rounded(F.avg("value"), 4).alias("mean"))
    snapshots.write_table(mart, gold)
    summary = snapshots.layer_summary(spark, {"bronze": bronze, "gold": gold})
    return summary.select("table", F.col("version").cast("long").alias("version"), "rows")


@query("""SELECT 'before' AS moment, CAST(3 AS BIGINT) AS folders, 3 * count(DISTINCT event_type) AS rows FROM events
UNION ALL SELECT 'after', 1, count(DISTINCT event_type) FROM events""")
def vacuum_folders(spark, sf):
    """Snapshot folders on disk before and after two overwritten versions are vacuumed."""
    path = fresh_path(spark, "vacuum")
    per_type = load(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    for _ in range(3):
        snapshots.write_table(per_type, path)

    def on_disk():
        data = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data")
        return data.agg(F.count_distinct("snap").alias("folders"), F.count(F.lit(1)).alias("rows")).first()

    before = on_disk()
    later = snapshots.history(spark, path).first().ts.astimezone(timezone.utc) + timedelta(days=1)
    snapshots.vacuum(spark, path, timedelta(0), later, dry_run=False)
    rows = [("before", *before), ("after", *on_disk())]
    return spark.createDataFrame(rows, "moment string, folders long, rows long")

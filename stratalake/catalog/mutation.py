"""Upserts, deletes and version diffs on ``orders``.

Target: the settled orders. Source: the feed of orders placed from 1998 on, settled or pending, with
the total recomputed from the order lines; pending orders are new to the target.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.catalog.registry import Registry
from stratalake.functions.measures import rounded
from stratalake.operators.merge import delete_where, merge, merge_metrics, version_diff
from stratalake.operators.history import scd2_intervals
from stratalake.sources.parquet import load

registry = Registry()
query = registry.query

# decimal, so that half cents round alike however the lines are added up
NET_PRICE = "CAST(l_extendedprice AS DECIMAL(15, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))"
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def target(spark, sf):
    return load(spark, sf, "orders").where("o_orderstatus <> 'P'").select(*COLUMNS)


def source(spark, sf):
    lines = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        rounded(F.sum(F.expr(NET_PRICE)), 2).cast("double").alias("recomputed"),
        F.max("l_shipdate").alias("shipped"),
    )
    feed = load(spark, sf, "orders").where("o_orderdate >= TIMESTAMP_NTZ'1998-01-01 00:00:00'")
    return feed.join(lines, "o_orderkey", "left").select(
        "o_orderkey",
        "o_custkey",
        F.lit("N").alias("o_orderstatus"),
        F.col("recomputed").alias("o_totalprice"),
        F.col("shipped").alias("o_orderdate"),
    )


SIDES = """
t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus <> 'P'),
lines AS (SELECT l_orderkey, CAST(round(sum(CAST(l_extendedprice AS DECIMAL(15, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))), 2) AS DOUBLE) AS recomputed, max(l_shipdate) AS shipped
  FROM lineitem GROUP BY l_orderkey),
s AS (SELECT o_orderkey, o_custkey, 'N' AS o_orderstatus, recomputed AS o_totalprice, shipped AS o_orderdate
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey WHERE o_orderdate >= TIMESTAMP '1998-01-01')
"""


@query(f"""WITH {SIDES} SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s""")
def merge_upsert_all(spark, sf):
    return merge(target(spark, sf), source(spark, sf), ["o_orderkey"])


@query(f"""WITH {SIDES}
SELECT t.o_orderkey, t.o_custkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice, t.o_orderdate
FROM t LEFT JOIN s USING (o_orderkey)
UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)""")
def merge_partial(spark, sf):
    changes = {"o_orderstatus": F.col("s.o_orderstatus"), "o_totalprice": F.col("s.o_totalprice")}
    return merge(target(spark, sf), source(spark, sf), ["o_orderkey"], matched=changes)


@query(f"""WITH {SIDES}
SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus,
  CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice, t.o_orderdate
FROM t LEFT JOIN s USING (o_orderkey)""")
def merge_update_only(spark, sf):
    changes = {"o_totalprice": F.col("s.o_totalprice")}
    return merge(target(spark, sf), source(spark, sf), ["o_orderkey"], matched=changes, not_matched=None)


@query(f"""WITH {SIDES}
SELECT t.o_orderkey, t.o_custkey,
  CASE WHEN s.o_orderdate > t.o_orderdate THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderdate > t.o_orderdate THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
  CASE WHEN s.o_orderdate > t.o_orderdate THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate
FROM t LEFT JOIN s USING (o_orderkey)
UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)""")
def merge_if_newer(spark, sf):
    newer = F.col("s.o_orderdate") > F.col("t.o_orderdate")
    return merge(target(spark, sf), source(spark, sf), ["o_orderkey"], condition=newer)


@query(f"""WITH {SIDES}, n AS (
  SELECT (SELECT count(*) FROM t JOIN s USING (o_orderkey)) AS rows_updated, (SELECT count(*) FROM s) AS src, (SELECT count(*) FROM t) AS tgt)
SELECT rows_updated, src - rows_updated AS rows_inserted, tgt - rows_updated AS rows_copied,
  tgt + src - rows_updated AS rows_written FROM n""")
def merge_row_metrics(spark, sf):
    merged = merge(target(spark, sf), source(spark, sf), ["o_orderkey"], keep_action=True)
    return merge_metrics(merged)


@query("""SELECT u.user_id, u.event_type, u.ts, u.value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) u WHERE rn = 1""")
def merge_latest_of_duplicates(spark, sf):
    events = load(spark, sf, "events")
    base = events.where("event_type <> 'signup'").groupBy("user_id", "event_type").agg(
        F.min("ts").alias("ts"), F.lit(0.0).alias("value")
    )
    feed = events.select("user_id", "event_type", "ts", "value", "event_id")
    return merge(
        base, feed, ["user_id", "event_type"], on_duplicate="latest", order_by=[F.desc("ts"), F.desc("event_id")]
    )


@query("""SELECT * FROM customer WHERE NOT coalesce(c_mktsegment = 'BUILDING', FALSE)""")
def delete_rows(spark, sf):
    return delete_where(load(spark, sf, "customer"), F.col("c_mktsegment") == "BUILDING")


DIFF_SIDES = f"{SIDES}, u AS (SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s)"


@query(f"""WITH {DIFF_SIDES}
SELECT o_orderkey, t.o_totalprice AS o_totalprice_before, u.o_totalprice AS o_totalprice_after,
  CAST(round(CAST(u.o_totalprice - t.o_totalprice AS DECIMAL(38, 8)), 2) AS DOUBLE) AS delta
FROM t JOIN u USING (o_orderkey) WHERE t.o_totalprice IS DISTINCT FROM u.o_totalprice""")
def value_diff(spark, sf):
    before = target(spark, sf)
    after = merge(before, source(spark, sf), ["o_orderkey"])
    return version_diff(before, after, ["o_orderkey"], "o_totalprice").withColumn("delta", rounded("delta", 2))


@query(f"""WITH {DIFF_SIDES}
SELECT o_orderkey, t.o_orderstatus AS o_orderstatus_before, u.o_orderstatus AS o_orderstatus_after,
  CASE WHEN t.o_orderkey IS NULL THEN 'added' WHEN u.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM (SELECT * FROM t) t FULL JOIN (SELECT * FROM u WHERE o_orderstatus <> 'F') u USING (o_orderkey)
WHERE t.o_orderkey IS NULL OR u.o_orderkey IS NULL OR t.o_orderstatus IS DISTINCT FROM u.o_orderstatus""")
def row_diff(spark, sf):
    before = target(spark, sf)
    after = delete_where(merge(before, source(spark, sf), ["o_orderkey"]), F.col("o_orderstatus") == "F")
    return version_diff(before, after, ["o_orderkey"], "o_orderstatus", include_added_removed=True)


@query("""SELECT user_id, event_type AS state, ts AS valid_from,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
WHERE before IS DISTINCT FROM event_type""")
def scd2_states(spark, sf):
    events = load(spark, sf, "events").select("user_id", F.col("event_type").alias("state"), "ts", "event_id")
    return scd2_intervals(events, ["user_id"], ["ts", "event_id"], ["state"], "ts", slice_of=F.to_date("ts")).select(
        "user_id", "state", "valid_from", "valid_to", "is_current"
    )

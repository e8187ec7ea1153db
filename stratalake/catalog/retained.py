"""Marts of sketches that merge, and raw rows that age into totals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from stratalake.catalog.derive import RETRIEVAL_SQL, raw_retrieval_logs
from stratalake.catalog.registry import Registry
from stratalake.functions.measures import rounded
from stratalake.operators import retention, sketches
from stratalake.plans.rag import retrieval_events
from stratalake.session import fresh_path
from stratalake.sources.parquet import load, staged

registry = Registry()
query = registry.query


def _ranks(rows, points, by, value, wanted):
    """Whether each point's rank among the values is within one percent of the wanted one."""
    below = {n: F.avg((F.col(value) < F.col(n)).cast("double")) for n in wanted}
    upto = {n: F.avg((F.col(value) <= F.col(n)).cast("double")) for n in wanted}
    close = [((below[n] <= p + 0.01) & (upto[n] >= p - 0.01)).alias(f"{n}_close") for n, p in wanted.items()]
    return rows.join(points, by).groupBy(by).agg(*close)


@query("""SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS events, TRUE AS users_close, TRUE AS p50_close, TRUE AS p95_close
FROM events GROUP BY 1""")
def weekly_from_daily_sketches(spark, sf):
    """Weeks from a stored mart of days and types: counts equal, distinct users within 3 %, quantiles within 1 % of the rank."""
    events = load(spark, sf, "events").withColumn("day", F.to_date("ts"))
    mart = staged(sketches.sketch_mart(events, ["day", "event_type"], {"users": "user_id"}, {"spread": "value"}), "sketches")
    week = F.to_date(F.date_trunc("week", "day")).alias("week")
    weeks = sketches.merged(mart, [week], ["users"], ["spread"])
    points = staged(
        weeks.select("week", F.col("rows").alias("events"), sketches.distinct("users").alias("users"),
                     sketches.quantile("spread", 0.5).alias("p50"), sketches.quantile("spread", 0.95).alias("p95")), "weeks"
    )
    rows = events.select(week, "user_id", "value")
    exact = rows.groupBy("week").agg(F.count_distinct("user_id").alias("exact"))
    users = points.join(exact, "week").select("week", "events", (F.abs(F.col("users") - F.col("exact")) <= 0.03 * F.col("exact")).alias("users_close"))
    return users.join(_ranks(rows, points.select("week", "p50", "p95"), "week", "value", {"p50": 0.5, "p95": 0.95}), "week")


@query(f"""WITH {RETRIEVAL_SQL} SELECT query_modality, count(*) AS queries,
  CAST(round(CAST(sum(CASE WHEN is_zero_hit THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 4) AS DOUBLE) AS zero_hit_rate,
  TRUE AS users_close, TRUE AS p95_latency_close FROM retrieval GROUP BY 1""")
def q3_from_sketches(spark, sf):
    """Q3 from a stored mart of days: the p95 latency of all queries of a modality, not the mean of daily percentiles."""
    events = staged(retrieval_events(raw_retrieval_logs(spark, sf)).select("event_date", "tenant_id", "query_modality", "user_id", "is_zero_hit", "latency_ms"), "events")
    zero = {"zero_hits": F.col("is_zero_hit").cast("long")}
    mart = staged(sketches.sketch_mart(events, ["event_date", "tenant_id", "query_modality"], {"users": "user_id"}, {"latency": "latency_ms"}, zero), "sketches")
    by = sketches.merged(mart, ["query_modality"], ["users"], ["latency"], ["zero_hits"])
    points = staged(
        by.select("query_modality", F.col("rows").alias("queries"), rounded(F.col("zero_hits") / F.col("rows"), 4).alias("zero_hit_rate"),
                  sketches.distinct("users").alias("users"), sketches.quantile("latency", 0.95).alias("p95_latency")), "modalities"
    )
    exact = events.groupBy("query_modality").agg(F.count_distinct("user_id").alias("exact"))
    close = (F.abs(F.col("users") - F.col("exact")) <= 0.03 * F.col("exact")).alias("users_close")
    found = points.join(exact, "query_modality").select("query_modality", "queries", "zero_hit_rate", close)
    return found.join(_ranks(events, points.select("query_modality", "p95_latency"), "query_modality", "latency_ms", {"p95_latency": 0.95}), "query_modality")


_TOTALS = "event_type, CAST(count(*) AS BIGINT) AS calls, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS spent, max(ts) AS newest, CAST(count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-24') AS BIGINT) AS raw_rows"


@query(" UNION ALL ".join(f"SELECT '{g}' AS grain, CAST(date_trunc('{g}', ts) AS TIMESTAMP) AS period, {_TOTALS} FROM events GROUP BY ALL" for g in ("hour", "day", "month")))
def totals_after_ageing(spark, sf):
    """Hours, days and months after all but seven days of raw rows have aged, and the raw rows left; a second run moves nothing."""
    events = load(spark, sf, "events").withColumns({"day": F.to_date("ts"), "cents": F.col("value").cast("decimal(18,2)")})
    raw, store = fresh_path(spark, "raw"), fresh_path(spark, "totals")
    events.repartition("day").write.partitionBy("day").parquet(raw)
    keys, measures = ["event_type"], {"calls": ("count", "event_id"), "spent": ("sum", "cents"), "newest": ("max", "ts")}
    for _ in range(2):
        moved = retention.age(spark, raw, store, date(2024, 1, 31), "ts", keys, measures)
    if moved:
        raise RuntimeError(f"moved twice: {moved}")
    left = retention.rollups(spark.read.parquet(raw), "ts", keys, {"raw_rows": ("count", "event_id")})
    found = retention.history(spark, raw, store, "ts", keys, measures).join(left, ["event_type", "grain", "period"], "left")
    return found.withColumns({"spent": F.col("spent").cast("double"), "raw_rows": F.coalesce("raw_rows", F.lit(0))})

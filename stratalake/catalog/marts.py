"""KPI marts, reports, alerts, gates and lineage over the derived document store and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.catalog.derive import (
    AS_OF,
    DOCS_SQL,
    RETRIEVAL_SQL,
    chunk_embeddings,
    chunks,
    current_hashes,
    ntz,
    raw_documents,
    raw_retrieval_logs,
)
from stratalake.catalog.registry import Registry
from stratalake.functions.measures import rounded
from stratalake.operators.impact import downstream
from stratalake.plans import alerts, marts, rag
from stratalake.plans.settings import EMBEDDING_MODEL
from stratalake.sources.parquet import load, staged

registry = Registry()
query = registry.query


def _chunks(spark, sf):
    return staged(chunks(spark, sf), "chunks")


def _events(spark, sf):
    return staged(rag.retrieval_events(raw_retrieval_logs(spark, sf)), "events")


def _freshness(spark, sf):
    cut = _chunks(spark, sf)
    made = chunk_embeddings(spark, sf, cut)
    return marts.freshness_kpi(cut, current_hashes(spark, sf), made, ntz(f"{AS_OF} 00:00:00"))


def _quality(spark, sf):
    return marts.quality_kpi(_events(spark, sf))


def _cost(spark, sf):
    cut = _chunks(spark, sf)
    return marts.cost_kpi(chunk_embeddings(spark, sf, cut), cut)


FRESHNESS_SQL = f"""
freshness AS (
  SELECT DATE '{AS_OF}' AS report_date, tenant_id, modality, count(*) AS total_chunk_count,
    count(*) FILTER (WHERE stale) AS stale_chunk_count, count(*) FILTER (WHERE NOT stale) AS fresh_chunk_count,
    CAST(round(CAST(avg(CASE WHEN stale THEN 0.0 ELSE 1.0 END) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS freshness_ratio,
    min(CASE WHEN stale THEN embed_ts END) AS oldest_stale_embed_ts,
    CAST(round(CAST(avg(date_diff('day', CAST(embed_ts AS DATE), DATE '{AS_OF}')) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS avg_days_since_embed,
    CAST(round(CAST(sum(CASE WHEN stale THEN cost_usd ELSE 0 END) AS DECIMAL(38, 12)), 6) AS DOUBLE) AS pending_reembed_cost_usd
  FROM (SELECT c.tenant_id, c.modality, e.embed_ts, e.cost_usd, coalesce(c.doc_version_hash <> r.current_hash, FALSE) AS stale
    FROM chunks c LEFT JOIN registry r USING (doc_id) LEFT JOIN embedded e ON c.chunk_id = e.chunk_id)
  GROUP BY tenant_id, modality)
"""
QUALITY_SQL = """
quality AS (
  SELECT event_date AS report_date, tenant_id, query_modality, count(*) AS total_queries,
    count(*) FILTER (WHERE is_zero_hit) AS zero_hit_count,
    CAST(round(CAST(avg(CASE WHEN is_zero_hit THEN 1.0 ELSE 0.0 END) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS zero_hit_rate,
    CAST(round(CAST(avg(top1_score) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS avg_top1_score,
    CAST(round(CAST(quantile_cont(top1_score, 0.5) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS p50_score, CAST(round(CAST(quantile_cont(top1_score, 0.95) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS p95_score,
    CAST(round(CAST(avg(latency_ms) AS DECIMAL(38, 7)), 1) AS DOUBLE) AS avg_latency_ms, CAST(round(CAST(quantile_cont(latency_ms, 0.95) AS DECIMAL(38, 6)), 0) AS DOUBLE) AS p95_latency_ms
  FROM retrieval GROUP BY event_date, tenant_id, query_modality)
"""
COST_SQL = """
cost AS (
  SELECT embed_date AS report_date, e.tenant_id, embedding_model, modality, count(*) AS embed_request_count,
    CAST(sum(prompt_tokens) AS BIGINT) AS total_tokens, CAST(round(CAST(sum(cost_usd) AS DECIMAL(38, 12)), 6) AS DOUBLE) AS total_cost_usd,
    CAST(round(CAST(avg(cost_usd) AS DECIMAL(38, 14)), 8) AS DOUBLE) AS avg_cost_per_chunk
  FROM embedded e JOIN chunks USING (chunk_id) GROUP BY embed_date, e.tenant_id, embedding_model, modality)
"""


@query(f"WITH {DOCS_SQL}, {FRESHNESS_SQL} SELECT * FROM freshness")
def freshness_kpi(spark, sf):
    return _freshness(spark, sf)


@query(f"""WITH {DOCS_SQL} SELECT tenant_id, count(*) AS unknown_chunk_count FROM chunks
WHERE doc_id NOT IN (SELECT doc_id FROM registry) GROUP BY tenant_id""")
def unknown_hash_chunks(spark, sf):
    return marts.unknown_hashes(chunks(spark, sf), current_hashes(spark, sf))


@query(f"WITH {RETRIEVAL_SQL}, {QUALITY_SQL} SELECT * FROM quality")
def retrieval_quality_kpi(spark, sf):
    return _quality(spark, sf)


@query(f"WITH {DOCS_SQL}, {COST_SQL} SELECT * FROM cost")
def embedding_cost_kpi(spark, sf):
    return _cost(spark, sf)


@query(f"""WITH {DOCS_SQL}, {RETRIEVAL_SQL},
good AS (SELECT 'd' || CAST(doc_id AS VARCHAR) || '-0' AS chunk_id FROM labels WHERE quality = 1),
per_query AS (
  SELECT event_id, event_date, tenant_id, query_modality, count(g.chunk_id) AS good,
    min(CASE WHEN g.chunk_id IS NOT NULL THEN rank END) AS first_rank
  FROM hits LEFT JOIN good g USING (chunk_id) GROUP BY ALL)
SELECT event_date, tenant_id, query_modality, count(*) AS queries, CAST(round(CAST(avg(good / 5.0::DOUBLE) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS precision_at_k,
  CAST(round(CAST(avg(coalesce(1.0::DOUBLE / first_rank, 0)) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS mrr
FROM per_query GROUP BY event_date, tenant_id, query_modality""")
def precision_mrr(spark, sf):
    good = load(spark, sf, "labels").where("quality = 1").select(
        F.concat(F.lit("d"), "doc_id", F.lit("-0")).alias("chunk_id")
    )
    return marts.precision_and_mrr(_events(spark, sf), good)


@query(f"""WITH {DOCS_SQL}, {FRESHNESS_SQL} SELECT tenant_id, CAST(sum(stale_chunk_count) AS BIGINT) AS stale,
  CAST(sum(total_chunk_count) AS BIGINT) AS total,
  CAST(round(CAST(1.0 - sum(stale_chunk_count)::DOUBLE / sum(total_chunk_count) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS freshness
FROM freshness GROUP BY tenant_id""")
def q1_freshness(spark, sf):
    return marts.freshness_by_tenant(_freshness(spark, sf))


@query(f"""WITH {DOCS_SQL}, {COST_SQL} SELECT modality, CAST(sum(embed_request_count) AS BIGINT) AS requests,
  CAST(sum(total_tokens) AS BIGINT) AS tokens, CAST(round(CAST(sum(total_cost_usd) AS DECIMAL(38, 12)), 6) AS DOUBLE) AS cost_usd FROM cost GROUP BY modality""")
def q2_cost(spark, sf):
    return marts.cost_by_modality(_cost(spark, sf))


@query(f"""WITH {RETRIEVAL_SQL}, {QUALITY_SQL} SELECT query_modality, CAST(sum(total_queries) AS BIGINT) AS queries,
  CAST(round(CAST(avg(zero_hit_rate) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS avg_zero_hit, CAST(round(CAST(avg(avg_top1_score) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS avg_score,
  CAST(round(CAST(avg(p95_latency_ms) AS DECIMAL(38, 6)), 0) AS DOUBLE) AS avg_p95_latency_ms FROM quality GROUP BY query_modality""")
def q3_quality(spark, sf):
    return marts.quality_by_modality(_quality(spark, sf))


@query(f"""WITH {DOCS_SQL}, {FRESHNESS_SQL} SELECT modality, oldest_stale_embed_ts, pending_reembed_cost_usd FROM freshness
WHERE tenant_id = 'src4' AND stale_chunk_count > 0 ORDER BY oldest_stale_embed_ts, modality LIMIT 10""")
def stalest_top10(spark, sf):
    return marts.stalest_groups(_freshness(spark, sf), "src4")


@query(f"""WITH {DOCS_SQL} SELECT chunk_id, doc_id, doc_version_hash, current_hash
FROM chunks JOIN registry USING (doc_id) WHERE current_hash <> doc_version_hash""")
def stale_chunk_staging(spark, sf):
    found = rag.stale_chunks(chunks(spark, sf), current_hashes(spark, sf))
    return found.select("chunk_id", "doc_id", "doc_version_hash", "current_hash")


@query(f"""WITH {DOCS_SQL}, {FRESHNESS_SQL} SELECT CAST(sum(stale_chunk_count) AS BIGINT) AS stale_chunks,
  CAST(sum(total_chunk_count) AS BIGINT) AS total_chunks,
  CAST(round(CAST(1 - sum(stale_chunk_count)::DOUBLE / sum(total_chunk_count) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS freshness_ratio,
  CAST(round(CAST(sum(pending_reembed_cost_usd) AS DECIMAL(38, 12)), 6) AS DOUBLE) AS pending_cost_usd FROM freshness""")
def stale_overview(spark, sf):
    return alerts.stale_summary(_freshness(spark, sf))


@query(f"""WITH {DOCS_SQL}, {FRESHNESS_SQL} SELECT tenant_id, modality, stale_chunk_count, total_chunk_count
FROM freshness WHERE stale_chunk_count::DOUBLE / total_chunk_count > 0.2""")
def stale_alert_lines(spark, sf):
    return alerts.stale_alerts(_freshness(spark, sf), above=0.2)


@query(f"""WITH {RETRIEVAL_SQL}, {QUALITY_SQL} SELECT report_date, tenant_id, query_modality, zero_hit_rate
FROM quality WHERE zero_hit_rate > 0.25""")
def zero_hit_alert_lines(spark, sf):
    return alerts.zero_hit_alerts(_quality(spark, sf))


@query(f"""WITH {DOCS_SQL}, n AS (SELECT (SELECT count(*) FROM docs) AS bronze_rows, (SELECT count(DISTINCT doc_id) FROM embedded) AS silver_rows)
SELECT *, silver_rows < bronze_rows * 0.9 AS alert FROM n""")
def dropped_documents_alert(spark, sf):
    return alerts.dropped_rows_alert(raw_documents(spark, sf), chunk_embeddings(spark, sf).select("doc_id").distinct())


@query(f"""WITH {DOCS_SQL}, {COST_SQL}, daily AS (SELECT tenant_id, report_date, sum(total_cost_usd) AS cost_usd FROM cost GROUP BY ALL),
b AS (SELECT *, avg(cost_usd) OVER (PARTITION BY tenant_id ORDER BY report_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS baseline_usd FROM daily)
SELECT tenant_id, report_date, CAST(round(CAST(cost_usd AS DECIMAL(38, 12)), 6) AS DOUBLE) AS cost_usd, CAST(round(CAST(baseline_usd AS DECIMAL(38, 12)), 6) AS DOUBLE) AS baseline_usd FROM b WHERE cost_usd > baseline_usd * 1.5""")
def cost_alert_days(spark, sf):
    found = alerts.cost_alerts(_cost(spark, sf))
    return found.withColumns({c: rounded(c, 6) for c in ("cost_usd", "baseline_usd")})


@query(f"""WITH {DOCS_SQL}, r AS (
  SELECT 'hash present' AS rule, count(*) FILTER (WHERE NOT coalesce(doc_version_hash IS NOT NULL, FALSE)) AS failed, count(*) AS total FROM chunks
  UNION ALL SELECT 'text longer than 10', count(*) FILTER (WHERE NOT length(chunk_text) > 10), count(*) FROM chunks
  UNION ALL SELECT 'full window or last', count(*) FILTER (WHERE char_count > 400), count(*) FROM chunks)
SELECT *, failed = 0 AS passed FROM r""")
def chunk_gates(spark, sf):
    return alerts.quality_gates(
        chunks(spark, sf),
        {
            "hash present": F.col("doc_version_hash").isNotNull(),
            "text longer than 10": F.length("chunk_text") > 10,
            "full window or last": F.col("char_count") <= 400,
        },
    )


@query("""WITH r AS (SELECT 'vector length' AS rule, count(*) FILTER (WHERE len(embedding) <> 64) AS failed, count(*) AS total FROM embeddings
  UNION ALL SELECT 'label known', count(*) FILTER (WHERE label IS NULL), count(*) FROM embeddings)
SELECT *, failed = 0 AS passed FROM r""")
def vector_gates(spark, sf):
    rules = {"vector length": F.size("embedding") == 64, "label known": F.col("label").isNotNull()}
    return alerts.quality_gates(load(spark, sf, "embeddings"), rules)


@query(f"""WITH {DOCS_SQL}, {FRESHNESS_SQL}, {RETRIEVAL_SQL}, {QUALITY_SQL}, r AS (
  SELECT 'ratio in range' AS rule, count(*) FILTER (WHERE NOT freshness_ratio BETWEEN 0 AND 1) AS failed, count(*) AS total FROM freshness
  UNION ALL SELECT 'zero hits below half', count(*) FILTER (WHERE NOT zero_hit_rate < 0.5), count(*) FROM quality)
SELECT *, failed = 0 AS passed FROM r""")
def mart_gates(spark, sf):
    ratio = {"ratio in range": F.col("freshness_ratio").between(0, 1)}
    zero = {"zero hits below half": F.col("zero_hit_rate") < 0.5}
    return alerts.quality_gates(_freshness(spark, sf), ratio).union(alerts.quality_gates(_quality(spark, sf), zero))


@query(f"""WITH {RETRIEVAL_SQL}, {QUALITY_SQL}, bad AS (SELECT * FROM quality WHERE zero_hit_rate > 0.5)
SELECT r.event_date, r.tenant_id, r.query_modality, r.event_id, r.bronze_kafka_offset, r.bronze_log_id
FROM retrieval r WHERE (r.event_date, r.tenant_id, r.query_modality) IN (SELECT (report_date, tenant_id, query_modality) FROM bad)""")
def lineage_trace(spark, sf):
    events = _events(spark, sf)
    bad = alerts.zero_hit_alerts(marts.quality_kpi(events), above=0.5)
    keys = {"report_date": "event_date", "tenant_id": "tenant_id", "query_modality": "query_modality"}
    logs = raw_retrieval_logs(spark, sf).select("log_id", "raw_payload")
    rows = alerts.lineage(bad, events, logs, keys, ("bronze_log_id", "log_id"))
    return rows.select("event_date", "tenant_id", "query_modality", "event_id", "bronze_kafka_offset", "bronze_log_id")


@query(f"""WITH {DOCS_SQL}, stale AS (SELECT chunk_id FROM chunks JOIN registry USING (doc_id) WHERE current_hash <> doc_version_hash)
SELECT DATE '2026-02-15' AS embed_date, tenant_id, '{EMBEDDING_MODEL}' AS embedding_model, modality, count(*) AS reembed_count
FROM chunks WHERE chunk_id IN (SELECT chunk_id FROM stale) AND chunk_id IN (SELECT chunk_id FROM embedded) GROUP BY ALL""")
def reembed_per_day(spark, sf):
    cut = _chunks(spark, sf)
    made = chunk_embeddings(spark, sf, cut)
    changed = rag.stale_chunks(cut, current_hashes(spark, sf)).select("doc_id").distinct()
    batch = rag.reembed_batch(cut, changed, EMBEDDING_MODEL, ntz("2026-02-15 06:00:00"))
    history = made.withColumn("embed_version", F.lit(1)).unionByName(batch.withColumn("embed_version", F.lit(2)))
    return rag.reembed_counts(history, cut)


@query(f"""WITH {DOCS_SQL}, stale AS (SELECT doc_id FROM chunks JOIN registry USING (doc_id) WHERE current_hash <> doc_version_hash)
SELECT chunk_id, CASE WHEN doc_id IN (SELECT doc_id FROM stale) THEN 'r-' ELSE 'e-' END || chunk_id AS embedding_id,
  CASE WHEN doc_id IN (SELECT doc_id FROM stale) THEN TIMESTAMP '2026-02-15 06:00:00' ELSE embed_ts END AS embed_ts, prompt_tokens, cost_usd
FROM embedded""")
def reembed_merge(spark, sf):
    cut = _chunks(spark, sf)
    changed = rag.stale_chunks(cut, current_hashes(spark, sf)).select("doc_id").distinct()
    batch = rag.reembed_batch(cut, changed, EMBEDDING_MODEL, ntz("2026-02-15 06:00:00"))
    merged = rag.reembed(chunk_embeddings(spark, sf, cut), batch)
    return merged.select("chunk_id", "embedding_id", "embed_ts", "prompt_tokens", "cost_usd")


# the directory of tenants: which log tenant the documents of a source belong to
_TENANT = """CASE CAST(substr(tenant_id, 4) AS INTEGER) % 5 WHEN 0 THEN 'tenant-click' WHEN 1 THEN 'tenant-view'
  WHEN 2 THEN 'tenant-purchase' WHEN 3 THEN 'tenant-signup' ELSE 'tenant-error' END"""


@query(f"""WITH {DOCS_SQL}, {FRESHNESS_SQL}, {RETRIEVAL_SQL}, {QUALITY_SQL},
sick AS (SELECT tenant_id, CAST(round(CAST(sum(zero_hit_count)::DOUBLE / sum(total_queries) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS zero_hit_rate FROM quality GROUP BY tenant_id),
ends AS (SELECT tenant_id, min(event_date) AS lo, max(event_date) AS hi FROM retrieval GROUP BY tenant_id),
halves AS (SELECT r.tenant_id, top1_score, event_date > lo + CAST(floor(date_diff('day', lo, hi) / 2) AS INTEGER) AS late FROM retrieval r JOIN ends USING (tenant_id)),
fresh AS (SELECT {_TENANT} AS tenant_id, CAST(round(CAST(sum(fresh_chunk_count)::DOUBLE / sum(total_chunk_count) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS freshness_ratio
  FROM freshness GROUP BY 1)
SELECT tenant_id, zero_hit_rate, freshness_ratio, score_before, score_after
FROM sick LEFT JOIN fresh USING (tenant_id) JOIN (SELECT tenant_id, CAST(round(CAST(avg(top1_score) FILTER (WHERE NOT late) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS score_before,
  CAST(round(CAST(avg(top1_score) FILTER (WHERE late) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS score_after FROM halves GROUP BY tenant_id) USING (tenant_id)
WHERE zero_hit_rate > 0.25""")
def incident_triage(spark, sf):
    events = _events(spark, sf)
    fresh = _freshness(spark, sf).withColumn("tenant_id", F.expr(_TENANT))
    return alerts.triage(marts.quality_kpi(events), fresh, events)


@query(f"""WITH {RETRIEVAL_SQL},
ends AS (SELECT tenant_id, min(event_date) AS lo, max(event_date) AS hi FROM retrieval GROUP BY tenant_id),
halves AS (SELECT r.tenant_id, top1_score, event_date > lo + CAST(floor(date_diff('day', lo, hi) / 2) AS INTEGER) AS late FROM retrieval r JOIN ends USING (tenant_id)),
scores AS (SELECT tenant_id, top1_score AS score, CAST(count(*) FILTER (WHERE NOT late) AS DOUBLE) AS b, CAST(count(*) FILTER (WHERE late) AS DOUBLE) AS a
  FROM halves GROUP BY ALL),
steps AS (SELECT tenant_id, sum(b) OVER w / sum(b) OVER (PARTITION BY tenant_id) AS fb, sum(a) OVER w / sum(a) OVER (PARTITION BY tenant_id) AS fa
  FROM scores WINDOW w AS (PARTITION BY tenant_id ORDER BY score)),
bins AS (SELECT tenant_id, greatest(0, least(9, floor(score * 10))) AS bin, sum(b) AS b, sum(a) AS a FROM scores GROUP BY ALL),
shares AS (SELECT tenant_id, greatest(b / sum(b) OVER w, 0.0001::DOUBLE) AS b, greatest(a / sum(a) OVER w, 0.0001::DOUBLE) AS a FROM bins WINDOW w AS (PARTITION BY tenant_id))
SELECT tenant_id, scores_before, scores_after, ks, psi FROM
  (SELECT tenant_id, CAST(sum(b) AS BIGINT) AS scores_before, CAST(sum(a) AS BIGINT) AS scores_after FROM scores GROUP BY tenant_id)
  JOIN (SELECT tenant_id, CAST(round(CAST(max(abs(fb - fa)) AS DECIMAL(38, 12)), 6) AS DOUBLE) AS ks FROM steps GROUP BY tenant_id) USING (tenant_id)
  JOIN (SELECT tenant_id, CAST(round(CAST(sum((a - b) * ln(a / b)) AS DECIMAL(38, 12)), 6) AS DOUBLE) AS psi FROM shares GROUP BY tenant_id) USING (tenant_id)""")
def score_drift(spark, sf):
    return alerts.score_drift(_events(spark, sf))


@query("""SELECT CASE WHEN age <= 7 THEN 'hot' WHEN age <= 20 THEN 'warm' ELSE 'cold' END AS tier, count(*) AS events,
  count(DISTINCT day) AS days FROM (SELECT CAST(ts AS DATE) AS day, date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') AS age FROM events) GROUP BY 1""")
def age_tiers(spark, sf):
    day = F.to_date("ts")
    tier = alerts.age_tier(F.lit("2024-01-31").cast("date"), day, (("hot", 7), ("warm", 20)))
    return load(spark, sf, "events").groupBy(tier.alias("tier")).agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct(day).alias("days")
    )


@query("""WITH e AS (
  SELECT 'supplier-' || l_suppkey AS source, 'order-' || l_orderkey AS target FROM lineitem
  UNION SELECT 'order-' || o_orderkey, 'customer-' || o_custkey FROM orders
  UNION SELECT 'customer-' || c_custkey, 'segment-' || c_mktsegment FROM customer),
d0 AS (SELECT 'supplier-' || s_suppkey AS node FROM supplier WHERE s_acctbal < 0),
d1 AS (SELECT DISTINCT target AS node FROM e WHERE source IN (SELECT node FROM d0)),
d2 AS (SELECT DISTINCT target AS node FROM e WHERE source IN (SELECT node FROM d1)),
d3 AS (SELECT DISTINCT target AS node FROM e WHERE source IN (SELECT node FROM d2))
SELECT node, 0 AS depth FROM d0 UNION ALL SELECT node, 1 FROM d1 UNION ALL SELECT node, 2 FROM d2 UNION ALL SELECT node, 3 FROM d3""")
def impact_report(spark, sf):
    """What hangs on the suppliers in debt: their orders, those customers, their segments."""

    def edges(name, kind, key, to, other):
        return load(spark, sf, name).select(
            F.concat_ws("-", F.lit(kind), key).alias("source"), F.concat_ws("-", F.lit(to), other).alias("target")
        )

    graph = (
        edges("lineitem", "supplier", "l_suppkey", "order", "l_orderkey")
        .union(edges("orders", "order", "o_orderkey", "customer", "o_custkey"))
        .union(edges("customer", "customer", "c_custkey", "segment", "c_mktsegment"))
    )
    start = load(spark, sf, "supplier").where("s_acctbal < 0")
    return downstream(graph, start.select(F.concat_ws("-", F.lit("supplier"), "s_suppkey").alias("node")))

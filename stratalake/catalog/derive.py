"""Lakehouse inputs derived from the given tables, in Spark and as SQL for the check.

``events`` stands in for the call log and the retrieval log, ``documents`` for the document store and
``labels`` for the registry of withdrawn and revised documents. Every derivation reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.text import fingerprint
from stratalake.plans.rag import document_chunks, embedding_rows
from stratalake.plans.settings import EMBEDDING_MODEL
from stratalake.sources.parquet import load, spread_small

AS_OF = "2026-03-01"
CHUNK_SIZE = 400
CHUNK_OVERLAP = 50


def ntz(text: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


# ── call log ────────────────────────────────────────────────────────────────────────────────────

_MODEL = """CASE event_type WHEN 'click' THEN 'small' WHEN 'view' THEN CASE WHEN value < 1 THEN NULL ELSE 'small' END
  WHEN 'purchase' THEN 'medium' WHEN 'signup' THEN 'large' ELSE 'unlisted' END"""
_STATUS = "CASE WHEN value > 200 THEN 'error' WHEN value > 100 THEN 'rate_limited' ELSE 'ok' END"
_BROKEN = "event_type = 'purchase' AND value > 150"


def raw_calls(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze call log: retries share user, type and day; dear purchases have a cut-off payload."""
    k = F.from_json("props", "k int")["k"]
    body = F.to_json(
        F.struct(
            F.expr(_MODEL).alias("model"),
            F.concat(F.lit("u_"), F.col("user_id")).alias("user_id"),
            F.struct((k * 40 + 50).alias("input"), (k * 20 + 20).alias("output")).alias("usage"),
            F.floor(F.col("value") * 10).cast("int").alias("latency_ms"),
            F.expr(_STATUS).alias("status"),
        )
    )
    return spread_small(load(spark, sf, "events"), "event_id").select(
        F.concat_ws("-", F.col("user_id"), "event_type", F.to_date("ts")).alias("request_id"),
        "ts",
        F.when(F.expr(_BROKEN), F.substring(body, 1, 20)).otherwise(body).alias("raw_json"),
    )


CALLS_SQL = f"""
calls_all AS (
  SELECT concat_ws('-', CAST(user_id AS VARCHAR), event_type, CAST(CAST(ts AS DATE) AS VARCHAR)) AS request_id,
    ts, CAST(ts AS DATE) AS date, {_MODEL} AS model, 'u_' || CAST(user_id AS VARCHAR) AS user_id,
    CAST(json_extract(props, '$.k') AS INTEGER) * 40 + 50 AS prompt_tokens,
    CAST(json_extract(props, '$.k') AS INTEGER) * 20 + 20 AS completion_tokens,
    CAST(floor(value * 10) AS INTEGER) AS latency_ms, {_STATUS} AS status,
    {_BROKEN} AS broken
  FROM events),
silver AS (
  SELECT * EXCLUDE (rn, broken) FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ts) AS rn
    FROM calls_all WHERE NOT broken AND model IS NOT NULL)
  WHERE rn = 1),
prices(model, usd_in, usd_out) AS (VALUES ('small', 0.80, 4.00), ('medium', 3.00, 15.00), ('large', 15.00, 75.00))
"""


# ── document store ──────────────────────────────────────────────────────────────────────────────

_MODALITY = "CASE lang WHEN 'en' THEN 'text' WHEN 'fr' THEN 'audio_transcript' ELSE 'image_caption' END"


def raw_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze documents; ids are text, ingest times are spread over January 2026."""
    ingest = F.expr("timestampadd(MINUTE, CAST(doc_id * 37 % 43200 AS INT), TIMESTAMP_NTZ'2026-01-01 00:00:00')")
    return spread_small(load(spark, sf, "documents"), "doc_id").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("doc_id"),
        F.col("source").alias("tenant_id"),
        F.expr(_MODALITY).alias("modality"),
        "text",
        fingerprint(F.col("text")).alias("doc_hash"),
        ingest.alias("ingest_ts"),
        F.to_date(ingest).alias("ingest_date"),
    )


def current_hashes(spark: SparkSession, sf: str) -> DataFrame:
    """Registry of document hashes: poor documents were revised, toxic ones withdrawn."""
    labels = load(spark, sf, "labels").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("doc_id"), "quality", "toxic"
    )
    docs = raw_documents(spark, sf).select("doc_id", "doc_hash")
    revised = F.when(F.col("quality") == 0, fingerprint(F.concat("doc_hash", F.lit("#2"))))
    return (
        docs.join(labels, "doc_id", "left")
        .where(F.coalesce(F.col("toxic"), F.lit(0)) == 0)
        .select("doc_id", F.coalesce(revised, F.col("doc_hash")).alias("current_hash"))
    )


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return document_chunks(raw_documents(spark, sf), CHUNK_SIZE, CHUNK_OVERLAP, run_id="run-1")


def chunk_embeddings(spark: SparkSession, sf: str, cut: DataFrame | None = None) -> DataFrame:
    """One embedding record per chunk of an unlabelled or harmless document, without the vector.

    ``cut`` takes chunks that are there already.
    """
    withdrawn = load(spark, sf, "labels").where("toxic = 1").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("doc_id")
    )
    cut = chunks(spark, sf) if cut is None else cut
    return embedding_rows(cut.join(withdrawn, "doc_id", "left_anti"), EMBEDDING_MODEL)


DOCS_SQL = f"""
docs AS (
  SELECT 'd' || CAST(doc_id AS VARCHAR) AS doc_id, source AS tenant_id, {_MODALITY} AS modality, text,
    sha256(text) AS doc_hash,
    TIMESTAMP '2026-01-01 00:00:00' + to_minutes(CAST(doc_id * 37 % 43200 AS BIGINT)) AS ingest_ts
  FROM documents),
lab AS (SELECT 'd' || CAST(doc_id AS VARCHAR) AS doc_id, quality, toxic FROM labels),
registry AS (
  SELECT doc_id, CASE WHEN quality = 0 THEN sha256(doc_hash || '#2') ELSE doc_hash END AS current_hash
  FROM docs LEFT JOIN lab USING (doc_id) WHERE coalesce(toxic, 0) = 0),
pieces AS (
  SELECT doc_id, tenant_id, modality, doc_hash AS doc_version_hash, ingest_ts, i AS chunk_index,
    substr(text, CAST(i * {CHUNK_SIZE - CHUNK_OVERLAP} + 1 AS BIGINT), {CHUNK_SIZE}) AS chunk_text
  FROM (SELECT *, unnest(range(CAST(CASE WHEN length(text) <= {CHUNK_SIZE} THEN 1
    ELSE ceil((length(text) - {CHUNK_OVERLAP}) / {CHUNK_SIZE - CHUNK_OVERLAP}.0) END AS BIGINT))) AS i FROM docs WHERE length(text) > 0)),
chunks AS (
  SELECT doc_id || '-' || CAST(chunk_index AS VARCHAR) AS chunk_id, doc_id, doc_version_hash,
    CAST(chunk_index AS INTEGER) AS chunk_index, chunk_text, modality,
    CAST(length(chunk_text) AS INTEGER) AS char_count, CAST(length(chunk_text) // 4 AS INTEGER) AS token_estimate,
    tenant_id, ingest_ts + to_minutes(1 + chunk_index % 10) AS chunk_ts
  FROM pieces),
embedded AS (
  SELECT 'e-' || chunk_id AS embedding_id, chunk_id, doc_id, tenant_id,
    '{EMBEDDING_MODEL}' AS embedding_model, chunk_ts + to_minutes(1 + chunk_index % 5) AS embed_ts,
    CAST(chunk_ts + to_minutes(1 + chunk_index % 5) AS DATE) AS embed_date, token_estimate AS prompt_tokens,
    round(token_estimate / 1000.0::DOUBLE * 0.00013::DOUBLE, 8) AS cost_usd
  FROM chunks WHERE doc_id NOT IN (SELECT doc_id FROM lab WHERE toxic = 1))
"""


# ── retrieval log ───────────────────────────────────────────────────────────────────────────────

_QUERY_MODALITY = "CASE WHEN k <= 33 THEN 'text' WHEN k <= 66 THEN 'image_caption' ELSE 'audio_transcript' END"
_TOP = "(k * 37 + user_id * 11 + event_id * 7) % 9900 + 100"


def raw_retrieval_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze retrieval log: one JSON payload per event with five ranked chunks and their scores.

    The hits go over all documents, one after the other.
    """
    documents = F.lit(load(spark, sf, "documents").count())
    events = spread_small(load(spark, sf, "events"), "event_id").withColumn("k", F.from_json("props", "k int")["k"])
    events = events.withColumn("top", F.expr(_TOP))
    ranks = F.array(*[F.lit(i) for i in range(5)])
    tenant = F.concat(F.lit("tenant-"), F.col("event_type"))
    payload = F.to_json(
        F.struct(
            F.concat(F.lit("ev-"), F.col("event_id")).alias("event_id"),
            F.concat(F.lit("q-"), F.col("event_id")).alias("query_id"),
            F.concat(F.lit("user_"), F.col("user_id")).alias("user_id"),
            tenant.alias("tenant_id"),
            F.concat(F.lit("where is item "), F.col("k")).alias("query_text"),
            F.expr(_QUERY_MODALITY).alias("query_modality"),
            F.transform(ranks, lambda i: F.concat(F.lit("d"), (F.col("event_id") + i * 7) % documents, F.lit("-0"))).alias(
                "retrieved_chunk_ids"
            ),
            F.transform(ranks, lambda i: F.floor(F.col("top") * (10 - i) / 10) / 10000).alias("relevance_scores"),
            (F.floor(F.col("value") * 10) + 50).cast("int").alias("latency_ms"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
        )
    )
    return events.select(
        F.concat(F.lit("log-"), F.col("event_id")).alias("log_id"),
        payload.alias("raw_payload"),
        tenant.alias("tenant_id"),
        F.col("ts").alias("ingest_ts"),
        F.to_date("ts").alias("ingest_date"),
        (F.col("event_id") + 1_000_000).alias("kafka_offset"),
        F.lit("v1").alias("schema_version"),
    )


RETRIEVAL_SQL = f"""
logs AS (
  SELECT *, {_TOP} AS top, {_QUERY_MODALITY} AS query_modality
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events), (SELECT count(*) AS n_docs FROM documents)),
retrieval AS (
  SELECT 'ev-' || CAST(event_id AS VARCHAR) AS event_id, 'q-' || CAST(event_id AS VARCHAR) AS query_id,
    sha256('user_' || CAST(user_id AS VARCHAR)) AS user_id, 'tenant-' || event_type AS tenant_id,
    sha256('where is item ' || CAST(k AS VARCHAR)) AS query_text_hash, query_modality,
    [ 'd' || CAST((event_id + i * 7) % n_docs AS VARCHAR) || '-0' FOR i IN range(5) ] AS ids,
    [ CAST(floor(top * (10 - i) / 10.0) AS DOUBLE) / 10000 FOR i IN range(5) ] AS scores,
    'd' || CAST(event_id % n_docs AS VARCHAR) || '-0' AS top1_chunk_id,
    CAST(top AS DOUBLE) / 10000 AS top1_score, top / 10000.0 < 0.30 AS is_zero_hit,
    CAST(floor(value * 10) AS INTEGER) + 50 AS latency_ms, ts AS event_ts, CAST(ts AS DATE) AS event_date,
    'log-' || CAST(event_id AS VARCHAR) AS bronze_log_id, event_id + 1000000 AS bronze_kafka_offset
  FROM logs),
hits AS (
  SELECT event_id, event_date, tenant_id, query_modality, unnest(ids) AS chunk_id, unnest(scores) AS score,
    unnest(range(1, 6)) AS rank
  FROM retrieval)
"""

"""Vector search and retrieval events."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.catalog.derive import (
    DOCS_SQL,
    RETRIEVAL_SQL,
    chunk_embeddings,
    chunks,
    ntz,
    raw_retrieval_logs,
)
from stratalake.catalog.registry import Registry
from stratalake.functions.measures import rounded
from stratalake.operators.dedup import first_per_key
from stratalake.operators.knn import centroids, knn
from stratalake.plans.rag import (
    eval_update,
    hit_stats,
    pending_chunks,
    ranked_hits,
    retrieval_events,
    vectors_of,
)
from stratalake.session import fresh_path
from stratalake.sources import snapshots
from stratalake.sources.parquet import load

registry = Registry()
query = registry.query


def _vectors(spark, sf):
    return load(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


_SCORE = """list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v)) + 1e-9)"""


@query(f"""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
p AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(round(CAST({_SCORE} AS DECIMAL(38, 12)), 6) AS DOUBLE) AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT query_id, vec_id, CAST(round(CAST(score AS DECIMAL(38, 10)), 4) AS DOUBLE) AS score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p) WHERE rank <= 5""")
def knn_top5(spark, sf):
    vectors = _vectors(spark, sf).select("id", "vector")
    return knn(vectors, vectors, 5, exclude_self=True).withColumn("score", rounded("score", 4))


@query(f"""WITH e AS (SELECT 'chunk-' || CAST(vec_id AS VARCHAR) AS id, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 10 <> 3),
p AS (SELECT a.id AS query_id, b.id AS vec_id, CAST(round(CAST({_SCORE} AS DECIMAL(38, 12)), 6) AS DOUBLE) AS score
  FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.vec_id % 50 = 0)
SELECT query_id, vec_id, CAST(round(CAST(score AS DECIMAL(38, 10)), 4) AS DOUBLE) AS score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p) WHERE rank <= 5""")
def knn_chunk_neighbours(spark, sf):
    """Neighbours of the same label for a query set, with text ids; every tenth vector is broken and takes no part."""
    broken = F.when(F.col("id") % 10 == 3, F.transform("vector", lambda x, i: F.when(i == 0, F.lit(float("nan"))).otherwise(x))).otherwise(F.col("vector"))
    vectors = _vectors(spark, sf).select(F.concat(F.lit("chunk-"), "id").alias("id"), broken.alias("vector"), "label", F.col("id").alias("n"))
    found = knn(vectors.where("n % 50 = 0"), vectors, 5, exclude_self=True, within=["label"])
    return found.withColumn("score", rounded("score", 4))


CENTROID_SQL = f"""WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
parts AS (SELECT label, unnest(v) AS x, unnest(range(len(v))) AS dim FROM e),
means AS (SELECT label, dim, avg(x) AS x FROM parts GROUP BY ALL),
c AS (SELECT CAST(label AS BIGINT) AS id, list(x ORDER BY dim) AS v FROM means GROUP BY label),
p AS (SELECT a.id AS query_id, b.vec_id, CAST(round(CAST({_SCORE} AS DECIMAL(38, 12)), 6) AS DOUBLE) AS score FROM c a CROSS JOIN e b)
SELECT query_id, vec_id, CAST(round(CAST(score AS DECIMAL(38, 10)), 4) AS DOUBLE) AS score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p) WHERE rank <= 5"""


@query(CENTROID_SQL)
def knn_label_centroids(spark, sf):
    vectors = _vectors(spark, sf)
    found = knn(centroids(vectors, "label"), vectors.select("id", "vector"), 5)
    return found.withColumn("score", rounded("score", 4))


@query(CENTROID_SQL)
def knn_as_of_version(spark, sf):
    """Search in an old version after a model upgrade replaced every vector (C-6)."""
    path = fresh_path(spark, "vectors")
    first = _vectors(spark, sf).withColumn("embedding_model", F.lit("v1"))
    snapshots.write_table(first, path)
    upgraded = first.withColumn("vector", F.reverse("vector")).withColumn("embedding_model", F.lit("v2"))
    snapshots.write_table(upgraded, path)
    cited = vectors_of(snapshots.read_table(spark, path, 0), "v1")
    found = knn(centroids(cited, "label"), cited.select("id", "vector"), 5)
    return found.withColumn("score", rounded("score", 4))


@query(f"""WITH {RETRIEVAL_SQL} SELECT event_id, query_id, user_id, tenant_id, query_text_hash, query_modality, top1_chunk_id,
  top1_score, is_zero_hit, latency_ms, event_ts, event_date, bronze_log_id, bronze_kafka_offset FROM retrieval""")
def retrieval_event_rows(spark, sf):
    return retrieval_events(raw_retrieval_logs(spark, sf)).drop("retrieved_chunk_ids", "relevance_scores")


@query(f"WITH {RETRIEVAL_SQL} SELECT event_id, chunk_id, score, CAST(rank AS INTEGER) AS rank FROM hits")
def ranked_hit_rows(spark, sf):
    hits = ranked_hits(retrieval_events(raw_retrieval_logs(spark, sf)))
    return hits.select("event_id", "chunk_id", "score", "rank")


@query(f"""WITH {RETRIEVAL_SQL} SELECT chunk_id, CAST(count(score) AS INTEGER) AS retrieval_hit_count,
  CAST(round(CAST(avg(score) AS DECIMAL(38, 12)), 6) AS DOUBLE) AS avg_relevance_score FROM hits GROUP BY chunk_id""")
def eval_hits(spark, sf):
    stats = hit_stats(retrieval_events(raw_retrieval_logs(spark, sf)))
    return stats.withColumn("avg_relevance_score", rounded("avg_relevance_score", 6))


@query(f"""WITH {DOCS_SQL}, {RETRIEVAL_SQL},
st AS (SELECT chunk_id, CAST(count(score) AS INTEGER) AS n, CAST(round(CAST(avg(score) AS DECIMAL(38, 12)), 6) AS DOUBLE) AS m FROM hits GROUP BY chunk_id)
SELECT embedding_id, e.chunk_id, n AS retrieval_hit_count, m AS avg_relevance_score,
  CASE WHEN n IS NOT NULL THEN TIMESTAMP '2026-02-01 00:00:00' END AS eval_updated_ts
FROM embedded e LEFT JOIN st ON e.chunk_id = st.chunk_id""")
def eval_score_update(spark, sf):
    events = retrieval_events(raw_retrieval_logs(spark, sf))
    updated = eval_update(chunk_embeddings(spark, sf), events, ntz("2026-02-01 00:00:00"))
    return updated.select(
        "embedding_id",
        "chunk_id",
        "retrieval_hit_count",
        rounded("avg_relevance_score", 6).alias("avg_relevance_score"),
        "eval_updated_ts",
    )


@query(f"WITH {DOCS_SQL} SELECT chunk_id FROM chunks WHERE chunk_id NOT IN (SELECT chunk_id FROM embedded)")
def pending_embedding(spark, sf):
    return pending_chunks(chunks(spark, sf), chunk_embeddings(spark, sf)).select("chunk_id")


@query(f"WITH {RETRIEVAL_SQL} SELECT bronze_log_id AS log_id, bronze_kafka_offset AS kafka_offset FROM retrieval")
def replayed_log_dedup(spark, sf):
    logs = raw_retrieval_logs(spark, sf)
    replay = logs.where("tenant_id <> 'tenant-view'").withColumn(
        "ingest_ts", F.timestamp_add("HOUR", F.lit(1), F.col("ingest_ts"))
    )
    kept = first_per_key(logs.unionByName(replay), ["kafka_offset"], ["ingest_ts"])
    return kept.select("log_id", "kafka_offset")

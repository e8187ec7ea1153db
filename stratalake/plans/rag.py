"""Document store: chunks, embedding records, retrieval events and the re-embed and eval flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.payload import is_corrupt, parse_payload, text_array, zip_shortest
from stratalake.functions.text import embedding_cost, fingerprint, token_estimate, sentence_windows_of, windows_of
from stratalake.operators.merge import merge
from stratalake.plans.settings import EMBED_USD_PER_1K_TOKENS, ZERO_HIT_SCORE
from stratalake.sources.snapshots import write_table

RETRIEVAL_SCHEMA = (
    "event_id string, query_id string, user_id string, tenant_id string, query_text string, "
    "query_modality string, retrieved_chunk_ids array<string>, relevance_scores array<double>, "
    "latency_ms int, ts string"
)


def _minutes_after(ts: str, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes.cast("int"), F.col(ts))


def ingest_bronze(docs: DataFrame, logs: DataFrame, root: str) -> dict[str, str]:
    """Land documents and retrieval logs as they are, by ingest date; returns the table paths (M-4)."""
    paths = {"raw_documents": f"{root}/raw_documents", "raw_retrieval_logs": f"{root}/raw_retrieval_logs"}
    for df, path in zip((docs, logs), paths.values()):
        write_table(df, path, mode="append", partition_by=["ingest_date"])
    return paths


def document_chunks(docs: DataFrame, size: int, overlap: int, run_id: str, sentences: bool = False) -> DataFrame:
    """Overlapping text windows with the hash of the document version they were cut from (D-4, O-8).

    ``sentences`` packs whole sentences instead, without overlap.
    Needs ``doc_id, doc_hash, tenant_id, modality, text, ingest_ts``. Row-wise: no shuffle.
    """
    if sentences and overlap:
        raise ValueError("chunks of whole sentences do not overlap")
    text = F.col("text")
    cut = docs.select(
        "doc_id",
        F.col("doc_hash").alias("doc_version_hash"),
        "modality",
        "tenant_id",
        "ingest_ts",
        F.posexplode(sentence_windows_of(text, size) if sentences else windows_of(text, size, overlap)).alias("chunk_index", "chunk_text"),
    )
    chunk_ts = _minutes_after("ingest_ts", F.col("chunk_index") % 10 + 1)
    return cut.select(
        F.concat_ws("-", "doc_id", F.col("chunk_index")).alias("chunk_id"),
        "doc_id",
        "doc_version_hash",
        "chunk_index",
        "chunk_text",
        "modality",
        F.length("chunk_text").alias("char_count"),
        token_estimate(F.col("chunk_text")).alias("token_estimate"),
        "tenant_id",
        chunk_ts.alias("chunk_ts"),
        F.to_date(chunk_ts).alias("chunk_date"),
        F.lit(None).cast("string").alias("embedding_id"),
        F.col("doc_id").alias("bronze_doc_id"),
        F.lit(run_id).alias("silver_run_id"),
    )


def embedding_rows(
    chunks: DataFrame,
    model: str,
    usd_per_1k: float = EMBED_USD_PER_1K_TOKENS,
    embed_ts: Column | None = None,
    id_prefix: str = "e-",
) -> DataFrame:
    """Embedding record per chunk: tokens, cost, empty evaluation columns (D-5).

    The vector itself comes from outside; ``attach_vectors`` adds it.
    """
    ts = embed_ts if embed_ts is not None else _minutes_after("chunk_ts", F.col("chunk_index") % 5 + 1)
    return chunks.select(
        F.concat(F.lit(id_prefix), "chunk_id").alias("embedding_id"),
        "chunk_id",
        "doc_id",
        "tenant_id",
        F.lit(model).alias("embedding_model"),
        ts.alias("embed_ts"),
        F.to_date(ts).alias("embed_date"),
        F.col("token_estimate").alias("prompt_tokens"),
        embedding_cost(F.col("token_estimate"), usd_per_1k).alias("cost_usd"),
        F.lit(None).cast("int").alias("retrieval_hit_count"),
        F.lit(None).cast("double").alias("avg_relevance_score"),
        F.lit(None).cast("timestamp_ntz").alias("eval_updated_ts"),
        F.col("silver_run_id").alias("chunk_silver_run_id"),
    )


def retrieval_events(logs: DataFrame, zero_hit_below: float = ZERO_HIT_SCORE) -> DataFrame:
    """Typed retrieval events with masked user and query text and pointers back to Bronze (M-5)."""
    p = F.col("payload")
    ts = p["ts"].try_cast("timestamp_ntz")
    return (
        parse_payload(logs, "raw_payload", RETRIEVAL_SCHEMA)
        .where(~is_corrupt())
        .select(
            p["event_id"].alias("event_id"),
            p["query_id"].alias("query_id"),
            fingerprint(p["user_id"]).alias("user_id"),
            p["tenant_id"].alias("tenant_id"),
            fingerprint(p["query_text"]).alias("query_text_hash"),
            p["query_modality"].alias("query_modality"),
            F.to_json(p["retrieved_chunk_ids"]).alias("retrieved_chunk_ids"),
            F.to_json(p["relevance_scores"]).alias("relevance_scores"),
            F.get(p["retrieved_chunk_ids"], F.lit(0)).alias("top1_chunk_id"),
            F.get(p["relevance_scores"], F.lit(0)).alias("top1_score"),
            (F.get(p["relevance_scores"], F.lit(0)) < zero_hit_below).alias("is_zero_hit"),
            p["latency_ms"].alias("latency_ms"),
            ts.alias("event_ts"),
            F.to_date(ts).alias("event_date"),
            F.col("log_id").alias("bronze_log_id"),
            F.col("kafka_offset").alias("bronze_kafka_offset"),
        )
    )


def ranked_hits(events: DataFrame) -> DataFrame:
    """One row per returned chunk with its 1-based rank and score (A-15)."""
    pairs = zip_shortest(
        text_array(F.col("retrieved_chunk_ids"), "string"),
        text_array(F.col("relevance_scores"), "double"),
        ("chunk_id", "score"),
    )
    return events.select(
        "event_id", "event_date", "tenant_id", "query_modality", F.posexplode(pairs).alias("pos", "hit")
    ).select(
        "event_id",
        "event_date",
        "tenant_id",
        "query_modality",
        F.col("hit.chunk_id").alias("chunk_id"),
        F.col("hit.score").alias("score"),
        (F.col("pos") + 1).alias("rank"),
    )


def hit_stats(events: DataFrame) -> DataFrame:
    """Hit count and mean score per chunk."""
    return ranked_hits(events).groupBy("chunk_id").agg(
        F.count("score").cast("int").alias("retrieval_hit_count"),
        F.avg("score").alias("avg_relevance_score"),
    )


def eval_update(embeddings: DataFrame, events: DataFrame, updated_at: Column) -> DataFrame:
    """Embeddings with evaluation columns set for every chunk that was returned (M-9)."""
    source = hit_stats(events).withColumn("eval_updated_ts", updated_at)
    columns = ["retrieval_hit_count", "avg_relevance_score", "eval_updated_ts"]
    return merge(
        embeddings,
        source,
        ["chunk_id"],
        matched={c: F.col(f"s.{c}") for c in columns},
        not_matched=None,
        on_duplicate="trust",  # one row per chunk by its aggregation
    )


def revise_documents(docs: DataFrame, n: int, mark: str = "#2") -> DataFrame:
    """Update batch: ``n`` documents in hash order get a new content hash (D-6)."""
    return (
        docs.orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(n)
        .withColumn("doc_hash", fingerprint(F.concat("doc_hash", F.lit(mark))))
    )


def stale_chunks(chunks: DataFrame, hashes: DataFrame) -> DataFrame:
    """Chunks whose document has a newer version (J-8, M-18)."""
    return (
        chunks.join(hashes, "doc_id")
        .where(F.col("current_hash") != F.col("doc_version_hash"))
    )


def reembed_batch(chunks: DataFrame, changed: DataFrame, model: str, embed_ts: Column) -> DataFrame:
    """New embedding records for all chunks of the changed documents (D-7, F-4)."""
    affected = chunks.join(changed.select("doc_id"), "doc_id", "left_semi")
    return embedding_rows(affected, model, embed_ts=embed_ts, id_prefix="r-")


# the columns a re-embed replaces; evaluation columns stay as they are
REEMBED_COLUMNS = (
    "embedding_id",
    "vector",
    "vector_norm",
    "embedding_model",
    "embed_ts",
    "embed_date",
    "prompt_tokens",
    "cost_usd",
)


def reembed(embeddings: DataFrame, batch: DataFrame, reset_eval: bool = False) -> DataFrame:
    """Upsert of a re-embed batch by chunk (M-10, T-2); ``reset_eval`` clears the old scores."""
    assignments = {c: F.col(f"s.{c}") for c in REEMBED_COLUMNS if c in embeddings.columns}
    if reset_eval:
        for c in ("retrieval_hit_count", "avg_relevance_score", "eval_updated_ts"):
            assignments[c] = F.lit(None).cast(embeddings.schema[c].dataType)
    return merge(embeddings, batch, ["chunk_id"], matched=assignments, on_duplicate="trust")  # one row per chunk


def pending_chunks(chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Chunks that still need a vector (M-23)."""
    return chunks.join(embeddings.select("chunk_id"), "chunk_id", "left_anti")


def reembed_counts(history: DataFrame, chunks: DataFrame) -> DataFrame:
    """Embeddings made after the first of each chunk, per day, tenant, model and modality (M-20).

    ``history`` holds every embedding ever made with its ``embed_version``.
    """
    first = history.groupBy("chunk_id").agg(F.min("embed_version").alias("first_version"))
    return (
        history.join(first, "chunk_id")
        .where(F.col("embed_version") > F.col("first_version"))
        .join(chunks.select("chunk_id", "modality"), "chunk_id")
        .groupBy("embed_date", "tenant_id", "embedding_model", "modality")
        .agg(F.count(F.lit(1)).alias("reembed_count"))
    )


def vectors_of(embeddings: DataFrame, model: str) -> DataFrame:
    """Vectors of one model version; read an old table version to reproduce an old result (C-6)."""
    return embeddings.where(F.col("embedding_model") == model)

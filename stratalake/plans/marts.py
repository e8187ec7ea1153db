"""Gold marts of the document store and the reports on top of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.measures import held, rounded, share, whole_days
from stratalake.operators.joins import null_safe_join
from stratalake.operators.percentiles import exact_percentiles
from stratalake.plans.rag import ranked_hits


def chunk_status(chunks: DataFrame, hashes: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Chunks with the current hash of their document and their embedding time and cost (J-3).

    A chunk is stale when its document has a known, different hash; an unknown hash counts as fresh.
    Only the columns the mart needs enter the two left joins.
    """
    current = hashes.select("doc_id", "current_hash")
    embedded = embeddings.select("chunk_id", "embed_ts", "cost_usd")
    narrow = chunks.select("chunk_id", "doc_id", "tenant_id", "modality", "doc_version_hash")
    stale = F.coalesce(F.col("doc_version_hash") != F.col("current_hash"), F.lit(False))
    return (
        narrow.join(current, "doc_id", "left")
        .join(embedded, "chunk_id", "left")
        .select("tenant_id", "modality", "current_hash", "embed_ts", "cost_usd", stale.alias("is_stale"))
    )


def freshness_kpi(chunks: DataFrame, hashes: DataFrame, embeddings: DataFrame, as_of: Column) -> DataFrame:
    """Fresh and stale chunks by tenant and modality (M-6)."""
    stale = F.col("is_stale")
    return (
        chunk_status(chunks, hashes, embeddings)
        .groupBy("tenant_id", "modality")
        .agg(
            F.count(F.lit(1)).alias("total_chunk_count"),
            held(stale).alias("stale_chunk_count"),
            held(~stale).alias("fresh_chunk_count"),
            share(~stale).alias("freshness_ratio"),
            F.min(F.when(stale, F.col("embed_ts"))).alias("oldest_stale_embed_ts"),
            rounded(F.avg(whole_days(as_of, F.col("embed_ts"))), 2).alias("avg_days_since_embed"),
            rounded(F.sum(F.when(stale, F.col("cost_usd")).otherwise(0.0)), 6).alias("pending_reembed_cost_usd"),
        )
        .withColumn("report_date", F.to_date(as_of))
    )


def unknown_hashes(chunks: DataFrame, hashes: DataFrame) -> DataFrame:
    """Chunks per tenant whose document is not in the registry, which the mart counts as fresh."""
    orphans = chunks.join(hashes.select("doc_id"), "doc_id", "left_anti")
    return orphans.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("unknown_chunk_count"))


def quality_kpi(events: DataFrame) -> DataFrame:
    """Zero hits, top scores and latency by day, tenant and modality (M-7).

    Counts and means are partial aggregates; the percentiles are exact and spread over the values, so
    one busy group is not gathered.
    """
    keys = ["report_date", "tenant_id", "query_modality"]
    base = events.select(
        F.col("event_date").alias("report_date"), "tenant_id", "query_modality", "top1_score", "is_zero_hit", "latency_ms"
    )
    totals = base.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_queries"),
        held(F.col("is_zero_hit")).alias("zero_hit_count"),
        share(F.col("is_zero_hit")).alias("zero_hit_rate"),
        rounded(F.avg("top1_score"), 4).alias("avg_top1_score"),
        rounded(F.avg("latency_ms"), 1).alias("avg_latency_ms"),
    )
    points = exact_percentiles(
        base,
        keys,
        {
            "p50_score": ("top1_score", 0.50),
            "p95_score": ("top1_score", 0.95),
            "p95_latency_ms": ("latency_ms", 0.95),
        },
    )
    totals = null_safe_join(totals, points, keys, "left")
    return totals.select(
        *keys,
        "total_queries",
        "zero_hit_count",
        "zero_hit_rate",
        "avg_top1_score",
        rounded("p50_score", 4).alias("p50_score"),
        rounded("p95_score", 4).alias("p95_score"),
        "avg_latency_ms",
        rounded("p95_latency_ms", 0).alias("p95_latency_ms"),
    )


def cost_kpi(embeddings: DataFrame, chunks: DataFrame) -> DataFrame:
    """Requests, tokens and cost by day, tenant, model and modality (M-8)."""
    fact = embeddings.select("chunk_id", "embed_date", "tenant_id", "embedding_model", "prompt_tokens", "cost_usd")
    return (
        fact.join(chunks.select("chunk_id", "modality"), "chunk_id")
        .groupBy(F.col("embed_date").alias("report_date"), "tenant_id", "embedding_model", "modality")
        .agg(
            F.count(F.lit(1)).alias("embed_request_count"),
            F.sum("prompt_tokens").alias("total_tokens"),
            rounded(F.sum("cost_usd"), 6).alias("total_cost_usd"),
            rounded(F.avg("cost_usd"), 8).alias("avg_cost_per_chunk"),
        )
    )


def precision_and_mrr(events: DataFrame, relevant: DataFrame, k: int = 5) -> DataFrame:
    """precision@k and mean reciprocal rank by day, tenant and modality (M-19).

    ``relevant`` lists the relevant ``chunk_id``; queries without a relevant hit count as 0.
    """
    keys = ["event_date", "tenant_id", "query_modality"]
    marked = ranked_hits(events).where(F.col("rank") <= k).join(
        relevant.select("chunk_id").distinct().withColumn("_relevant", F.lit(1)), "chunk_id", "left"
    )
    per_query = marked.groupBy("event_id", *keys).agg(
        F.count("_relevant").alias("good"), F.min(F.when(F.col("_relevant") == 1, F.col("rank"))).alias("first_rank")
    )
    return per_query.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("queries"),
        rounded(F.avg(F.col("good") / F.lit(k)), 4).alias("precision_at_k"),
        rounded(F.avg(F.coalesce(1 / F.col("first_rank"), F.lit(0.0))), 4).alias("mrr"),
    )


def freshness_by_tenant(freshness: DataFrame) -> DataFrame:
    """Tenants, worst freshness first; the ratio is recomputed from the sums (M-13)."""
    stale, total = F.sum("stale_chunk_count"), F.sum("total_chunk_count")
    return (
        freshness.groupBy("tenant_id")
        .agg(stale.alias("stale"), total.alias("total"), rounded(1.0 - stale / total, 4).alias("freshness"))
        .orderBy("freshness", "tenant_id")
    )


def cost_by_modality(cost: DataFrame) -> DataFrame:
    """Modalities, dearest first (M-14)."""
    return (
        cost.groupBy("modality")
        .agg(
            F.sum("embed_request_count").alias("requests"),
            F.sum("total_tokens").alias("tokens"),
            rounded(F.sum("total_cost_usd"), 6).alias("cost_usd"),
        )
        .orderBy(F.desc("cost_usd"), "modality")
    )


def quality_by_modality(quality: DataFrame) -> DataFrame:
    """Modalities, most zero hits first; means run over the rows of the mart (M-15)."""
    return (
        quality.groupBy("query_modality")
        .agg(
            F.sum("total_queries").alias("queries"),
            rounded(F.avg("zero_hit_rate"), 4).alias("avg_zero_hit"),
            rounded(F.avg("avg_top1_score"), 4).alias("avg_score"),
            rounded(F.avg("p95_latency_ms"), 0).alias("avg_p95_latency_ms"),
        )
        .orderBy(F.desc("avg_zero_hit"), "query_modality")
    )


def stalest_groups(freshness: DataFrame, tenant: str, n: int = 10) -> DataFrame:
    """The tenant's groups with the oldest stale vectors (O-S3)."""
    return (
        freshness.where((F.col("tenant_id") == tenant) & (F.col("stale_chunk_count") > 0))
        .orderBy("oldest_stale_embed_ts", "modality")
        .select("modality", "oldest_stale_embed_ts", "pending_reembed_cost_usd")
        .limit(n)
    )

"""Stored tables of the lake: Silver by date, Gold clustered by model, three marts, and the reports read from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.catalog.derive import AS_OF, CALLS_SQL, chunk_embeddings, chunks, current_hashes, ntz, raw_calls, raw_retrieval_logs
from stratalake.catalog.marts import registry as mart_registry
from stratalake.catalog.registry import Registry
from stratalake.plans import marts, rag
from stratalake.plans.llm_calls import daily_metrics, price_list, silver_calls
from stratalake.session import fresh_path
from stratalake.sources import snapshots
from stratalake.sources.parquet import staged

registry = Registry()
query = registry.query


def build_calls(spark, sf) -> dict[str, str]:
    """Silver calls partitioned by date and their Gold metrics clustered by model; paths by name."""
    paths = {name: fresh_path(spark, name) for name in ("silver_calls", "gold_calls")}
    snapshots.write_table(silver_calls(raw_calls(spark, sf)), paths["silver_calls"], partition_by=["date"])
    gold = daily_metrics(snapshots.read_table(spark, paths["silver_calls"]), price_list(spark))
    snapshots.write_table(gold, paths["gold_calls"])
    snapshots.optimize(spark, paths["gold_calls"], 64 << 20, cluster_by=["model"], min_files=3)
    return paths


def build_marts(spark, sf, names=("freshness", "cost", "quality")) -> dict[str, str]:
    """The KPI marts as tables; documents are cut and hashed once for all of them."""
    paths = {name: fresh_path(spark, f"mart-{name}") for name in names}
    if {"freshness", "cost"} & set(names):
        cut = staged(chunks(spark, sf), "chunks")
        made = chunk_embeddings(spark, sf, cut)
    if "freshness" in names:
        snapshots.write_table(marts.freshness_kpi(cut, current_hashes(spark, sf), made, ntz(f"{AS_OF} 00:00:00")), paths["freshness"])
    if "cost" in names:
        snapshots.write_table(marts.cost_kpi(made, cut), paths["cost"])
    if "quality" in names:
        snapshots.write_table(marts.quality_kpi(staged(rag.retrieval_events(raw_retrieval_logs(spark, sf)), "events")), paths["quality"])
    return paths


REPORTS = {"freshness": marts.freshness_by_tenant, "cost": marts.cost_by_modality, "quality": marts.quality_by_modality}


def report(spark, name: str, path: str):
    """Q1 to Q3 from the stored mart."""
    return REPORTS[name](snapshots.read_table(spark, path))


@query(mart_registry.oracle["q1_freshness"])
def gold_q1_freshness(spark, sf):
    return report(spark, "freshness", build_marts(spark, sf, ["freshness"])["freshness"])


@query(mart_registry.oracle["q2_cost"])
def gold_q2_cost(spark, sf):
    return report(spark, "cost", build_marts(spark, sf, ["cost"])["cost"])


@query(mart_registry.oracle["q3_quality"])
def gold_q3_quality(spark, sf):
    return report(spark, "quality", build_marts(spark, sf, ["quality"])["quality"])


@query(f"""WITH {CALLS_SQL} SELECT date, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(count(*) FILTER (WHERE status <> 'ok') AS BIGINT) AS failed
FROM silver WHERE model = 'small' GROUP BY date""")
def gold_model_days(spark, sf):
    """One model's days from clustered Gold, next to the failures counted in Silver's date partitions."""
    paths = build_calls(spark, sf)
    gold = snapshots.read_pruned(spark, paths["gold_calls"], "model", "small").select("date", F.col("total_prompt_tokens").alias("prompt_tokens"))
    silver = snapshots.read_table(spark, paths["silver_calls"]).where("model = 'small'")
    failed = silver.groupBy("date").agg(F.count_if(F.col("status") != "ok").alias("failed"))
    return gold.join(failed, "date")

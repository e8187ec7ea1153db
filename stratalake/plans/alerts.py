"""Alerts, quality gates, incident triage and row lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.measures import rounded
from stratalake.operators.drift import distribution_drift
from stratalake.plans.settings import STALE_ALERT, ZERO_HIT_ALERT


def stale_summary(freshness: DataFrame) -> DataFrame:
    """Stale chunks, overall ratio and pending cost in one row (M-11, A-17)."""
    stale, total = F.sum("stale_chunk_count"), F.sum("total_chunk_count")
    return freshness.agg(
        stale.alias("stale_chunks"),
        total.alias("total_chunks"),
        rounded(1 - stale / total, 4).alias("freshness_ratio"),
        rounded(F.sum("pending_reembed_cost_usd"), 6).alias("pending_cost_usd"),
    )


def stale_alerts(freshness: DataFrame, above: float = STALE_ALERT) -> DataFrame:
    """Groups whose stale share exceeds ``above`` (M-11, M-22)."""
    ratio = F.col("stale_chunk_count") / F.col("total_chunk_count")
    return freshness.where(ratio > above).select("tenant_id", "modality", "stale_chunk_count", "total_chunk_count")


def zero_hit_alerts(quality: DataFrame, above: float = ZERO_HIT_ALERT) -> DataFrame:
    """Groups with too many zero hits (M-12, M-22)."""
    return quality.where(F.col("zero_hit_rate") > above).select(
        "report_date", "tenant_id", "query_modality", "zero_hit_rate"
    )


def dropped_rows_alert(bronze: DataFrame, silver: DataFrame, at_least: float = 0.9) -> DataFrame:
    """One row: did Silver keep ``at_least`` of Bronze (M-22)?"""
    counted = bronze.agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit("bronze")).union(
        silver.agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit("silver"))
    )
    rows = counted.agg(
        F.max(F.when(F.col("layer") == "bronze", F.col("n"))).alias("bronze_rows"),
        F.max(F.when(F.col("layer") == "silver", F.col("n"))).alias("silver_rows"),
    )
    return rows.withColumn("alert", F.col("silver_rows") < F.col("bronze_rows") * at_least)


def cost_alerts(cost: DataFrame, factor: float = 1.5, days: int = 7) -> DataFrame:
    """Days on which a tenant costs ``factor`` times the mean of up to ``days`` days before (M-22).

    The window runs over one row per tenant and day.
    """
    daily = cost.groupBy("tenant_id", "report_date").agg(F.sum("total_cost_usd").alias("cost_usd"))
    before = Window.partitionBy("tenant_id").orderBy("report_date").rowsBetween(-days, -1)
    return (
        daily.withColumn("baseline_usd", F.avg("cost_usd").over(before))
        .where(F.col("cost_usd") > F.col("baseline_usd") * factor)
        .select("tenant_id", "report_date", "cost_usd", "baseline_usd")
    )


def quality_gates(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All rules over one table in a single pass: ``rule, failed, total, passed`` (M-21).

    A rule that evaluates to NULL fails.
    """
    names = list(rules)
    failed = [F.count_if(~F.coalesce(rules[n], F.lit(False))).alias(f"_{i}") for i, n in enumerate(names)]
    one_row = df.agg(F.count(F.lit(1)).alias("total"), *failed)
    lines = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(f"_{i}").alias("failed")) for i, n in enumerate(names)]
    )
    return one_row.select("total", F.inline(lines)).select(
        "rule", "failed", "total", (F.col("failed") == 0).alias("passed")
    )


def lineage(
    groups: DataFrame, silver: DataFrame, bronze: DataFrame, group_keys: Mapping[str, str], pointer: tuple[str, str]
) -> DataFrame:
    """Gold groups → Silver rows → Bronze rows through the back pointer (J-10).

    ``group_keys`` maps Gold columns to Silver columns, ``pointer`` names the Silver and Bronze id. The
    groups only filter Silver, so no row is multiplied.
    """
    wanted = groups.select(*[F.col(g).alias(s) for g, s in group_keys.items()]).distinct()
    rows = silver.join(wanted, list(group_keys.values()), "left_semi")
    back, own = pointer
    return rows.join(bronze.withColumnRenamed(own, f"_{own}"), F.col(back) == F.col(f"_{own}")).drop(f"_{own}")


def score_drift(events: DataFrame) -> DataFrame:
    """Per tenant the drift of its best scores between the two halves that ``triage`` compares (M-24)."""
    ends = events.groupBy("tenant_id").agg(F.min("event_date").alias("_lo"), F.max("event_date").alias("_hi"))
    late = F.col("event_date") > F.date_add("_lo", F.floor(F.datediff("_hi", "_lo") / 2).cast("int"))
    return distribution_drift(events.join(ends, "tenant_id"), ["tenant_id"], "top1_score", late)


def triage(
    quality: DataFrame, freshness: DataFrame, events: DataFrame, above: float = ZERO_HIT_ALERT
) -> DataFrame:
    """Per alerting tenant: zero hits, freshness and the score drift between its two halves (M-24).

    The day in the middle of the tenant's first and last event parts the periods.
    """
    sick = quality.groupBy("tenant_id").agg(
        rounded(F.sum("zero_hit_count") / F.sum("total_queries"), 4).alias("zero_hit_rate")
    ).where(F.col("zero_hit_rate") > above)
    fresh = freshness.groupBy("tenant_id").agg(
        rounded(F.sum("fresh_chunk_count") / F.sum("total_chunk_count"), 4).alias("freshness_ratio")
    )
    per_day = events.groupBy("tenant_id", "event_date").agg(
        F.sum("top1_score").alias("score"), F.count("top1_score").alias("n")
    )
    ends = per_day.groupBy("tenant_id").agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    late = F.col("event_date") > F.date_add("lo", F.floor(F.datediff("hi", "lo") / 2).cast("int"))

    def mean_score(period: Column) -> Column:
        score, n = F.sum(F.when(period, F.col("score"))), F.sum(F.when(period, F.col("n")))
        return rounded(F.try_divide(score, n), 4)

    drift = per_day.join(ends, "tenant_id").groupBy("tenant_id").agg(
        mean_score(~late).alias("score_before"),
        mean_score(late).alias("score_after"),
    )
    return sick.join(fresh, "tenant_id", "left").join(drift, "tenant_id", "left")


def age_tier(as_of: Column, day: Column, limits: Sequence[tuple[str, int]] = (("hot", 7), ("warm", 90))) -> Column:
    """Storage tier by age in days (C-5)."""
    age = F.datediff(as_of, day)
    tier = F.when(age <= limits[0][1], limits[0][0])
    for name, days in limits[1:]:
        tier = tier.when(age <= days, name)
    return tier.otherwise("cold")

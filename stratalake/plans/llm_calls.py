"""Call log: raw JSON → typed calls plus rejects → daily metrics per model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.measures import error_rate
from stratalake.functions.payload import is_corrupt, parse_payload
from stratalake.operators.dedup import first_per_key
from stratalake.operators.joins import null_safe_join
from stratalake.operators.percentiles import exact_percentiles, percentile_columns
from stratalake.plans.settings import CALL_PRICES

CALL_SCHEMA = (
    "model string, user_id string, usage struct<input:int,output:int>, latency_ms int, status string"
)
_PERCENTILES = {"p50_latency_ms": 0.50, "p95_latency_ms": 0.95}


def parsed_calls(raw: DataFrame) -> DataFrame:
    """Bronze rows with the payload as columns and ``rejected`` telling why a row is unusable."""
    p = F.col("payload")
    reason = F.when(is_corrupt(), "malformed").when(p["model"].isNull(), "no model")
    return parse_payload(raw, "raw_json", CALL_SCHEMA).select(
        "request_id",
        "ts",
        F.to_date("ts").alias("date"),
        p["model"].alias("model"),
        p["user_id"].alias("user_id"),
        p["usage"]["input"].alias("prompt_tokens"),
        p["usage"]["output"].alias("completion_tokens"),
        p["latency_ms"].alias("latency_ms"),
        p["status"].alias("status"),
        reason.alias("rejected"),
        "raw_json",
    )


def silver_calls(raw: DataFrame, keep: str = "first", tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """Validated calls, the earliest of each ``request_id`` (M-1).

    Rows are validated before they are numbered, so a broken first copy does not drop its retry.
    """
    valid = parsed_calls(raw).where(F.col("rejected").isNull()).drop("rejected", "raw_json")
    return first_per_key(valid, ["request_id"], ["ts", *tie_break], keep)


def rejected_calls(raw: DataFrame) -> DataFrame:
    """Rows that never reach Silver, with the reason."""
    return parsed_calls(raw).where(F.col("rejected").isNotNull()).select(
        "request_id", "ts", "raw_json", "rejected"
    )


def price_list(spark: SparkSession, prices: Sequence[tuple[str, float, float]] = CALL_PRICES) -> DataFrame:
    """Inline price dimension, as many rows as the caller lists (S9)."""
    return spark.createDataFrame(list(prices), "model string, usd_in double, usd_out double")


def with_prices(calls: DataFrame, prices: DataFrame, how: str = "inner") -> DataFrame:
    """Price lookup (J-1); ``how="left"`` keeps calls of unlisted models with NULL prices (J-2).

    No broadcast hint: the inline list is a local relation of known size, which Catalyst broadcasts,
    while a price table above the broadcast threshold is joined by shuffle.
    """
    return calls.join(prices, "model", how)


def daily_metrics(calls: DataFrame, prices: DataFrame, how: str = "inner", exact: bool = True) -> DataFrame:
    """Latency percentiles, tokens, error rate and cost by date and model (M-2).

    The log is reduced to one row per (date, model) before the price lookup, so the join never sees
    the log. ``exact=False`` takes the one-pass approximate percentiles.
    """
    keys = ["date", "model"]
    sums = [
        F.sum("prompt_tokens").alias("total_prompt_tokens"),
        F.sum("completion_tokens").alias("total_completion_tokens"),
        error_rate(F.col("status")).alias("error_rate"),
    ]
    listed = calls if how == "left" else calls.join(prices.select("model"), "model", "left_semi")
    if exact:
        totals = listed.groupBy(*keys).agg(*sums)
        points = exact_percentiles(listed, keys, {n: ("latency_ms", p) for n, p in _PERCENTILES.items()})
        totals = null_safe_join(totals, points, keys, "left")
    else:
        totals = listed.groupBy(*keys).agg(*sums, *percentile_columns("latency_ms", _PERCENTILES, exact=False))
    cost = (
        F.col("total_prompt_tokens") * F.col("usd_in") + F.col("total_completion_tokens") * F.col("usd_out")
    ) / F.lit(1e6)
    return with_prices(totals, prices, how).select(
        *keys,
        *_PERCENTILES,
        "total_prompt_tokens",
        "total_completion_tokens",
        "error_rate",
        cost.alias("cost_usd"),
    )


def contract_checks(bronze: DataFrame, silver: DataFrame, gold: DataFrame, min_dates: int = 7) -> DataFrame:
    """One row per promise of the pipeline with what was seen and whether it holds (M-3)."""

    def fact(df: DataFrame, name: str, agg: Column) -> DataFrame:
        return df.agg(agg.alias("seen")).select(F.lit(name).alias("fact"), "seen")

    facts = (
        fact(bronze, "bronze", F.count(F.lit(1)))
        .union(fact(silver, "silver", F.count(F.lit(1))))
        .union(fact(gold, "gold", F.count(F.lit(1))))
        .union(fact(gold, "dates", F.count_distinct("date")))
        .union(fact(gold, "models", F.count_distinct("model")))
    )
    names = ["bronze", "silver", "gold", "dates", "models"]
    wide = facts.agg(*[F.max(F.when(F.col("fact") == n, F.col("seen"))).alias(n) for n in names])

    def check(name: str, seen: str, passed: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), F.col(seen).alias("seen"), passed.alias("passed"))

    return wide.select(
        F.inline(
            F.array(
                check("silver smaller than bronze", "silver", F.col("silver") < F.col("bronze")),
                check("enough dates", "dates", F.col("dates") >= min_dates),
                check("dates times models", "gold", F.col("gold") == F.col("dates") * F.col("models")),
            )
        )
    )

"""Call log from Bronze to Gold, and the filters, joins and aggregates it is made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.catalog.derive import CALLS_SQL, raw_calls
from stratalake.catalog.registry import Registry
from stratalake.functions.measures import error_rate, held, rounded, share
from stratalake.functions.payload import parse_payload
from stratalake.operators.dedup import first_per_key, top_k_per_key
from stratalake.operators.joins import null_safe_join
from stratalake.operators.percentiles import percentile_columns, exact_percentiles
from stratalake.plans.llm_calls import contract_checks, daily_metrics, price_list, rejected_calls, silver_calls
from stratalake.sources.parquet import load, staged

registry = Registry()
query = registry.query


@query(f"WITH {CALLS_SQL} SELECT * FROM silver")
def silver_calls_first(spark, sf):
    return silver_calls(raw_calls(spark, sf))


@query(f"""WITH {CALLS_SQL} SELECT DISTINCT request_id FROM silver""")
def silver_calls_any(spark, sf):
    return silver_calls(raw_calls(spark, sf), keep="any").select("request_id")


@query(f"""WITH {CALLS_SQL} SELECT request_id, ts, CASE WHEN broken THEN 'malformed' ELSE 'no model' END AS rejected
FROM calls_all WHERE broken OR model IS NULL""")
def rejects(spark, sf):
    return rejected_calls(raw_calls(spark, sf)).select("request_id", "ts", "rejected")


def _daily_sql(join: str) -> str:
    return f"""WITH {CALLS_SQL}
SELECT s.date, s.model,
  CAST(round(CAST(quantile_cont(s.latency_ms, 0.5) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS p50_latency_ms,
  CAST(round(CAST(quantile_cont(s.latency_ms, 0.95) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS p95_latency_ms,
  CAST(sum(s.prompt_tokens) AS BIGINT) AS total_prompt_tokens,
  CAST(sum(s.completion_tokens) AS BIGINT) AS total_completion_tokens,
  CAST(round(CAST(avg(CASE WHEN s.status <> 'ok' THEN 1.0 ELSE 0.0 END) AS DECIMAL(38, 12)), 6) AS DOUBLE) AS error_rate,
  CAST(round(CAST(sum(s.prompt_tokens) * CAST(p.usd_in AS DOUBLE) / 1e6
    + sum(s.completion_tokens) * CAST(p.usd_out AS DOUBLE) / 1e6 AS DECIMAL(38, 12)), 6) AS DOUBLE) AS cost_usd
FROM silver s {join} JOIN prices p USING (model)
GROUP BY s.date, s.model, p.usd_in, p.usd_out"""


def _rounded_daily(df):
    return df.select(
        "date",
        "model",
        rounded("p50_latency_ms", 4).alias("p50_latency_ms"),
        rounded("p95_latency_ms", 4).alias("p95_latency_ms"),
        "total_prompt_tokens",
        "total_completion_tokens",
        rounded("error_rate", 6).alias("error_rate"),
        rounded("cost_usd", 6).alias("cost_usd"),
    )


def _silver(spark, sf):
    """Silver as the table that the Gold job reads."""
    return staged(silver_calls(raw_calls(spark, sf)), "silver")


@query(_daily_sql(""))
def gold_daily_metrics(spark, sf):
    return _rounded_daily(daily_metrics(_silver(spark, sf), price_list(spark)))


@query(_daily_sql("LEFT"))
def gold_daily_metrics_unlisted(spark, sf):
    return _rounded_daily(daily_metrics(_silver(spark, sf), price_list(spark), how="left"))


@query()
def gold_daily_metrics_approx(spark, sf):
    return _rounded_daily(daily_metrics(_silver(spark, sf), price_list(spark), exact=False))


@query(f"""WITH {CALLS_SQL}, gold AS (SELECT DISTINCT date, model FROM silver JOIN prices USING (model)),
f AS (SELECT (SELECT count(*) FROM calls_all) AS bronze, (SELECT count(*) FROM silver) AS silver,
  (SELECT count(*) FROM gold) AS gold, (SELECT count(DISTINCT date) FROM gold) AS dates,
  (SELECT count(DISTINCT model) FROM gold) AS models)
SELECT 'silver smaller than bronze' AS "check", silver AS seen, silver < bronze AS passed FROM f
UNION ALL SELECT 'enough dates', dates, dates >= 7 FROM f
UNION ALL SELECT 'dates times models', gold, gold = dates * models FROM f""")
def medallion_contract(spark, sf):
    raw, silver = raw_calls(spark, sf), _silver(spark, sf)
    return contract_checks(raw, silver, daily_metrics(silver, price_list(spark), exact=False))


@query("""SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users,
  count(DISTINCT CAST(ts AS DATE)) AS days, count(DISTINCT props) AS payloads
FROM events GROUP BY event_type""")
def distinct_counts(spark, sf):
    return load(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct(F.to_date("ts")).alias("days"),
        F.count_distinct("props").alias("payloads"),
    )


@query("SELECT event_type, TRUE AS users_close, TRUE AS payloads_close FROM events GROUP BY event_type")
def approx_distinct_holds(spark, sf):
    """Approximate distinct counts against exact ones: within five standard errors of one percent.

    Two aggregates: beside an exact count, Spark keeps a sketch for every distinct value instead of one a group.
    """
    events = load(spark, sf, "events").select("event_type", "user_id", "props")
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("props").alias("payloads"))
    near = events.groupBy("event_type").agg(
        F.approx_count_distinct("user_id", 0.01).alias("near_users"), F.approx_count_distinct("props", 0.01).alias("near_payloads")
    )
    close = lambda c: (F.abs(F.col(f"near_{c}") - F.col(c)) <= F.col(c) * 0.05 + 1).alias(f"{c}_close")
    return null_safe_join(exact, near, ["event_type"]).select("event_type", close("users"), close("payloads"))


@query("SELECT event_type, TRUE AS p50_close, TRUE AS p95_close FROM events GROUP BY event_type")
def approx_percentile_holds(spark, sf):
    """Approximate percentiles by the rank they have among all values: within half a percent."""
    events = load(spark, sf, "events").select("event_type", "value")
    wanted = {"p50": 0.5, "p95": 0.95}
    points = events.groupBy("event_type").agg(*percentile_columns("value", wanted, exact=False))
    below = {n: F.avg((F.col("value") < F.col(n)).cast("double")) for n in wanted}
    upto = {n: F.avg((F.col("value") <= F.col(n)).cast("double")) for n in wanted}
    close = [((below[n] <= p + 0.005) & (upto[n] >= p - 0.005)).alias(f"{n}_close") for n, p in wanted.items()]
    return events.join(points, "event_type").groupBy("event_type").agg(*close)


@query("SELECT lang, count(*) AS count FROM documents GROUP BY lang ORDER BY count DESC, lang")
def value_counts(spark, sf):
    return load(spark, sf, "documents").groupBy("lang").count().orderBy(F.desc("count"), "lang")


@query("SELECT count(*) AS hits FROM events WHERE user_id = 42 AND event_type = 'purchase'")
def point_filter(spark, sf):
    events = load(spark, sf, "events")
    return events.where("user_id = 42 AND event_type = 'purchase'").agg(F.count(F.lit(1)).alias("hits"))


@query("""SELECT count(*) AS bad_rows, min(c_acctbal) AS worst FROM customer WHERE c_acctbal < 0""")
def negative_balance(spark, sf):
    return load(spark, sf, "customer").where("c_acctbal < 0").agg(
        F.count(F.lit(1)).alias("bad_rows"), F.min("c_acctbal").alias("worst")
    )


@query("""SELECT source, count(*) FILTER (WHERE quality IS NULL) AS unlabelled,
  count(*) FILTER (WHERE quality IS NOT NULL) AS labelled,
  CAST(round(CAST(avg(CASE WHEN quality = 0 THEN 1.0 ELSE 0.0 END) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS poor_share
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def null_counts(spark, sf):
    joined = load(spark, sf, "documents").select("doc_id", "source").join(load(spark, sf, "labels"), "doc_id", "left")
    return joined.groupBy("source").agg(
        held(F.col("quality").isNull()).alias("unlabelled"),
        held(F.col("quality").isNotNull()).alias("labelled"),
        share(F.col("quality") == 0).alias("poor_share"),
    )


@query("""SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(15, 2)) AS total, CAST(o_orderdate AS DATE) AS day,
  TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
  TRY_CAST(o_orderpriority AS INTEGER) AS unparsable,
  CASE WHEN o_totalprice > 400000 THEN 'gold' WHEN o_totalprice > 200000 THEN 'silver' ELSE 'bronze' END AS tier
FROM orders""")
def typed_projection(spark, sf):
    total = F.col("o_totalprice")
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        total.cast("decimal(15,2)").alias("total"),
        F.to_date("o_orderdate").alias("day"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
        F.col("o_orderpriority").try_cast("int").alias("unparsable"),
        F.when(total > 400000, "gold").when(total > 200000, "silver").otherwise("bronze").alias("tier"),
    )


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def membership(spark, sf):
    chosen = load(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'").select("c_custkey")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.join(chosen, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@query("""SELECT n_name, count(*) AS suppliers, CAST(round(CAST(avg(s_acctbal) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS avg_balance
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def dimension_join(spark, sf):
    nation = load(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    per_key = load(spark, sf, "supplier").groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("s_acctbal").alias("balance")
    )
    return per_key.join(nation, "s_nationkey").groupBy("n_name").agg(
        F.sum("n").alias("suppliers"), rounded(F.sum("balance") / F.sum("n"), 2).alias("avg_balance")
    )


@query("""SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS quantity,
  CAST(round(sum(CAST(l_extendedprice AS DECIMAL(15, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))), 2) AS DOUBLE) AS revenue, CAST(round(CAST(avg(l_discount) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS avg_discount,
  CAST(round(CAST(quantile_cont(l_extendedprice, 0.5) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS p50_price, CAST(round(CAST(quantile_cont(l_extendedprice, 0.95) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS p95_price
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def lineitem_summary(spark, sf):
    keys = ["l_returnflag", "l_linestatus"]
    lines = load(spark, sf, "lineitem")
    net = F.expr("CAST(l_extendedprice AS DECIMAL(15, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))")
    totals = lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("l_quantity").cast("long").alias("quantity"),
        rounded(F.sum(net), 2).cast("double").alias("revenue"),
        rounded(F.avg("l_discount"), 4).alias("avg_discount"),
    )
    points = exact_percentiles(
        lines, keys, {"p50_price": ("l_extendedprice", 0.5), "p95_price": ("l_extendedprice", 0.95)}
    )
    return null_safe_join(totals, points, keys, "left").select(
        *totals.columns, rounded("p50_price", 4).alias("p50_price"), rounded("p95_price", 4).alias("p95_price")
    )


@query("""SELECT CAST(round(CAST(quantile_cont(value, 0.25) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS q1, CAST(round(CAST(quantile_cont(value, 0.5) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS q2,
  CAST(round(CAST(quantile_cont(value, 0.75) AS DECIMAL(38, 10)), 4) AS DOUBLE) AS q3 FROM events""")
def global_percentiles(spark, sf):
    out = exact_percentiles(
        load(spark, sf, "events"), [], {"q1": ("value", 0.25), "q2": ("value", 0.5), "q3": ("value", 0.75)}
    )
    return out.select(*[rounded(c, 4).alias(c) for c in ("q1", "q2", "q3")])


@query("""SELECT user_id, event_type, ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def first_event_per_user(spark, sf):
    events = load(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return first_per_key(events, ["user_id"], ["ts", "event_id"])


@query("""SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
  FROM orders) WHERE rank <= 5""")
def top5_orders_per_customer(spark, sf):
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_k_per_key(orders, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 5, rank_as="rank")


@query("""SELECT c_mktsegment, n_regionkey, count(*) AS customers, CAST(round(CAST(sum(c_acctbal) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL ORDER BY c_mktsegment, balance DESC""")
def sorted_report(spark, sf):
    nation = load(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    return (
        load(spark, sf, "customer")
        .join(nation, "c_nationkey")
        .groupBy("c_mktsegment", "n_regionkey")
        .agg(F.count(F.lit(1)).alias("customers"), rounded(F.sum("c_acctbal"), 2).alias("balance"))
        .orderBy("c_mktsegment", F.desc("balance"))
    )


@query("""SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS calls,
  CAST(round(CAST(avg(CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) > 50 THEN 1.0 ELSE 0.0 END) AS DECIMAL(38, 12)), 6) AS DOUBLE) AS heavy_share
FROM events GROUP BY ALL""")
def json_field_share(spark, sf):
    events = parse_payload(load(spark, sf, "events"), "props", "k int")
    heavy = F.when(F.col("payload.k") > 50, "heavy").otherwise("ok")
    return events.select("event_type", F.to_date("ts").alias("day"), heavy.alias("weight")).groupBy(
        "event_type", "day"
    ).agg(F.count(F.lit(1)).alias("calls"), rounded(error_rate(F.col("weight")), 6).alias("heavy_share"))

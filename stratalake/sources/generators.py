"""Repeatable fixtures of any size, made on the executors.

Each value is a function of the row number and the seed through ``xxhash64``, so the same arguments
always give the same rows, whatever the partitioning, and a lost task makes the same rows again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.vectors import l2_norm, normalised
from stratalake.plans import settings as s


class Dice:
    """Uniform and normal draws per row; each name is an independent stream."""

    def __init__(self, seed: int, *of: str) -> None:
        self._seed, self._of = seed, [F.col(c) for c in of] or [F.col("id")]

    def unit(self, name: str, *more: Column) -> Column:
        """Uniform in [0, 1)."""
        bits = F.shiftrightunsigned(F.xxhash64(*self._of, *more, F.lit(f"{self._seed}/{name}")), 11)
        return bits / F.lit(float(1 << 53))

    def unit_of(self, name: str, row: Column) -> Column:
        """The draw of another row, in a table whose draws go by one column."""
        return F.shiftrightunsigned(F.xxhash64(row, F.lit(f"{self._seed}/{name}")), 11) / F.lit(float(1 << 53))

    def between(self, name: str, low: int, high: int) -> Column:
        """Whole number from ``low`` to ``high``, both included."""
        return (F.floor(self.unit(name) * (high - low + 1)) + low).cast("long")

    def normal(self, name: str, *more: Column) -> Column:
        radius = F.sqrt(-2 * F.log(1 - self.unit(f"{name}/r", *more)))
        return radius * F.cos(2 * math.pi * self.unit(f"{name}/a", *more))

    def weighted(self, name: str, choices: Sequence[tuple[str, int]]) -> Column:
        u = self.unit(name) * sum(w for _, w in choices)
        bound, pick = choices[0][1], F.when(u < choices[0][1], choices[0][0])
        for value, weight in choices[1:]:
            bound += weight
            pick = pick.when(u < bound, value)
        return pick

    def one_of(self, name: str, values: Sequence[str]) -> Column:
        return self.weighted(name, [(v, 1) for v in values])


def _after(start: str, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("int"), F.expr(f"TIMESTAMP_NTZ'{start}'"))


def call_log(spark: SparkSession, rows: int, seed: int = 42, start: str = "2026-04-01 00:00:00") -> DataFrame:
    """Raw call log over seven days with retries of recent request ids (D-1)."""
    d = Dice(seed)
    base = spark.range(rows).select(
        "id",
        d.weighted("model", s.MODEL_WEIGHTS).alias("model"),
        d.between("in", 50, 4000).alias("input"),
        d.between("out", 20, 2000).alias("output"),
        d.weighted("status", s.STATUS_WEIGHTS).alias("status"),
        F.concat(F.lit("u_"), d.between("user", 1, 5000)).alias("user_id"),
    )
    mean = F.create_map(*[F.lit(x) for m, (v, _) in s.LATENCY_MS.items() for x in (m, float(v))])[F.col("model")]
    spread = F.create_map(*[F.lit(x) for m, (_, v) in s.LATENCY_MS.items() for x in (m, float(v))])[F.col("model")]
    latency = F.greatest(F.lit(50), (mean / 800 * F.col("output") + spread * d.normal("latency")).cast("int"))
    back = F.floor(d.unit("retry of") * F.least(F.col("id"), F.lit(s.RETRY_REACH))) + 1
    retry = (F.col("id") > 0) & (d.unit("retry") < s.RETRY_RATE)
    # a retry repeats an original: the first rows of its reach, one back at a time, that are no retries themselves
    is_retry = lambda row: (row > 0) & (d.unit_of("retry", row) < s.RETRY_RATE)
    tries = F.transform(F.sequence(F.lit(0), F.lit(40)), lambda i: F.greatest(F.lit(0).cast("long"), F.col("id") - back - i))
    original = F.coalesce(F.get(F.filter(tries, lambda row: ~is_retry(row)), 0), F.lit(0).cast("long"))
    source_row = F.when(retry, original).otherwise(F.col("id"))
    body = F.struct(
        "model", "user_id", F.struct("input", "output").alias("usage"), latency.alias("latency_ms"), "status"
    )
    seconds = F.floor(F.col("id") * (s.SPAN_DAYS * 86_400) / rows)
    return base.select(
        F.md5(F.concat(F.lit(f"{seed}/request/"), source_row)).alias("request_id"),
        _after(start, seconds).alias("ts"),
        F.to_json(body).alias("raw_json"),
    )


def documents(spark: SparkSession, rows: int, seed: int = 42, start: str = "2026-03-01 00:00:00") -> DataFrame:
    """Raw documents of three modalities, tenants in turn (D-2)."""
    d = Dice(seed)
    kinds = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(e).alias("e")) for m, e in s.MODALITIES])
    tenants = F.array(*[F.lit(t) for t in s.TENANTS])
    kind = F.get(kinds, (F.col("id") % len(s.MODALITIES)).cast("int"))
    tenant = F.get(tenants, (F.floor(F.col("id") / len(s.MODALITIES)) % len(s.TENANTS)).cast("int"))
    doc_id = F.md5(F.concat(F.lit(f"{seed}/document/"), "id"))
    ingest = _after(start, d.between("ingest", 1, 30) * 86_400)
    return spark.range(rows).select(
        doc_id.alias("doc_id"),
        F.concat_ws("/", F.lit("raw"), tenant, kind["m"], F.concat(doc_id, F.lit("."), kind["e"])).alias("raw_path"),
        kind["e"].alias("doc_type"),
        kind["m"].alias("modality"),
        d.between("size", 10_000, 5_000_000).alias("file_size_bytes"),
        d.one_of("source", s.SOURCES).alias("source_system"),
        tenant.alias("tenant_id"),
        ingest.alias("ingest_ts"),
        F.to_date(ingest).alias("ingest_date"),
        F.sha2(F.concat(doc_id, d.unit("text").cast("string")), 256).alias("doc_hash"),
        F.lit("v1").alias("schema_version"),
    )


def retrieval_logs(
    spark: SparkSession, rows: int, chunk_count: int, seed: int = 42, start: str = "2026-03-15 00:00:00"
) -> DataFrame:
    """Raw retrieval log: JSON payload with five chunk numbers and falling scores (D-3)."""
    d = Dice(seed)
    tries = F.array(*[F.lit(i) for i in range(5)])
    scores = F.reverse(F.array_sort(F.transform(tries, lambda i: F.round(d.unit("score", i) * 0.89 + 0.1, 4))))
    ids = F.transform(tries, lambda i: F.floor(d.unit("hit", i) * chunk_count).cast("string"))
    ts = _after(start, d.between("day", 0, 14) * 86_400)
    tenant = d.one_of("tenant", s.TENANTS)
    payload = F.struct(
        F.concat(F.lit("ev-"), "id").alias("event_id"),
        F.concat(F.lit("q-"), "id").alias("query_id"),
        F.concat(F.lit("user_"), F.lpad(d.between("user", 1, 50).cast("string"), 4, "0")).alias("user_id"),
        tenant.alias("tenant_id"),
        F.concat(F.lit("question "), d.between("text", 1, 1000)).alias("query_text"),
        d.one_of("modality", [m for m, _ in s.MODALITIES]).alias("query_modality"),
        ids.alias("retrieved_chunk_ids"),
        scores.alias("relevance_scores"),
        d.between("latency", 50, 800).cast("int").alias("latency_ms"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
    )
    return spark.range(rows).select(
        F.concat(F.lit("log-"), "id").alias("log_id"),
        F.to_json(payload).alias("raw_payload"),
        tenant.alias("tenant_id"),
        ts.alias("ingest_ts"),
        F.to_date(ts).alias("ingest_date"),
        (F.col("id") + 1_000_000).alias("kafka_offset"),
        F.lit("v1").alias("schema_version"),
    )


def chunk_rows(docs: DataFrame, per_doc: int, run_id: str, seed: int = 42) -> DataFrame:
    """A fixed number of chunks per document with invented text (D-4)."""
    d = Dice(seed, "doc_id")
    cut = docs.select("*", F.explode(F.expr(f"sequence(0, {per_doc - 1})")).alias("chunk_index"))
    words = F.repeat(F.lit("text "), (d.unit("words", F.col("chunk_index")) * 60 + 4).cast("int"))
    text = F.concat(words, F.lit("chunk "), "chunk_index", F.lit(" of "), "doc_id")
    ts = F.timestamp_add("MINUTE", F.lit(1) + F.col("chunk_index") % 10, F.col("ingest_ts"))
    return cut.select(
        F.concat_ws("-", "doc_id", "chunk_index").alias("chunk_id"),
        "doc_id",
        F.col("doc_hash").alias("doc_version_hash"),
        "chunk_index",
        text.alias("chunk_text"),
        "modality",
        F.length(text).alias("char_count"),
        F.floor(F.length(text) / 4).cast("int").alias("token_estimate"),
        "tenant_id",
        ts.alias("chunk_ts"),
        F.to_date(ts).alias("chunk_date"),
        F.lit(None).cast("string").alias("embedding_id"),
        F.col("doc_id").alias("bronze_doc_id"),
        F.lit(run_id).alias("silver_run_id"),
    )


def with_vectors(embeddings: DataFrame, dim: int = 128, seed: int = 42) -> DataFrame:
    """Unit vector and its norm for every embedding id (D-5)."""
    d = Dice(seed, "embedding_id")
    raw = F.transform(F.expr(f"sequence(0, {dim - 1})"), lambda i: d.normal("x", i))
    made = embeddings.withColumn("_raw", raw).withColumn("vector", normalised(F.col("_raw"))).drop("_raw")
    return made.withColumn("vector_norm", l2_norm(F.col("vector")))


def zero_vectors(embeddings: DataFrame, n: int) -> DataFrame:
    """Fault batch: ``n`` records in id order whose vector is all zero (D-8)."""
    picked = embeddings.orderBy("chunk_id").limit(n)
    zeros = F.transform("vector", lambda x: F.lit(0.0).cast("float"))
    return picked.withColumn("vector", zeros).withColumn("vector_norm", F.lit(0.0))


def customers(spark: SparkSession, rows: int = 100_000) -> DataFrame:
    """Active customers whose score is the id modulo 1000 (D-9)."""
    return spark.range(rows).select(
        F.col("id").alias("customer_id"), F.lit("active").alias("status"), (F.col("id") % 1000).alias("score")
    )


def with_tier(rows: DataFrame) -> DataFrame:
    return rows.withColumn("tier", F.when(F.col("score") > 800, "gold").otherwise("silver"))


def bad_customers(spark: SparkSession, rows: int = 50) -> DataFrame:
    """Fault batch: score -1, no status (D-8)."""
    return spark.range(rows).select(
        F.col("id").alias("customer_id"),
        F.lit(None).cast("string").alias("status"),
        F.lit(-1).cast("long").alias("score"),
        F.lit("UNKNOWN").alias("tier"),
    )

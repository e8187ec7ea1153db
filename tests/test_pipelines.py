"""Generated fixtures through the pipelines: golden numbers of the document store and the call log."""

import pytest
from pyspark.sql import functions as F

from stratalake.plans import alerts, llm_calls, marts, rag
from stratalake.sources import generators as g
from stratalake.sources import snapshots as st


def test_call_log_is_repeatable_and_has_retries(spark):
    log = g.call_log(spark, 20_000)
    assert log.exceptAll(g.call_log(spark, 20_000).repartition(3)).count() == 0
    ids = log.select("request_id").distinct().count()
    assert 0.93 < ids / 20_000 < 0.97
    assert log.select(F.to_date("ts")).distinct().count() == 7


def test_medallion(spark):
    raw = g.call_log(spark, 20_000).unionByName(
        spark.createDataFrame([("x", "bad"), ("y", '{"user_id": "u"}')], "request_id string, raw_json string").withColumn(
            "ts", F.expr("TIMESTAMP_NTZ'2026-04-02 00:00:00'")
        )
    )
    silver = llm_calls.silver_calls(raw)
    gold = llm_calls.daily_metrics(silver, llm_calls.price_list(spark))
    assert {r.rejected: r["count"] for r in llm_calls.rejected_calls(raw).groupBy("rejected").count().collect()} == {
        "malformed": 1, "no model": 1,
    }
    assert gold.count() == 21
    assert gold.where("error_rate > 0 AND cost_usd > 0 AND p95_latency_ms > p50_latency_ms").count() == 21
    assert all(r.passed for r in llm_calls.contract_checks(raw, silver, gold).collect())
    assert silver.count() == silver.select("request_id").distinct().count()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    docs = g.documents(spark, 120)
    chunks = g.chunk_rows(docs, 10, "run-1")
    embedded = g.with_vectors(rag.embedding_rows(chunks, "m"))
    logs = g.retrieval_logs(spark, 3_000, 1_200)
    for name, df, part in (
        ("docs", docs, "ingest_date"), ("chunks", chunks, "chunk_date"), ("embeddings", embedded, "embed_date"),
        ("events", rag.retrieval_events(logs), "event_date"),
    ):
        st.write_table(df, f"{root}/{name}", partition_by=[part])
    return root


AS_OF = "TIMESTAMP_NTZ'2026-05-01 00:00:00'"


def test_store_counts(spark, store):
    chunks = st.read_table(spark, f"{store}/chunks")
    assert {r["count"] for r in chunks.groupBy("modality").count().collect()} == {400}
    norms = st.read_table(spark, f"{store}/embeddings").agg(F.min("vector_norm"), F.max("vector_norm")).first()
    assert norms[0] == pytest.approx(1, abs=1e-5) and norms[1] == pytest.approx(1, abs=1e-5)


def test_reembed_flow_and_freshness(spark, store):
    docs, chunks = st.read_table(spark, f"{store}/docs"), st.read_table(spark, f"{store}/chunks")
    path = f"{store}/embeddings"
    changed = rag.revise_documents(docs, 20)
    hashes = docs.select("doc_id", F.col("doc_hash").alias("current_hash"))
    hashes = hashes.join(changed.select("doc_id"), "doc_id", "left_anti").unionByName(
        changed.select("doc_id", F.col("doc_hash").alias("current_hash"))
    )
    assert rag.stale_chunks(chunks, hashes).count() == 200
    mart = marts.freshness_kpi(chunks, hashes, st.read_table(spark, path), F.expr(AS_OF))
    summary = alerts.stale_summary(mart).first()
    assert (summary.stale_chunks, summary.total_chunks) == (200, 1_200)
    assert mart.where("fresh_chunk_count + stale_chunk_count <> total_chunk_count").count() == 0

    before = st.table_version(spark, path)
    batch = g.with_vectors(rag.reembed_batch(chunks, changed, "m2", F.expr(AS_OF)))
    sets = {c: F.col(f"s.{c}") for c in rag.REEMBED_COLUMNS}
    after = st.merge_table(batch, path, ["chunk_id"], matched=sets)
    table = st.read_table(spark, path)
    assert table.count() == 1_200 and table.where("embedding_model = 'm2'").count() == 200
    assert st.read_table(spark, path, before).where("embedding_model = 'm2'").count() == 0
    assert st.history(spark, path).first().metrics["rows_updated"] == 200

    zero = g.zero_vectors(table, 50)
    faulty = st.merge_table(zero, path, ["chunk_id"], matched=sets)
    assert st.read_table(spark, path, faulty).where("vector_norm = 0").count() == 50
    st.restore(spark, path, after)
    assert st.read_table(spark, path).where("vector_norm = 0").count() == 0


def test_masking_and_quality(spark, store):
    events = st.read_table(spark, f"{store}/events")
    assert events.count() == 3_000
    assert events.where("length(user_id) <> 64 OR length(query_text_hash) <> 64").count() == 0
    assert events.where("is_zero_hit <> (top1_score < 0.3)").count() == 0
    mart = marts.quality_kpi(events)
    assert mart.agg(F.sum("total_queries")).first()[0] == 3_000
    builtin = events.groupBy("event_date", "tenant_id", "query_modality").agg(
        F.round(F.percentile("top1_score", 0.95), 4).alias("b")
    )
    both = mart.join(builtin, [mart.report_date == builtin.event_date, mart.tenant_id == builtin.tenant_id,
                               mart.query_modality == builtin.query_modality])
    assert both.where("abs(p95_score - b) > 0.00011").count() == 0


def test_reset_eval(spark):
    chunks = g.chunk_rows(g.documents(spark, 3), 2, "r")
    made = rag.embedding_rows(chunks, "m").withColumn("avg_relevance_score", F.lit(0.5)).withColumn(
        "retrieval_hit_count", F.lit(1)
    )
    batch = rag.embedding_rows(chunks, "m2", id_prefix="r-")
    assert rag.reembed(made, batch).where("avg_relevance_score = 0.5").count() == 6
    assert rag.reembed(made, batch, reset_eval=True).where("avg_relevance_score IS NULL").count() == 6

"""What must not get lost, and what must not stay."""

import os
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.operators.knn import knn
from stratalake.sources import snapshots as tables
from stratalake.streaming import jobs

LATER = datetime.now(timezone.utc) + timedelta(days=1)


@pytest.fixture
def filled(spark, table):
    rows = spark.range(30).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("part"), (F.col("id") * 2).cast("int").alias("v"))
    tables.write_table(rows, table, partition_by=["part"])
    return table


def test_vacuumed_versions_are_refused(spark, filled):
    tables.write_table(tables.read_table(spark, filled).where("k > 3"), filled)
    tables.vacuum(spark, filled, timedelta(0), LATER, dry_run=False)
    with pytest.raises(tables.NoSuchVersion):
        tables.restore(spark, filled, 0)
    with pytest.raises(tables.NoSuchVersion):
        tables.read_table(spark, filled, 0)
    assert tables.read_table(spark, filled).count() == 26


@pytest.mark.parametrize("last", ["restore", "delete of nothing", "drop"])
def test_erase_leaves_nothing(spark, filled, tmp_path, last):
    subject = tables.read_table(spark, filled).where("k = 7")
    subject.write.parquet(f"{filled}/staging/version=9")  # of a merge that failed
    subject.drop("part").write.parquet(f"{filled}/data/snap=1/part=1")  # of a write that failed
    if last == "restore":
        tables.restore(spark, filled, 0)
    elif last == "drop":
        tables.drop_table(spark, filled)
        tables.restore(spark, filled, 0)
    else:
        tables.delete_rows(spark, filled, F.col("k") == -1)
    tables.erase(spark, [filled], F.col("k") == 7, str(tmp_path / "audit"), "subject 7", "office")
    found = [d for d, _, names in os.walk(filled) if any(n.endswith(".parquet") for n in names)]
    assert found and all("snap=" in d for d in found)
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{filled}/data").where("k = 7").count() == 0
    assert tables.read_table(spark, filled).count() == 29
    assert tables.read_table(spark, str(tmp_path / "audit")).first().rows_deleted == 1


def test_merge_keeps_to_the_schema(spark, filled):
    wrong = spark.createDataFrame([(1, "1", 5.9)], "k long, part string, v double")
    more = spark.createDataFrame([(1, "1", 6, "x")], "k long, part string, v int, note string")
    less = spark.createDataFrame([(99, "1")], "k long, part string")
    for source in (wrong, more, less):
        with pytest.raises(tables.SchemaMismatch):
            tables.merge_table(source, filled, ["k"])
    tables.merge_table(more, filled, ["k"], schema_mode="merge")
    rows = {r.k: r for r in tables.read_table(spark, filled).collect()}
    assert len(rows) == 30 and (rows[1].v, rows[1].note) == (6, "x") and rows[2].note is None
    with pytest.raises(tables.SchemaMismatch):
        tables.merge_table(wrong, filled, ["k"], schema_mode="merge")
    tables.merge_table(less, filled, ["k"], not_matched=None)
    assert tables.history(spark, filled).first().metrics["rows_inserted"] == 0


def test_counts_of_merge_and_delete(spark, filled):
    feed = spark.createDataFrame([(1, "1", 0), (2, "2", 0), (77, "1", 0)], "k long, part string, v int")
    tables.merge_table(feed, filled, ["k"])
    got = tables.history(spark, filled).first().metrics
    assert (got["rows_updated"], got["rows_inserted"]) == (2, 1)
    tables.delete_rows(spark, filled, F.col("v") == 0)
    assert tables.history(spark, filled).first().metrics["rows_deleted"] == 4


def test_batch_ids_count_once(spark, table):
    rows = spark.range(3)
    tables.write_table(rows, table, batch_id="b1")
    assert tables.write_table(rows, table, mode="append", batch_id="b1") == 0
    assert tables.write_table(rows, table, mode="append", batch_id="b2") == 1
    assert tables.read_table(spark, table).count() == 6


def test_new_checkpoint_of_a_stream_loses_nothing(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    schema = "k long, v long"
    jobs.create_empty(spark.createDataFrame([], schema), target)
    for n, checkpoint in ((0, "a"), (1, "a"), (2, "b")):
        rows = spark.range(n * 5, n * 5 + 5).select(F.col("id").alias("k"), F.lit(n).cast("long").alias("v"))
        rows.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        jobs.run_once(jobs.upsert_stream(stream, target, str(tmp_path / checkpoint), ["k"], "same name", trigger=jobs.ONCE))
    assert tables.read_table(spark, target).count() == 15


def test_ranges_survive_writes(spark, table):
    rows = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    tables.write_table(rows, table, files=8)
    tables.optimize(spark, table, 1 << 20, cluster_by=["k"], min_files=8)
    tables.write_table(spark.range(4000, 4100).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("v")), table, mode="append")
    assert tables._existing(spark, table).ranged == ["k"]
    assert len(tables.read_pruned(spark, table, "k", 123).inputFiles()) <= 2
    assert [r.k for r in tables.read_pruned(spark, table, "k", 4050).collect()] == [4050]
    tables.merge_table(spark.createDataFrame([(4050, 9), (9000, 9)], "k long, v long"), table, ["k"])
    assert [r.v for r in tables.read_pruned(spark, table, "k", 4050).collect()] == [9]
    assert tables.read_pruned(spark, table, "k", 9000).count() == 1
    tables.restore(spark, table, 1)
    assert tables.read_pruned(spark, table, "k", 9000).count() == 0 and tables.read_pruned(spark, table, "k", 123).count() == 1


@pytest.mark.parametrize("sizes", [{}, dict(query_rows=3, vector_rows=7)])
@pytest.mark.parametrize("grouped", [False, True])
def test_neighbours_with_broken_vectors_and_text_ids(spark, sizes, grouped):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 4))
    rows = [(f"id{i:02d}", [float(v) for v in r], None if i % 3 == 0 else i % 3) for i, r in enumerate(x)]
    broken = [[float("nan"), 1.0, 1.0, 1.0], [float("inf"), 0.0, 0.0, 0.0], None, [None, 1.0, 1.0, 1.0]]
    rows += [(f"bad{i}", v, 1) for i, v in enumerate(broken)]
    frame = spark.createDataFrame(rows, "id string, vector array<double>, part int")
    got = {}
    for r in knn(frame, frame, 5, exclude_self=True, within=["part"] if grouped else (), **sizes).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    assert len(got) == 50
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, 6)
    for i in range(50):
        others = [j for j in range(50) if j != i and (not grouped or j % 3 == i % 3)]
        want = sorted(others, key=lambda j: (-scores[i, j], j))[:5]
        assert [got[f"id{i:02d}"][r] for r in range(1, 6)] == [f"id{j:02d}" for j in want]


def test_retries_repeat_originals(spark):
    from stratalake.plans import settings
    from stratalake.sources import generators

    rows = generators.call_log(spark, 20_000)
    repeats = 1 - rows.select("request_id").distinct().count() / 20_000
    assert abs(repeats - settings.RETRY_RATE) < 0.005
    wanted = spark.range(20_000).select(F.md5(F.concat(F.lit("42/request/"), "id")).alias("request_id"))
    assert rows.join(wanted, "request_id", "left_anti").count() == 0


def test_character_references_and_keyed_tokens(spark):
    import hashlib
    import hmac

    from stratalake.functions.text import keyed_token, strip_html

    page = "<p>a &amp;lt; b &middot; &copy; &#233; &#x1F600; &nbsp; &eacute &unknown;</p>"
    row = spark.createDataFrame([(page, "x@y")], "h string, v string").select(
        strip_html(F.col("h")), keyed_token(F.col("v"), "key"), keyed_token(F.col("v"), "long key " * 20)
    ).first()
    assert row[0] == "a &lt; b · © é 😀 é &unknown;"
    assert row[1] == hmac.new(b"key", b"x@y", hashlib.sha256).hexdigest()
    assert row[2] == hmac.new(b"long key " * 20, b"x@y", hashlib.sha256).hexdigest()


def test_percentiles_of_a_narrow_cluster_with_an_outlier(spark):
    from stratalake.operators.percentiles import exact_percentiles

    rng = np.random.default_rng(5)
    tiny = np.concatenate([rng.random(3000) * 1e-9, [1e-4, 5e8, float("inf"), -1.0]])
    frame = spark.createDataFrame([("g", float(v)) for v in tiny] + [("h", 2.0)] * 5 + [(None, 1.0), (None, 3.0)], "k string, v double")
    wanted = {"p10": ("v", 0.1), "p50": ("v", 0.5), "p99": ("v", 0.99)}
    got = {r.k: r for r in exact_percentiles(frame, ["k"], wanted, in_memory=0, ordered=7).collect()}
    for name, (_, p) in wanted.items():
        assert np.isclose(got["g"][name], np.quantile(tiny, p), rtol=1e-12)
    assert got["h"].p50 == 2.0 and got[None].p50 == 2.0

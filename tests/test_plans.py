"""Physical plans: what reaches the scan, what is shuffled, what is broadcast."""

import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from oracle import DATA
from stratalake.catalog import all_queries
from stratalake.catalog.derive import raw_calls
from stratalake.operators.merge import merge
from stratalake.plans.llm_calls import daily_metrics, price_list, silver_calls
from stratalake.sources import snapshots as st
from stratalake.sources.parquet import load

SF = f"{DATA}/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(all_queries()["point_filter"](spark, SF))
    assert re.search(r"PushedFilters: \[.*EqualTo\(user_id,42\)", plan)
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_partition_filter_prunes_folders(spark, table):
    events = load(spark, SF, "events").withColumn("day", F.to_date("ts"))
    st.write_table(events, table, partition_by=["day"])
    df = st.read_table(spark, table).where("day = DATE'2024-01-10'").select("value")
    assert re.search(r"PartitionFilters: \[.*day", plan_of(df))
    assert "ReadSchema: struct<value:double>" in plan_of(df)


def test_price_lookup_joins_groups_not_calls(spark):
    calls = silver_calls(raw_calls(spark, SF))
    lines = plan_of(daily_metrics(calls, price_list(spark), exact=False)).splitlines()
    first_join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert "Aggregate" in "\n".join(lines[first_join:])
    assert "SortMergeJoin" not in "\n".join(lines[: first_join + 1])


def test_payload_is_parsed_once(spark):
    raw = spark.createDataFrame([("r", "{}")], "request_id string, raw_json string").withColumn(
        "ts", F.expr("TIMESTAMP_NTZ'2026-01-01 00:00:00'")
    )
    assert plan_of(silver_calls(raw)).count("from_json(") == 1


def test_merge_has_no_full_outer_join(spark):
    target = spark.range(100).withColumn("v", F.lit(1))
    plan = plan_of(merge(target, spark.range(50, 150).withColumn("v", F.lit(2)), ["id"]))
    assert "FullOuter" not in plan and "LeftAnti" in plan


def test_merge_finds_new_rows_in_unpacked_tasks(spark):
    """Packed by shuffled bytes, 9 million keys came to 638 MB of one task."""
    target, source = (spark.range(n, n + 300_000).withColumn("v", F.lit(n)) for n in (0, 200_000))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts > 1
    for check in ("error", "trust"):
        fixed, packed = (merge(target, source, ["id"], on_duplicate=check, keep_action=True, packed=p) for p in (False, True))
        assert "REPARTITION_BY_NUM" in plan_of(fixed) and "REPARTITION_BY_NUM" not in plan_of(packed)
        tasks = fixed.where("_action = 'insert'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks == parts
        assert sorted(fixed.groupBy("_action").count().collect()) == sorted(packed.groupBy("_action").count().collect())


def test_merge_searches_keys_without_file_paths(spark, table):
    st.write_table(spark.range(100).withColumn("v", F.lit(0)), table, files=4)
    dirs = st._existing(spark, table).dirs
    stored = st._read_dirs(spark, table, st._schema(st._existing(spark, table)), dirs)
    found = st._files_with(stored, spark.createDataFrame([(7,), (7,), (None,), (500,)], "id long"), ["id"])
    assert found.count() == 1
    with_keys = [line for line in plan_of(found).splitlines() if "Project [id#" in line]
    assert any("AS _hash#" in line for line in with_keys) and not any("AS _file#" in line for line in with_keys)


def test_a_large_merge_leaves_few_files(spark, table, monkeypatch):
    st.write_table(spark.range(100).withColumn("v", F.lit(0)), table, files=1)
    monkeypatch.setattr(st, "PACKED_ROWS", 10)
    st.merge_table(spark.range(50, 150).withColumn("v", F.lit(1)), table, ["id"])
    assert st.active_files(spark, table).count() == 1
    assert (st.read_table(spark, table).count(), st.read_table(spark, table).where("v = 1").count()) == (150, 100)


def test_merge_reads_only_touched_folders(spark, table):
    rows = spark.range(100).withColumn("part", (F.col("id") % 4).cast("int")).withColumn("v", F.lit(0))
    st.write_table(rows, table, partition_by=["part"])
    st.merge_table(rows.where("id = 8").withColumn("v", F.lit(1)), table, ["id"])
    log = st.history(spark, table).first()
    assert log.metrics["rows_copied"] == 24 and log.metrics["rows_updated"] == 1
    assert st.read_table(spark, table).count() == 100


def test_python_tasks_run_without_the_package_on_their_path(tmp_path):
    """Executors only get what is sent with the job; a foreign working folder stands in for them."""
    script = (
        f"import sys; sys.path.insert(0, {ROOT!r})\n"
        "from stratalake.session import get_spark\n"
        "from stratalake.catalog import all_queries\n"
        "spark = get_spark('elsewhere', 2)\n"
        f"print(all_queries()['knn_label_centroids'](spark, {SF!r}).count() > 0)\n"
    )
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("True"), done.stderr[-2000:]

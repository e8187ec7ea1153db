"""Stateful streams into partitioned tables."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratalake.sources import snapshots as st
from stratalake.sources.landing import landing_stream
from stratalake.streaming import jobs


def test_a_deduplicated_stream_leaves_few_files(spark, table, tmp_path):
    """The log lands three times in files of its own; no task of a batch leaves a file in every partition."""
    days = 3
    rows = [(i, datetime(2024, 1, 1 + i % days) + timedelta(minutes=i)) for i in range(600)]
    log = spark.createDataFrame([*rows, (None, rows[0][1])], "k long, at timestamp").withColumn("day", F.to_date("at"))
    landing = str(tmp_path / "landing")
    for _ in range(3):
        log.coalesce(1).write.mode("append").parquet(landing)
    fresh = jobs.replay_safe(landing_stream(spark, landing, log.schema, files_per_trigger=1), ["k"], "at", "60 days")
    jobs.create_empty(log, table, partition_by=["day"])
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        run = jobs.upsert_stream(fresh, table, str(tmp_path / "checkpoint"), ["k"], "few_files", trigger=jobs.ONCE)
        jobs.run_once(run)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    kept = st.read_table(spark, table)
    assert sorted(tuple(r) for r in kept.select("k", "at").collect() if r.k is not None) == rows
    assert st.active_files(spark, table).count() == days
    versions = [r.metrics.get("rows_inserted") for r in st.history(spark, table).where("operation = 'MERGE'").orderBy("version").collect()]
    assert versions[0] == kept.count() and set(versions[1:]) == {0}


def test_an_insert_only_merge_still_checks_its_source(spark, table):
    """Null keys are inserted, as they meet no row; a repeated key raises, also where the table has no rows."""
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "b"), (None, "b")], "k long, day string")
    jobs.create_empty(rows, table, partition_by=["day"])
    with pytest.raises(Exception, match="more than once"):
        st.merge_table(rows.unionByName(rows.where("k = 1")), table, ["k"])
    st.merge_table(rows, table, ["k"])
    assert sorted(r.k for r in st.read_table(spark, table).where("k IS NOT NULL").collect()) == [1, 2]
    assert st.read_table(spark, table).where("k IS NULL").count() == 2
    assert st.history(spark, table).first().metrics == {"rows_updated": 0, "rows_inserted": 4, "rows_copied": 0, "rows_written": 4}

"""Every registered query on the smallest data, against its SQL where it has one."""

import os

import pytest

from oracle import DATA, compare, connect
from stratalake.catalog import all_oracles, all_queries

SF = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(all_oracles()) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, duck, name):
    df = all_queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    sql = all_oracles().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, duck, sql) == ""


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_approximate_counts_hold_one_sketch_a_group(spark, tmp_path):
    rows = [(i % 7, "ab"[i % 2] if i % 5 else None, f"p{i % 3}") for i in range(60)] + [(None, "c", None)]
    spark.createDataFrame(rows, "user_id long, event_type string, props string").write.parquet(f"{tmp_path}/events.parquet")
    found = all_queries()["approx_distinct_holds"](spark, str(tmp_path))
    assert {tuple(r) for r in found.collect()} == {(t, True, True) for t in ("a", "b", "c", None)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    sketched = [line for line in plan.splitlines() if "approx_count_distinct(" in line and "Aggregate [" in line]
    assert sketched and not any("gid" in line or "user_id" in line.split("]")[0] for line in sketched)

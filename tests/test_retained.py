"""Ageing, stored sketches and routed late rows: interrupted runs, replays, rows out of time."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratalake.operators import retention, sketches
from stratalake.sources.landing import landing_stream
from stratalake.sources.parquet import folders
from stratalake.streaming import jobs, late

KEYS, MEASURES = ["tenant"], {"calls": ("count", "id"), "spent": ("sum", "cents"), "newest": ("max", "ts")}
AS_OF = date(2024, 3, 5)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, ts timestamp_ntz, tenant string, cents int").withColumn("cents", F.col("cents").cast("decimal(10,2)"))


def land(spark, rows, path):
    frame(spark, rows).withColumn("day", F.to_date("ts")).write.mode("append").partitionBy("day").parquet(path)


def some(n, seed, first=datetime(2024, 2, 20)):
    rng = random.Random(seed)
    return [(i, first + timedelta(minutes=rng.randrange(14 * 24 * 60)), rng.choice(["a", "b", None]), rng.randrange(1000)) for i in range(n)]


def plain(rows):
    out = {}
    for _, ts, tenant, cents in rows:
        for grain, cut in (("hour", dict(minute=0)), ("day", dict(hour=0, minute=0)), ("month", dict(day=1, hour=0, minute=0))):
            key = tenant, grain, ts.replace(**cut) if ts else None
            calls, spent, newest = out.get(key, (0, 0, None))
            out[key] = calls + 1, spent + cents, max(filter(None, (newest, ts)), default=None)
    return out


def totals(spark, raw, store):
    found = retention.history(spark, raw, store, "ts", KEYS, MEASURES).collect()
    return {(r.tenant, r.grain, r.period): (r.calls, int(r.spent), r.newest) for r in found}


def test_ageing_keeps_totals_over_cut_off_runs_and_late_rows(spark, tmp_path, monkeypatch):
    raw, store = str(tmp_path / "raw"), str(tmp_path / "store")
    rows = some(400, 1) + [(9_999, None, "a", 3)]
    land(spark, rows, raw)
    want = plain(rows)

    def age(as_of=AS_OF):
        return retention.age(spark, raw, store, as_of, "ts", KEYS, MEASURES)

    with monkeypatch.context() as m:  # ends before the raw rows go
        m.setattr(retention, "delete_folder", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            age()
    moved = age()
    assert moved == [str(date(2024, 2, 20) + timedelta(days=i)) for i in range(7)]
    assert totals(spark, raw, store) == want
    assert not {f"day={d}" for d in moved} & set(folders(spark, raw)) and age() == []
    late_rows = [(10_000 + i, ts, tenant, cents) for i, ts, tenant, cents in some(30, 2) if ts.day < 24]
    land(spark, late_rows, raw)
    assert age() and totals(spark, raw, store) == plain(rows + late_rows)
    assert age(date(2024, 4, 1)) and totals(spark, raw, store) == plain(rows + late_rows)  # only the row without a time is raw
    assert folders(spark, raw) == ["day=__HIVE_DEFAULT_PARTITION__"]
    gone = retention.expire(spark, store, date(2025, 3, 1), 365)
    assert gone and max(gone) < "2024-03-01" and folders(spark, f"{store}/months") == ["month=2024-03-01"]


def test_sketches_merge_like_one(spark):
    rows = spark.range(60_000).selectExpr("id % 6 AS day", "id % 20000 AS user", "CASE WHEN id % 7 > 0 THEN id * 1.5 END AS v")
    mart = sketches.sketch_mart(rows, ["day"], {"users": "user"}, {"values": "v"}, {"even": (F.col("user") % 2 == 0).cast("long")})
    half = sketches.merged(mart, [(F.col("day") % 2).alias("half")], ["users"], ["values"], ["even"])
    whole = sketches.merged(half, [], ["users"], ["values"], ["even"])
    got = whole.select("rows", "even", sketches.distinct("users").alias("users"), sketches.quantile("values", 0.9).alias("p90")).first()
    assert got.rows == 60_000 and got.even == 30_000 and abs(got.users - 20_000) <= 600 and abs(got.p90 - 81_000) <= 900
    empty = sketches.sketch_mart(rows.where("v IS NULL"), ["day"], {"users": "user"}, {"values": "v"})
    assert {r[0] for r in empty.select(sketches.quantile("values", 0.5)).collect()} == {None}


def test_late_rows_are_routed_once(spark, tmp_path):
    landing, path, checkpoint = (str(tmp_path / n) for n in ("landing", "routed", "checkpoint"))
    at = datetime(2024, 1, 1, 12)
    batches = [[(1, at), (2, at + timedelta(hours=5))], [(3, at), (4, at + timedelta(hours=4)), (5, None)], [(6, at + timedelta(hours=9)), (7, at + timedelta(hours=4, minutes=30))]]
    schema = "id long, event_time timestamp"

    def run(name=checkpoint):
        stream = landing_stream(spark, landing, schema, files_per_trigger=1)
        jobs.run_once(late.route_late(stream, path, name, "event_time", timedelta(hours=1), timedelta(minutes=30), "routed", jobs.ONCE))
        return sorted((r.id, r.late) for r in late.routed_rows(spark, path, stream.schema).collect())

    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(landing)
        got = run()
    # the mark after the first batch is 16:30, so the windows of 12:00 and not that of 16:00 have closed
    want = [(1, False), (2, False), (3, True), (4, False), (5, True), (6, False), (7, False)]
    assert got == want and run() == want  # nothing new, nothing changes
    last = tmp_path / "checkpoint" / "commits" / "2"
    last.unlink()
    (tmp_path / "checkpoint" / "commits" / ".2.crc").unlink(missing_ok=True)
    assert run() == want  # the batch is replayed over its own folder
    assert len(run(str(tmp_path / "other"))) == 2 * len(want)  # a new checkpoint adds, the old rows stay
    with pytest.raises(ValueError):
        late.route_late(landing_stream(spark, landing, "late boolean, event_time timestamp"), path, checkpoint, "event_time", timedelta(1), timedelta(1), "x")

"""Operators on small frames against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratalake.functions.payload import is_corrupt, parse_payload, zip_shortest
from stratalake.functions.text import mask_personal, strip_html, windows_of
from stratalake.functions.vectors import cosine, l2_norm, normalised
from stratalake.operators.dedup import first_per_key, top_k_per_key
from stratalake.operators.history import scd2_intervals
from stratalake.operators.impact import downstream
from stratalake.operators.knn import knn
from stratalake.operators.merge import delete_where, merge, merge_metrics, version_diff
from stratalake.operators.percentiles import exact_percentiles


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ── percentiles ─────────────────────────────────────────────────────────────────────────────────


def interpolated(values, p):
    values = sorted(values)
    pos = p * (len(values) - 1)
    lo = math.floor(pos)
    hi = math.ceil(pos)
    return values[lo] * (1 - (pos - lo)) + values[hi] * (pos - lo)


@pytest.mark.parametrize("in_memory", [0, 100_000])
@pytest.mark.parametrize("seed", range(2))
def test_percentiles_match_brute_force(spark, seed, in_memory):
    rnd = random.Random(seed)
    data = []
    for g in ("a", "b", None):
        n = rnd.randint(1, 400)
        for _ in range(n):
            kind = rnd.random()
            v = rnd.gauss(0, 1) if kind < 0.4 else rnd.uniform(-1e9, 1e9) if kind < 0.7 else float(rnd.randint(0, 5))
            data.append((g, v))
    # a hot group whose single value makes up most rows
    data += [("hot", 7.25)] * 2000 + [("hot", 1.0), ("hot", 100.0)]
    df = spark.createDataFrame(data, "g string, v double").withColumn("w", -F.col("v"))
    wanted = {"lo": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "hi": 1.0}
    asked = {n: ("v", p) for n, p in wanted.items()} | {"neg": ("w", 0.5)}
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], asked, in_memory).collect()}
    assert set(got) == {"a", "b", None, "hot"}
    for g, r in got.items():
        values = [v for k, v in data if k == g]
        assert r["neg"] == pytest.approx(interpolated([-x for x in values], 0.5))
        for name, p in wanted.items():
            assert r[name] == pytest.approx(interpolated(values, p), rel=1e-12, abs=1e-12), (g, name)


def test_percentiles_of_close_values_and_infinities(spark):
    values = [1.0 + i * 1e-12 for i in range(999)] + [float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    r = exact_percentiles(
        df, [], {"p50": ("v", 0.5), "hi": ("v", 1.0), "lo": ("v", 0.0)}, in_memory=0
    ).first()
    assert r["p50"] == interpolated(values, 0.5)
    assert r["hi"] == float("inf") and r["lo"] == float("-inf")


# ── dedup ───────────────────────────────────────────────────────────────────────────────────────


def test_first_and_top_k(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("a", 1, "y"), ("b", 2, "z")], "k string, t int, v string")
    assert rows(first_per_key(df, ["k"], ["t"])) == [("a", 1, "y"), ("b", 2, "z")]
    assert first_per_key(df, ["k"], ["t"], keep="any").count() == 2
    assert top_k_per_key(df, ["k"], [F.desc("t")], 2).count() == 3


def test_dedup_cuts_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = first_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# ── merge ───────────────────────────────────────────────────────────────────────────────────────


@pytest.fixture(scope="module")
def sides(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (2, "b2", 21), (None, "n", 0)], "k int, s string, v int")
    source = spark.createDataFrame([(2, None, 99), (3, "c", 30), (None, "m", 1)], "k int, s string, v int")
    return target, source


def test_merge_all(sides):
    out = rows(merge(*sides, ["k"]))
    assert out == sorted([(1, "a", 10), (2, None, 99), (2, None, 99), (None, "n", 0), (3, "c", 30), (None, "m", 1)], key=repr)


def test_merge_partial_and_update_only(sides):
    out = rows(merge(*sides, ["k"], matched={"v": F.col("s.v") + F.col("t.v")}, not_matched=None))
    assert out == sorted([(1, "a", 10), (2, "b", 119), (2, "b2", 120), (None, "n", 0)], key=repr)


def test_merge_condition_and_metrics(sides):
    merged = merge(*sides, ["k"], condition=F.col("s.v") > F.col("t.v") + 78, keep_action=True)
    assert merge_metrics(merged).first().asDict() == {
        "rows_updated": 1, "rows_inserted": 2, "rows_copied": 3, "rows_written": 6,
    }


def test_merge_is_idempotent(sides):
    once = merge(*sides, ["k"])
    keyed = sides[1].where("k IS NOT NULL")
    assert rows(merge(merge(sides[0], keyed, ["k"]), keyed, ["k"])) == rows(merge(sides[0], keyed, ["k"]))
    assert once.count() == 6


def test_merge_rejects_duplicate_source_keys(spark, sides):
    twice = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (5, "z", 3)], "k int, s string, v int")
    with pytest.raises(PySparkException, match="more than once"):
        merge(sides[0], twice, ["k"]).collect()
    latest = merge(sides[0], twice, ["k"], on_duplicate="latest", order_by=[F.desc("v")])
    assert (2, "y", 2) in rows(latest) and (2, "x", 1) not in rows(latest)


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert rows(delete_where(df, F.col("v") > 2)) == [(1,), (None,)]


def test_version_diff(spark):
    before = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None), (4, 4.0)], "k int, v double")
    after = spark.createDataFrame([(1, 1.5), (2, float("nan")), (3, None), (5, 5.0)], "k int, v double")
    assert rows(version_diff(before, after, ["k"], "v")) == [(1, 1.0, 1.5, 0.5)]
    kinds = {r["k"]: r["change"] for r in version_diff(before, after, ["k"], "v", include_added_removed=True).collect()}
    assert kinds == {1: "changed", 4: "removed", 5: "added"}


# ── history ─────────────────────────────────────────────────────────────────────────────────────


def test_scd2_sliced_equals_plain(spark):
    rnd = random.Random(5)
    data = [(rnd.choice("ab"), t, rnd.choice("xyz")) for t in range(300)] + [("hot", t, "x") for t in range(300, 700)]
    data += [(None, t, rnd.choice("xy")) for t in range(50)]
    df = spark.createDataFrame(data, "k string, t int, s string")
    plain = scd2_intervals(df, ["k"], ["t"], ["s"], "t")
    sliced = scd2_intervals(df, ["k"], ["t"], ["s"], "t", slice_of=F.floor(F.col("t") / 7))
    assert rows(plain) == rows(sliced)
    assert plain.where("k = 'hot'").count() == 1


# ── text, json, vectors ─────────────────────────────────────────────────────────────────────────


@pytest.mark.parametrize("overlap", [0, 3, 5])
@pytest.mark.parametrize("n", [1, 9, 10, 11, 17, 18, 40, 123])
def test_windows(spark, n, overlap):
    text = ("aé😀b\n" * n)[:n]
    got = spark.createDataFrame([(text,)], "t string").select(windows_of(F.col("t"), 10, overlap)).first()[0]
    step = 10 - overlap
    count = 1 if n <= 10 else math.ceil((n - overlap) / step)
    assert got == [text[i * step : i * step + 10] for i in range(count)]


def test_corrupt_payloads(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": "x"}',), ("bad",), (None,)], "raw string")
    got = parse_payload(df, "raw", "a int").select("raw", is_corrupt().alias("c")).collect()
    assert [r["c"] for r in got] == [False, True, True, True]


def test_zip_shortest(spark):
    df = spark.createDataFrame([(["a", "b", "c"], [1, 2])], "x array<string>, y array<int>")
    out = df.select(zip_shortest(F.col("x"), F.col("y"), ("p", "q"))).first()[0]
    assert [tuple(r) for r in out] == [("a", 1), ("b", 2)]


def brute_knn(ids, m, k, exclude_self):
    unit = np.sqrt((m * m).sum(1))
    s = np.round(m @ m.T / (np.outer(unit, unit) + 1e-9), 6)
    out = []
    for i, q in enumerate(ids):
        order = sorted((-s[i, j], ids[j]) for j in range(len(ids)) if not (exclude_self and j == i))[:k]
        out += [(q, v, round(-neg, 6), r + 1) for r, (neg, v) in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"query_rows": 20, "vector_rows": 17}])
@pytest.mark.parametrize("exclude_self", [True, False])
def test_knn(spark, options, exclude_self):
    rng = np.random.default_rng(0)
    m = rng.normal(size=(60, 8)).astype(np.float32)
    m[30:50] = m[7]  # a third of the vectors are the same
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(60)], "id long, vector array<float>").repartition(3)
    got = knn(df, df, 4, exclude_self=exclude_self, **options)
    got = sorted((r.query_id, r.vec_id, round(r.score, 6), r.rank) for r in got.collect())
    assert got == brute_knn(list(range(60)), m.astype(np.float64), 4, exclude_self)


def test_knn_without_queries(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0])], "id long, vector array<float>")
    assert knn(df.where("id > 1"), df, 3).count() == 0
    assert knn(df, df.where("id > 1"), 3, vector_rows=1).count() == 0


def test_cosine_of_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0])], "a array<float>, b array<float>")
    assert df.select(cosine(F.col("a"), F.col("b"))).first()[0] == 0.0


def test_normalised_vectors(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],), (None,)], "a array<float>")
    got = [r[0] for r in df.select(normalised(F.col("a"))).collect()]
    assert got[0] == [0.0, 0.0] and got[1] == pytest.approx([0.6, 0.8]) and got[2] is None
    assert df.agg(F.max(l2_norm(F.col("a")))).first()[0] == 5.0


def test_downstream_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "source string, target string")
    start = spark.createDataFrame([("a",)], "node string")
    assert rows(downstream(edges, start)) == [("a", 0), ("b", 1), ("c", 2)]


def test_masking_and_html(spark):
    df = spark.createDataFrame([("mail a.b@c.org or +49 170 1234567 now", "<p>a&lt;b</p><script>x</script> &amp;lt; c")], "t string, h string")
    masked, text = df.select(mask_personal(F.col("t")), strip_html(F.col("h"))).first()
    assert masked == "mail <email> or <number> now"
    assert text == "a<b &lt; c"

import os

import numpy as np
import pytest

from oracle import DATA
from stratalake.llm import imi


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def test_walk_takes_cells_by_rising_distance():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 5, (7, 9))
    grid = imi.Grid(np.zeros((7, 1)), np.zeros((9, 1)), counts)
    a, b = rng.random(7), rng.random(9)
    sums = a[:, None] + b[None, :]
    for wanted in (1, 10, 40, int(counts.sum()), 10**6):
        passed = grid.walk(a, b, wanted)
        order = np.argsort(sums, axis=None)
        upto = np.cumsum(counts.ravel()[order])
        n = min(int(np.searchsorted(upto, wanted)) + 1, counts.size)
        assert set(np.flatnonzero(passed)) == set(order[:n])


@pytest.mark.parametrize("sizes", [dict(block_rows=40, query_rows=7), dict()])
def test_all_cells_give_the_exact_answer(spark, sizes):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[50:120] = x[50]  # one vector holds a large share
    rows = [(int(i), [float(v) for v in r], 1, "x") for i, r in enumerate(x)]
    rows += [(1000, None, 1, "x"), (1001, [0.0] * 8, 1, "x"), (1002, [float("nan")] * 8, 1, "x"), (1003, [None] + [1.0] * 7, 1, "x"),
             (1004, [float("inf")] * 8, 1, "x"), (1005, [1.0], 1, "x"), (1010, [], 1, "x"), (None, [1.0] * 8, 1, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, i int, query string")
    got = {}
    for r in imi.search(frame, "vec_id % 10 = 0", share=1.0, centroids=6, **sizes).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(np.arange(300), x.astype(np.float64), range(0, 300, 10), 10)
    assert set(got) == set(want)
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11))
        assert [r[1] for r in rows] == [v for v, _ in want[q]]
        assert np.allclose([r[2] for r in rows], [d for _, d in want[q]], rtol=1e-12)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 1.0]), (2, [3.0, 1.0])], schema)
    rows = sorted((r.rank, r.vec_id) for r in imi.search(few, "vec_id = 0").collect())
    assert rows == [(1, 1), (2, 2), (3, 2)]
    assert imi.search(few, "vec_id = 77").count() == 0
    assert imi.search(spark.createDataFrame([], schema), "vec_id = 0").count() == 0
    assert imi.search(spark.createDataFrame([(0, None)], schema), "vec_id = 0").count() == 0


@pytest.mark.skipif(not os.path.isdir(f"{DATA}/sf0.1"), reason="driver tables not present")
def test_recall(spark):
    frame = spark.read.parquet(f"{DATA}/sf0.1/embeddings.parquet")
    rows = frame.select("vec_id", "embedding").toPandas().sort_values("vec_id")
    x = np.stack(rows["embedding"].to_list()).astype(np.float64)
    ids = rows["vec_id"].to_numpy()
    want = brute(ids, x, np.flatnonzero(ids % 100 == 0), 10)
    found = {}
    for r in imi.search(frame, "vec_id % 100 = 0").collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    recall = np.mean([len(found[q] & {v for v, _ in near}) / len(near) for q, near in want.items()])
    assert recall >= 0.9


def test_repeated_queries_doubles_and_large_norms(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(60, 6)) + 1e6  # distances are small beside the norms
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [rows[0], rows[0]]  # the same query three times
    found = imi.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 20 = 0", k=5, share=1.0).collect()
    for q in (0, 20, 40):
        got = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        others = [(float(np.sqrt(((v - vectors[q]) ** 2).sum())), i) for i, v in (*enumerate(vectors), (0, vectors[0]), (0, vectors[0])) if i != q]
        want = sorted(others)[:5]
        assert [g[0] for g in got] == [1, 2, 3, 4, 5] and [g[1] for g in got] == [i for _, i in want]
        assert [g[2] for g in got] == pytest.approx([d for d, _ in want], rel=1e-12)

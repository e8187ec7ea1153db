import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import DATA
from stratalake.llm import quality, toxicity

SF = f"{DATA}/sf0.01"


def test_contexts_are_sums_of_index_vectors():
    index = quality.index_vectors(50, 8)
    assert (np.abs(index[:-1]).sum(axis=1) == quality.NONZERO).all() and not index[-1].any()
    docs = [[3, 3, 7], [], [1], [4, 2, 9, 4, 2]]
    table = np.zeros((50, 8), np.int64)
    quality.add_contexts(table, index, np.array(sum(docs, []), np.uint16), np.array([len(d) for d in docs]))
    want = np.zeros((50, 8), np.int64)
    for d in docs:
        for i, row in enumerate(d):
            for j in range(max(0, i - 2), min(len(d), i + 3)):
                want[row] += index[d[j]] if j != i else 0
    assert (table == want).all()


def test_pooling_does_not_cross_documents():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(20, 4)).astype(np.float32)
    docs = [[1, 2, 2], [], [5], list(range(20))]
    together = quality.pooled(v, np.array(sum(docs, []), np.uint16), np.array([len(d) for d in docs]))
    for d, row in zip(docs, together):
        assert np.allclose(quality.pooled(v, np.array(d, np.uint16), np.array([len(d)]))[0], row, atol=1e-6)
    assert not together[1].any() and np.allclose(together[0][:4], v[[1, 2, 2]].mean(axis=0), atol=1e-6)


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 6))
    p = quality.sigmoid(2.5 * x[:, 0] * x[:, 1])  # no linear model finds this
    y = (rng.random(4000) < p).astype(float)
    net = quality.train(x[:3000], y[:3000], epochs=80)
    q = net.probability(x[3000:])
    assert np.mean((q > 0.5) == (p[3000:] > 0.5)) > 0.85
    for low, high in ((0.0, 0.3), (0.3, 0.7), (0.7, 1.0)):
        part = (q >= low) & (q <= high)
        assert abs(q[part].mean() - y[3000:][part].mean()) < 0.1
    assert np.allclose(quality.train(np.zeros((0, 6)), np.zeros(0)).probability(x[:3]), 0.5)
    assert quality.train(x[:8], np.ones(8)).probability(x[:3]).min() > 0.8


def test_machine_is_a_sum_over_pairs_and_learns_them():
    rng = np.random.default_rng(4)
    m = toxicity.Machine({}, -0.5, rng.normal(size=9), rng.normal(size=(9, 3)))
    rows = np.array([0, 3, 4, 8])
    pairs = sum(float(m.factors[a] @ m.factors[b]) for i, a in enumerate(rows) for b in rows[i + 1 :])
    assert np.isclose(m.logit(rows), m.bias + m.weights[rows].sum() + pairs)
    # toxic only if an insult meets a group; either alone is clean
    samples, y = [], []
    for i in range(3000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = {100 + int(rng.integers(40)) for _ in range(5)} | ({1} if insult else set()) | ({2} if group else set())
        samples.append(np.array(sorted(words), np.int32))
        y.append(float(insult and group))
    model = toxicity.train(samples, np.array(y), space=256)
    rows = [np.array([model.keep[t] for t in s if t in model.keep], np.int32) for s in samples]
    got = np.array([model.logit(r) > 0 for r in rows])
    assert (got == np.array(y)).mean() > 0.97


def test_terms_that_are_weak_alone_are_kept_for_their_pair():
    rng = np.random.default_rng(6)
    samples, y = [], []
    for i in range(12_000):
        words = {100 + int(t) for t in rng.integers(400, size=12)}
        words |= ({1} if rng.random() < 0.05 else set()) | ({2} if rng.random() < 0.04 else set())
        toxic = {1, 2} <= words or rng.random() < 0.1
        samples.append(np.array(sorted(words), np.int32))
        y.append(float(toxic))
    y = np.array(y)
    n, positive = (np.bincount(np.concatenate(samples), np.repeat(w, [len(s) for s in samples]), 512) for w in (np.ones(len(y)), y))
    alone = np.abs(positive - y.mean() * n) / np.sqrt(n * y.mean() * (1 - y.mean()) + 1)
    assert alone[[1, 2]].max() < toxicity.STRENGTH
    assert set(toxicity.pair_strengths(samples, y, n, positive)) == {1, 2} <= set(toxicity.choose(samples, y, 512).tolist())
    # brute force over all pairs, with a lower bar so that several pass
    got, want, share = toxicity.pair_strengths(samples, y, n, positive, 3.0, 5), {}, (positive + y.mean()) / (n + 1)
    has = np.zeros((len(y), 512), np.float32)
    for i, s in enumerate(samples):
        has[i, s] = 1
    both, bad = has.T @ has, has.T @ (has * y[:, None].astype(np.float32))
    for a in range(512):
        for b in range(a + 1, 512):
            r = max(share[a], share[b])
            strength = (bad[a, b] - r * both[a, b]) / np.sqrt(both[a, b] * r * (1 - r) + 1)
            if bad[a, b] >= 5 and strength >= 3.0:
                for t in (a, b):
                    want[t] = max(want.get(t, 0), strength)
    assert len(want) > 4 and got.keys() == want.keys() and all(np.isclose(got[t], want[t], rtol=1e-5) for t in want)
    model = toxicity.train(samples, y, space=512)
    logit = {t: model.logit(np.array([model.keep[x] for x in t if x in model.keep], np.int32)) for t in ((1,), (2,), (1, 2))}
    assert logit[1, 2] > 0 > max(logit[1,], logit[2,]) + 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("module, label, modulus, remainder, least", [(quality, "quality", 5, 0, 0.95), (toxicity, "toxic", 3, 1, 0.93)])
def test_held_out_accuracy(spark, module, label, modulus, remainder, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = module.score(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == remainder) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r[label] is not None]
    assert np.mean([r.predicted == r[label] for r in held]) >= least
    # labels of held-out rows and other columns never matter
    flipped = labels.withColumn(label, F.when(module.held_out(modulus, remainder), 1 - F.col(label)).otherwise(F.col(label)))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0)})
    again = {r.doc_id: r.score for r in module.score(other, flipped).collect()}
    assert all(np.isclose(r.score, again[r.doc_id], atol=1e-9) for r in rows)


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, odd_docs, make_docs, module, label):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (4, None), (None, 1), (99, 1), (8, 0)], f"doc_id long, {label} int")
    rows = module.score(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(r.score is not None for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[2] == by[3] and by[4] == by[5] and [r.held_out for r in rows if r.doc_id is None] == [False]
    nothing = spark.createDataFrame([], f"doc_id long, {label} int")
    assert {r.score for r in module.score(odd_docs, nothing).collect()} == {0.5}
    assert module.score(make_docs([]), labels).count() == 0

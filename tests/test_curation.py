"""Benchmark passages, near copies and change feeds against plain Python, on odd rows and hot keys."""

import random
import re
from itertools import combinations

import pytest

from stratalake.operators import contamination, feed, near_copies

DOCS = "doc_id long, text string, source string, licence string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def sentence(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "Gamma", "delta", "éta", "zeta1", "x"]) + rng.choice(["", "", ",", "."]) for _ in range(n))


def plain_hits(docs, items, n):
    out = {}
    for doc, text in set(docs):
        for item, passage in items:
            a, b = words(text), words(passage)
            lines = {(i, j) for i in range(len(a) - n + 1) for j in range(len(b) - n + 1) if a[i : i + n] == b[j : j + n]}
            runs = [next(k for k in range(1, len(a)) if (i + k, j + k) not in lines) + n - 1 for i, j in lines if (i - 1, j - 1) not in lines]
            if lines:
                grams, run = out.get((doc, item), (0, 0))
                out[doc, item] = max(grams, len({tuple(a[i : i + n]) for i, _ in lines})), max(run, *runs)
    return sorted((d, i, *v) for (d, i), v in out.items())


@pytest.mark.parametrize("n", [3, 13])
def test_contamination(spark, n, monkeypatch):
    monkeypatch.setattr(contamination, "MOST_BITS", 256)  # a full filter must not change the result
    rng = random.Random(n)
    items = [(i, sentence(rng, 25)) for i in range(6)] + [(6, None), (7, "too short")]
    docs = [(i, sentence(rng, 30)) for i in range(12)]
    docs += [(20 + i, f"{sentence(rng, 5)} {p.upper()} {sentence(rng, 4)} {p}") for i, (_, p) in enumerate(items[:6])]
    docs += [(40 + i, items[0][1]) for i in range(30)]  # one passage in most documents
    docs += [(1, docs[1][1]), (2, items[1][1]), (50, None), (51, "")]  # a repeated row, two texts of one id
    got = contamination.contamination(
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS words", "0 AS copy", "1 AS gram"),
        spark.createDataFrame(items, "item_id long, text string"), n,
    )
    assert sorted(tuple(r) for r in got.collect()) == plain_hits(docs, items, n)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_shards_and_checkpoints(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "doc_id long, shard_id string")
    report = spark.createDataFrame([(1, 9, 3, 30), (3, 9, 1, 13)], "doc_id long, item_id long, shared_grams long, longest_run long")
    shards = contamination.shard_report(docs, report, 20)
    assert {r.shard_id: (r.documents, r.hit_documents, r.reverted) for r in shards.collect()} == {"a": (2, 1, True), "b": (1, 0, False), None: (1, 0, False)}
    assert sorted(r.doc_id for r in contamination.without_reverted(docs, shards).collect()) == [3, 4]
    training = spark.createDataFrame([("c1", "b"), ("c2", "a"), ("c2", "b"), ("c2", "b")], "checkpoint string, shard_id string")
    assert {r.checkpoint: (r.shards, r.hit_shards, r.clean) for r in contamination.exposed_checkpoints(training, shards).collect()} == {"c1": (1, 0, True), "c2": (2, 1, False)}


def plain_groups(rows):
    sets = {}
    for i, (_, text, *_) in enumerate(rows):
        w = words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    group = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        union = len(sets[i] | sets[j])
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * union:
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    ids = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    return [ids[g] for g in group]


def test_groups_of_near_copies(spark):
    rng = random.Random(9)
    rows = []
    for g in range(12):  # chains of small edits: the ends are less similar than neighbours
        text = [f"w{rng.randint(0, 400)}" for _ in range(60)]
        for _ in range(rng.randint(1, 9)):
            rows.append((len(rows), " ".join(text), f"s{g % 4}", None))
            text[rng.randint(0, 59)] = f"v{rng.randint(0, 99)}"
    base = [f"b{i}" for i in range(80)]
    rows += [(1000 + i, " ".join([*base, f"own{i}"]), "hot", "MIT") for i in range(60)]
    rows += [(2000, None, "s", "MIT"), (2001, "", "s", None), (2002, "two words", "s", "odd"), (2003, "Two, words!", "s", "CC-BY"), (None, "two words", "t", "MIT")]
    rows += [rows[3], rows[3]]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS node", "1 AS label", "2 AS size")
    got = near_copies.groups(docs)
    key = lambda pair: tuple((v is None, v) for v in pair)
    assert sorted(((r.doc_id, r.group_id) for r in got.collect()), key=key) == sorted(zip([r[0] for r in rows], plain_groups(rows)), key=key)
    kept = {r.group_id: r for r in near_copies.keep_one(got).collect()}
    assert kept[1000].members == 60 and kept[1000].licence == "MIT"
    assert (kept[2002].licence, kept[2002].members, kept[2002].sources) == ("unknown", 3, ["s", "t"])
    assert near_copies.groups(docs.limit(0)).count() == 0


def test_one_large_group_is_linear(spark, monkeypatch):
    base = [f"b{i}" for i in range(200)]
    rows = [(i, " ".join([*base, f"own{i}"]), "hot", "MIT") for i in range(300)]
    seen = []
    verified = near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *a: seen.append(pairs.count()) or verified(pairs, *a))
    assert {r.group_id for r in near_copies.groups(spark.createDataFrame(rows, DOCS)).collect()} == {0}
    assert sum(seen) <= 2 * len(rows)


def test_near_copies_store_no_sets(spark, monkeypatch, tmp_path):
    rng = random.Random(4)
    frequent = " ".join(f"line{i}" for i in range(40))  # in every text, so its shingles must not make pairs
    rows = [(i, " ".join([frequent, *(f"w{rng.randint(0, 50_000)}" for _ in range(400))]), "s", "MIT") for i in range(300)]
    rows += [(1000 + i, text.replace("line7", "other"), "s", "MIT") for i, text, *_ in rows[:20]]
    monkeypatch.setattr("stratalake.session.scratch_root", lambda spark: str(tmp_path))
    got = near_copies.groups(spark.createDataFrame(rows, DOCS))
    assert {r.doc_id: r.group_id for r in got.collect()} == {i: i % 1000 for i, *_ in rows}
    stored = sum(f.stat().st_size for f in (tmp_path / "stratalake").rglob("*.parquet"))
    assert stored < 1.5 * sum(len(text) for _, text, *_ in rows)


def test_feed_in_any_order(spark):
    rng = random.Random(2)
    keys = [*range(20), None]
    changes = [(rng.choice(keys), i, rng.choice("IUDrc"), f"v{i}") for i in rng.sample(range(1, 500), 150)]
    last = {}
    for key, seq, op, value in [*((k, 0, "I", "start") for k in range(0, 20, 2)), *sorted(changes, key=lambda c: c[1])]:
        last[key] = None if op == "D" else value
    want = sorted(((k, v) for k, v in last.items() if v is not None), key=str)
    frame = spark.createDataFrame(changes, "k long, seq long, op string, v string")
    for seed in (1, 2):
        state = feed.initial_state(spark.createDataFrame([(k, "start") for k in range(0, 20, 2)], "k long, v string"))
        for part in (*frame.randomSplit([1.0, 1.0, 1.0], seed), frame.sample(0.3, seed=seed)):
            state = feed.apply_changes(state, feed.as_changes(part, ["k"], "seq", "op"), ["k"])
            state = state.checkpoint() if spark.sparkContext.getCheckpointDir() else spark.createDataFrame(state.collect(), state.schema)
        assert sorted(((r.k, r.v) for r in feed.live_rows(state).collect()), key=str) == want
    assert feed.without_old_tombstones(state, 10_000).where("is_deleted").count() == 0


def test_feed_refuses_unknown_changes(spark):
    for row in ((1, None, "I", "v"), (1, 5, "Z", "v"), (1, 5, None, "v")):
        changes = spark.createDataFrame([row], "k long, seq long, op string, v string")
        with pytest.raises(Exception, match="known operation"):
            feed.as_changes(changes, ["k"], "seq", "op").collect()


def test_sentence_chunks(spark):
    from stratalake.functions.text import sentence_windows_of

    texts = ["", "One. Two! Three? Four", "No end at all and much longer than the size", 'He said "go." Then left.\nNew line\n\nlast', "é. ü! " * 9, "...", "a" * 45 + ". b", "😀. 😀😀! x"]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    for size in (4, 12, 20):
        for row in df.select("text", sentence_windows_of(df.text, size).alias("found")).collect():
            if row.text is None:
                assert row.found is None
                continue
            assert "".join(row.found) == row.text and all(0 < len(c) <= size for c in row.found)
            for chunk in row.found[:-1]:  # only a text without a border is cut elsewhere
                border = re.search(r"""([.!?]["')\]]?[ \t]|\n)$""", chunk)
                assert border or (len(chunk) == size and not re.search(r"[.!?][ \t]|\n", chunk[: size - 2]))


def test_distribution_drift(spark):
    from pyspark.sql import functions as F

    from stratalake.operators.drift import distribution_drift

    rng = random.Random(3)
    rows = [(k, rng.choice((0.1, 0.25, rng.random(), rng.random() ** (2 if late else 1))), late) for k in ("a", None) for late in (True, False) for _ in range(300)]
    rows += [("a", None, True), ("a", float("nan"), False), ("a", 0.5, None), ("b", 0.5, True), ("a", 7.0, True), ("a", -7.0, False)]
    got = {r.k: r for r in distribution_drift(spark.createDataFrame(rows, "k string, s double, late boolean"), ["k"], "s", F.col("late")).collect()}
    for key in ("a", None):
        sides = [[s for k, s, late in rows if k == key and late is side and s is not None and s == s] for side in (False, True)]
        points = sorted({*sides[0], *sides[1]})
        ks = max(abs(sum(v <= p for v in sides[0]) / len(sides[0]) - sum(v <= p for v in sides[1]) / len(sides[1])) for p in points)
        assert got[key].ks == pytest.approx(ks, abs=1e-6) and (got[key].scores_before, got[key].scores_after) == (len(sides[0]), len(sides[1]))
        assert got[key].psi > 0
    assert got["b"].ks is None and got["b"].psi is None and got["b"].scores_before == 0

from collections import Counter, defaultdict

import pytest

from stratalake.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    wanted, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = wanted - sum(cap * sizes[s] for s in capped)
        level = rest / sum(w[s] for s in free) if free else 0
        over = {s for s in free if level * w[s] > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in capped else level * w[s] for s in order}
        capped |= over


@pytest.fixture
def rows():
    out = [(i, f"w{i} " * (1 + i % 50), ["hot", "a", None, "b", "ü"][0 if i % 3 == 0 else 1 + i % 4]) for i in range(2000)]
    return out + [(9000, "", "a"), (9001, None, "b"), (9002, "lonely", "zz"), (9003, " ", "empty")]


def test_plan(make_docs, rows):
    got = mixing.plan_mix(make_docs(rows), cell_rows=50).collect()
    assert len(got) == len(rows)
    text = {d: t for d, t, _ in rows}
    sizes = Counter()
    for d, t, s in rows:
        sizes[s] += len((t or "").split())
    targets, taken, most = plain_targets(sizes), Counter(), Counter()
    for r in got:
        assert r.size == len((text[r.doc_id] or "").split()) and r.source_size == sizes[r.source]
        assert abs(r.target - targets[r.source]) < 1e-6 and r.taken == r.size * r.copies <= 2 * r.size
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    assert all(abs(taken[s] - targets[s]) <= most[s] / 2 + 1e-6 for s in sizes)
    starts = defaultdict(list)
    for r in got:
        starts[r.source].append((r.start, r.size))
    for source, line in starts.items():  # documents lie end to end along their source
        line = sorted(x for x in line if x[1])
        assert [s for s, _ in line] == [sum(n for _, n in line[:i]) for i in range(len(line))]


def test_positions_invert_the_demand(make_docs, rows):
    from pyspark.sql import functions as F

    got = mixing.plan_mix(make_docs(rows)).withColumn("position", mixing.position_of_copy(F.lit(0))).where("copies > 0").collect()
    for r in got:
        done = min(1.0, (r.start + r.size / 2) / r.target)
        assert 0 <= r.position <= 1
        assert abs((1 - r.ramp) * r.position + r.ramp * r.position**2 - done) < 1e-6


def test_mix(make_docs, rows):
    docs = make_docs(rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.plan_mix(docs).collect()}
    found = Counter(r.doc_id for r in mixed.collect())
    assert found == Counter({d: max(n, 1) if not (dict((a, b) for a, b, _ in rows)[d] or "").split() else n for d, n in copies.items() if n or not (dict((a, b) for a, b, _ in rows)[d] or "").split()})
    assert [r.doc_id for r in mixing.mix(docs).collect()] == [r.doc_id for r in mixed.collect()]


def test_odd_rows(odd_docs, make_docs):
    got = mixing.plan_mix(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert mixing.mix(odd_docs).columns == odd_docs.columns and mixing.mix(odd_docs).count() > 0
    assert mixing.plan_mix(make_docs([])).count() == 0 and mixing.mix(make_docs([])).count() == 0
    assert {r.taken for r in mixing.plan_mix(make_docs([(1, ""), (2, None)])).collect()} == {0}

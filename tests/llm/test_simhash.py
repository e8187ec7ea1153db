import random
from itertools import combinations

import pytest
import xxhash

from stratalake.llm import simhash


def plain_fingerprint(text, words=3):
    tokens = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        tokens = tokens.replace(c, " ")
    tokens = [t for t in tokens.split(" ") if t]
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(prints, 2):
        if bin(a ^ b).count("1") <= bits:
            parent[root(a)] = root(b)
    return {p: root(p) for p in prints}


@pytest.mark.parametrize("text", ["", " ", "One", "A b\tC d\x0be\nf", "same same same same same", "É É é x y z", "w " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_spark_hash_agrees(spark):
    assert spark.sql("SELECT xxhash64('a b c')").first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("bits", [0, 1, 2])
@pytest.mark.parametrize("paired", [1, 3, 1000])
def test_links_connect_what_is_close(spark, bits, paired):
    rng = random.Random(bits)
    prints = set()
    for _ in range(6):
        center = rng.getrandbits(64)
        prints |= {center} | {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(30)}
    chain = rng.getrandbits(64)
    for b in range(0, 40, 2):  # each differs from the last in two bits
        chain ^= 3 << b
        prints.add(chain)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), bits, paired)
    rows = edges.collect()
    assert all(bin((r.a ^ r.b) % (1 << 64)).count("1") <= bits for r in rows)
    found = {r.node: r.component for r in simhash.components(edges).collect()}
    want = plain_components([p % (1 << 64) for p in signed], bits)
    got = {}
    for p in signed:
        got.setdefault(found.get(p, p), set()).add(p % (1 << 64))
    expected = {}
    for p, r in want.items():
        expected.setdefault(r, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_documents_against_brute_force(make_docs):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(50)]
    rows, n = [], 0
    for _ in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 5, 200, 400]))]
        for _ in range(rng.randint(1, 5)):
            copy = list(text)
            if rng.random() < 0.5:
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((n * 7 % 101, " ".join(copy)))
            n += 1
    rows += [(500, None), (501, ""), (502, " \n")]
    got = {r.doc_id: r for r in simhash.near_duplicates(make_docs(rows)).collect()}
    prints = {d: plain_fingerprint(t) for d, t in rows}
    roots = plain_components(sorted(set(prints.values())), 2)
    for d in prints:
        assert got[d].fp % (1 << 64) == prints[d]
        assert got[d].component_id == min(e for e in prints if roots[prints[e]] == roots[prints[d]])
    kept = {r.doc_id for r in simhash.keep_one(make_docs(rows)).collect()}
    assert kept == {r.component_id for r in got.values()}


def test_odd_rows(odd_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r.component_id for r in rows}
    assert by[2] == by[3] == by[6] == 2 and by[4] == by[5] == 4 and by[None] is None
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 4, 7, 8]


def test_empty(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.keep_one(make_docs([])).count() == 0


def test_component_without_ids_keeps_one_row(make_docs):
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(words + [f"end{i}"]) for i in range(40)]
    prints = {t: simhash.fingerprint(t) for t in texts}
    pair = next((a, b) for a, b in combinations(texts, 2) if 1 <= bin((prints[a] ^ prints[b]) % (1 << 64)).count("1") <= 2)
    assert simhash.keep_one(make_docs([(None, t) for t in pair])).count() == 1

import zlib
from collections import Counter, defaultdict

from stratalake.llm import sharding


def check(rows, docs, shards):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs
    )
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_shards_are_near_equal_with_a_hot_text(make_docs):
    docs = [(i, f"text {i} " * (1 + i % 40)) for i in range(3000)] + [(5000 + i, "the one text that a third of all rows have " * 5) for i in range(1500)]
    rows = sharding.shard(make_docs(docs), shards=10).collect()
    sizes = check(rows, docs, 10)
    mean = sum(sizes.values()) / 10
    assert max(sizes.values()) < 1.03 * mean and min(sizes.values()) > 0.97 * mean
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.shard(make_docs(docs), shards=10).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_small_groups_of_equal_texts_stay_together(make_docs):
    docs = [(i, f"text {i // 3} " * 20) for i in range(3000)]
    where = defaultdict(set)
    for r in sharding.shard(make_docs(docs), shards=5).collect():
        where[r.doc_id // 3].add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_one_long_text_and_few_rows(make_docs):
    docs = [(1, "x" * 100_000), (2, "a"), (3, "b"), (4, None)]
    check(sharding.shard(make_docs(docs), shards=40).collect(), docs, 40)


def test_odd_rows(odd_docs, make_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(sharding.shard(odd_docs).collect(), docs, 40)
    same = [(1, "same")] * 50
    check(sharding.shard(make_docs(same), shards=4).collect(), same, 4)
    assert sharding.shard(make_docs([])).count() == 0


def test_a_heavy_text_without_ids_or_of_equal_rows_is_cut(make_docs):
    for hot in ([(None, "the hot text " * 8)] * 4000, [(7, "the hot text " * 8)] * 4000):
        docs = hot + [(100 + i, f"text {i} " * 12) for i in range(1000)]
        rows = sharding.measured(make_docs(docs))
        total = sum(len(t.encode()) + 16 for _, t in docs)
        cells = sharding.ranged(rows, total, 10, 4, 64).where("cut").groupBy("key", "sub").count().collect()
        assert sum(r["count"] for r in cells) == 4000 and max(r["count"] for r in cells) < 60
        drawn = rows.where(f"draw < size / ({total} / 640)").count()  # the sample that goes to the driver
        assert 400 < drawn < 900
        sizes = check(sharding.shard(make_docs(docs), shards=10).collect(), docs, 10)
        mean = sum(sizes.values()) / 10
        assert max(sizes.values()) < 1.03 * mean and min(sizes.values()) > 0.97 * mean

import os
import random
import zlib

import numpy as np
import pytest

from oracle import DATA
from stratalake.llm import packing

ODD = ["", " ", "It's we'll DON'T they'd", "a1b2 3.14 x_y", "Éternité ÀÇ œuvre ǆ", "é ño", "İstanbul ΣΑΣ ος", "日本語 テスト", "😀👍🏽 ok",
       "<|startoftext|> and <|endoftext|>s", "a b c\x1cd \x85 e", "...!!! (x) \"q\" </w>", "ﬁ ﬂ ½ ² Ⅷ", "́ alone", "x" * 3000]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_are_the_librarys(spark, library, make_docs):
    path = f"{DATA}/sf0.001/documents.parquet"
    docs = spark.read.parquet(path) if os.path.isfile(path) else make_docs([])
    rows = [*((r.doc_id, r.text) for r in docs.collect()), *((-i - 1, t) for i, t in enumerate(ODD)), (None, None)]
    cut = packing.pieces(make_docs(rows), capacity=512, with_ids=True).collect()
    got = {}
    for p in sorted(cut, key=lambda p: p.piece):
        assert p.start == len(got.setdefault(p.doc_id, [])) and p.piece * 512 == p.start and p.length == len(p.ids)
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        got[p.doc_id] += p.ids
    assert got == {d: ids_of(library, t) for d, t in rows}


def test_slices_and_forgotten_words_change_nothing(library, monkeypatch):
    with open(packing.default_tokenizer(), encoding="utf-8") as file:
        words = packing._Words(file.read())
    text = " ".join(ODD) * 3
    monkeypatch.setattr(packing, "_SLICE", 11)
    monkeypatch.setattr(packing, "_WORDS", 5)
    raw = b"".join(packing.token_ids(text.encode(), words))
    assert np.frombuffer(raw, "<u4").tolist() == ids_of(library, text)[:-1]


@pytest.mark.parametrize("capacity", [1, 7, 20])
def test_every_step_has_the_smallest_sum_of_squares(capacity):
    rng = random.Random(capacity)
    lengths = np.array([rng.randint(1, capacity) for _ in range(300)])
    sequence, offset = packing.place(lengths, capacity)
    filled = {}

    def squares(f):
        gaps = [capacity - v for v in f.values() if v < capacity]
        return sum(gaps.count(g) ** 2 for g in set(gaps))

    for s, home, at in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        sums = [squares({**filled, b: v + s}) for b, v in filled.items() if v + s <= capacity] or [squares({**filled, -1: s})]
        assert at == filled.get(home, 0) and at + s <= capacity
        filled[home] = at + s
        assert squares(filled) == min(sums)


def test_packing_is_whole_and_tight(spark):
    rng = random.Random(4)
    lengths = [min(2048, int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(4000)]
    cut = spark.createDataFrame([(i * 3, i, n) for i, n in enumerate(lengths)], "uid long, doc_id long, length long")
    for bucket in (2, 100, 100_000):
        rows = packing.pack(cut, bucket=bucket).collect()
        assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(lengths))
        held = {}
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == held.get(r.sequence_id, 0)
            held[r.sequence_id] = r.offset + r.length
        assert max(held.values()) <= 2048
        assert len(held) <= sum(lengths) / 2048 * {2: 2, 100: 1.03, 100_000: 1.005}[bucket] + 1


def test_sequences(spark, library, make_docs):
    rows = [(i, f"some words {i} " * (i % 50)) for i in range(120)]
    cut = packing.pieces(make_docs(rows), capacity=64, with_ids=True)
    packed = packing.pack(cut, capacity=64, bucket=50)
    built = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert built[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert sum(map(len, built.values())) == sum(len(ids_of(library, t)) for _, t in rows)


def test_repeated_odd_and_empty(spark, odd_docs, make_docs):
    packed = packing.pack(packing.pieces(odd_docs))
    assert packed.select("doc_id").distinct().count() == 9 and packed.where("sequence_id IS NULL OR offset IS NULL").count() == 0
    same = packing.pack(packing.pieces(make_docs([(1, "same words here")] * 500)))
    assert same.count() == 500 and same.select("sequence_id", "offset").distinct().count() == 500
    assert packing.pack(packing.pieces(make_docs([]))).count() == 0

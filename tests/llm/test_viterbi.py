import os
import random

import numpy as np
import pytest
import sentencepiece

from oracle import DATA
from stratalake.llm import viterbi

pytestmark = pytest.mark.skipif(not os.path.exists(viterbi.MODEL), reason="vocabulary file not present")
ODD = ["", " ", "  ", "a", " a ", "▁", "▁▁ ▁x", "\n", "\n\n x\n", "tab\tand\x00", "日本語 テスト", "😀é́", "a  b   c" + " " * 40 + "d", "x" * 300, "https://a.b/c?d=e&f", "internationalization's"]


@pytest.fixture(scope="module")
def merged():
    return viterbi.Pieces.load()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=viterbi.MODEL)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    syllables = "the ing er an ion qu el é ß 9 . , ' - \n __ Th AB".split(" ")
    out = ["".join(rng.choice(syllables) + (" " if rng.random() < 0.3 else "") for _ in range(rng.randint(1, 120))) for _ in range(300)]
    return ODD + out + ["The quick brown fox jumps over the lazy dog. " * 5]


def test_ids_are_those_of_the_library(merged, library, texts):
    """All but a space mark in the text itself, which the library cannot tell from a space."""
    for text, ids in zip(texts, viterbi.Encoder(merged).encode(texts)):
        if viterbi.SPACE not in text:
            assert ids.tolist() == library.encode(text), text


def test_decoding_restores_every_text(merged, texts):
    for text, ids in zip(texts, viterbi.Encoder(merged).encode(texts)):
        assert viterbi.decode_ids(ids.tolist(), merged.spelled) == text


def test_forgetting_words_changes_nothing(merged, texts, monkeypatch):
    want = [x.tolist() for x in viterbi.Encoder(merged).encode(texts)]
    monkeypatch.setattr(viterbi, "_STEP", 20)
    monkeypatch.setattr(viterbi, "_CACHE", 5)
    small = viterbi.Encoder(merged)
    assert [x.tolist() for x in small.encode(texts)] == want


def test_unigram_paths_are_the_best(texts):
    """Brute force over all cuts of short words, with the file's scores read as those of a unigram model."""
    pieces = viterbi.Pieces.load(kind="unigram")
    encoder = viterbi.Encoder(pieces)
    unknown = pieces.scores.min() - viterbi.UNKNOWN_PENALTY
    for word in sorted({w for t in texts for w in viterbi._WORD.findall(" " + t) if len(w) <= 12})[:400]:
        marked = word.replace(viterbi.SPACE, "\x02").replace(" ", viterbi.SPACE)
        best = [0.0] + [-np.inf] * len(marked)
        for end in range(1, len(marked) + 1):
            for start in range(end):
                part = marked[start:end]
                score = pieces.scores[pieces.named[part]] if part in pieces.named else unknown if end - start == 1 else -np.inf
                best[end] = max(best[end], best[start] + score)
        ids = np.frombuffer(encoder.best_paths([word])[0], np.int32).tolist()
        assert b"".join(pieces.spelled[i] for i in ids).decode() == word
        total, at = 0.0, 0
        bytes_ = set(pieces.byte_ids)
        while at < len(ids):
            if ids[at] in bytes_:
                first = pieces.spelled[ids[at]][0]
                total += unknown
                at += 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            else:
                total += pieces.scores[ids[at]]
                at += 1
        assert np.isclose(total, best[-1]), word


def test_table(spark, odd_docs, make_docs):
    rows = viterbi.encoded_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.restored for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
    assert viterbi.encoded_documents(make_docs([])).count() == 0
    coded = viterbi.encode(odd_docs.drop("ids"))
    assert coded.columns == [*[c for c in odd_docs.columns if c != "ids"], "ids"]


def test_wrong_kind():
    with pytest.raises(ValueError):
        viterbi.Pieces.load(kind="words")

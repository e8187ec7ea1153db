import hashlib

import numpy as np
import pytest

from stratalake.llm import order_minhash as omh


def plain_signature(text, k=omh.K, length=omh.LENGTH, sketches=omh.SKETCHES):
    """The definition with dictionaries and sorted lists; hashes come from the operator."""
    if not text:
        return [0] * sketches
    width = min(k, len(text))
    seen, items = {}, []
    base = omh._windows(np.array([ord(c) for c in text], np.uint64), width)
    for i in range(len(text) - width + 1):
        kmer = text[i : i + width]
        seen[kmer] = seen.get(kmer, -1) + 1
        h = np.array([((int(base[i]) + width) * int(omh._SPREAD) % (1 << 64)) >> 24], np.uint64)
        items.append((int(omh._mix(h + np.uint64(seen[kmer] * int(omh._OCCURRENCE) % (1 << 64)))[0]), i))
    shift = 64 - (sketches.bit_length() - 1)
    fold = lambda chosen: omh._fold(np.array([[h for h, _ in sorted(chosen, key=lambda x: x[1])]], np.uint64))
    bins = [sorted(x for x in items if x[0] >> shift == b)[:length] for b in range(sketches)]
    full = [len(b) == length for b in bins]
    out = []
    for b in range(sketches):
        if not any(full):
            value = omh._mix(fold(sorted(items)[:length]) + np.uint64(b))
        elif full[b]:
            value = fold(bins[b])
        else:
            away = next(a for a in range(1, sketches) if full[(b + a) % sketches])
            value = omh._mix(fold(bins[(b + away) % sketches]) + np.array([away * int(omh._BASE) % (1 << 64)], np.uint64))
        out.append(int(value[0]) >> 32)
    return out


@pytest.mark.parametrize("text", ["", "a", "ab", "short text", "ababababababababab" * 3, "é😀" * 40, " ".join(f"word{i}" for i in range(60)), " ".join(f"w{i % 7}x{i % 11}" for i in range(700))])
def test_signature_is_the_definition(text):
    assert omh.signature(text).tolist() == plain_signature(text)


def test_order_and_edits_matter():
    words = [f"token{i}" for i in range(400)]
    text, moved = " ".join(words), " ".join(words[200:] + words[:200])
    a, b = omh.signature(text), omh.signature(moved)
    assert omh.likeness(a, a) == 1.0
    near = omh.likeness(a, omh.signature(" ".join(words[:390] + ["other"] * 10)))
    assert near > 0.7
    assert omh.likeness(a, b) < near  # the same words in another order
    assert omh.likeness(a, omh.signature("")) == 0.0 and omh.likeness(omh.signature(""), omh.signature("")) == 1.0


@pytest.mark.parametrize("bucket_rows", [1, 3, 1000])
def test_pairs(make_docs, bucket_rows):
    rows = [(i * 37 % 101, f"text number {i} " * (i % 9)) for i in range(60)] + [(200, None), (-5, "")]
    got = {r.doc_id: r for r in omh.edited_pairs(make_docs(rows), bucket_rows=bucket_rows).collect()}
    ordered = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for (doc_id, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        row = got[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == omh.as_text(omh.signature(text)) and row.edited_fingerprint == omh.as_text(omh.signature(edited))
        assert row.near_edited == omh.likeness(omh.signature(text), omh.signature(edited))
        assert row.near_next == omh.likeness(omh.signature(text), omh.signature(following))


def test_odd_rows(odd_docs, make_docs):
    rows = omh.edited_pairs(odd_docs, bucket_rows=2).collect()
    assert len(rows) == odd_docs.count()
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[2] == prints[3] and prints[4] == prints[5] and None in prints
    assert omh.edited_pairs(make_docs([])).count() == 0
    alone = omh.edited_pairs(make_docs([(1, "abcdef")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and alone.near_next == 1.0

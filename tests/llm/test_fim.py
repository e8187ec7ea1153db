import hashlib
import re

import pytest

from stratalake.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = ["", " ", "a", "  a b\t\tc  ", "é😀 ünï ő\n\n", "one two three", "\x0b\x0c", "x" * 50 + " " + "ü" * 50, "a b   c", "w " * 40]


def plain(doc_id, text, rate=50, spm_rate=80):
    """The definition in one pass over strings."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1 << 16])
@pytest.mark.parametrize("text", TEXTS)
def test_cuts_of_frames(text, size):
    frames = fim.Frames.of(text.encode(), size)
    units = UNIT.findall(text)
    assert b"".join(frames.frame(i) for i in range(len(frames.frames))) == text.encode()
    assert (int(frames.units[-1]) if frames.frames else 0) == len(units)
    for k in range(len(units) + 1):
        at, stop, chars = frames.cut(k)
        head = b"".join(frames.frame(i) for i in range(at)) + (frames.frame(at)[:stop] if stop else b"")
        assert head.decode() == "".join(units[:k]) and chars == len("".join(units[:k]))


@pytest.mark.parametrize("size", [5, 1 << 16])
@pytest.mark.parametrize("rate, spm_rate", [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_outputs_and_restored_texts(spark, make_docs, size, rate, spm_rate):
    texts = [*TEXTS, None, "has <P> in it", "ends in <", "S> x <M", "long text " * 3000]
    rows = [(i * 7 + j, t) for i, t in enumerate(texts) for j in range(3)] + [(None, "no id at all"), (1, "twice"), (1, "twice")]
    arranged = fim.arrange(fim.store(make_docs(rows), size), rate=rate, spm_rate=spm_rate)
    got = sorted(map(str, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in fim.texts(arranged).collect())))
    assert got == sorted(str((d, *plain(d, t, rate, spm_rate))) for d, t in rows)
    back = sorted(fim.restored(list(r.output), r.form) for r in arranged.collect())
    assert back == sorted(t or "" for _, t in rows)
    wanted = sorted((hashlib.sha256(plain(d, t, rate, spm_rate)[-1].encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)
    assert sorted((r.output_sha256, r.restored_sha256) for r in fim.digests(arranged).collect()) == wanted


def test_whole_frames_move_as_they_are():
    text = ("word " * 50_000).encode()
    frames = fim.Frames.of(text, 4096)
    span = frames.span(frames.cut(10), frames.cut(49_000))
    assert sum(f in set(frames.frames) for f in span) == len(span) - 2


def test_odd_and_empty(spark, odd_docs, make_docs):
    found = fim.digests(fim.arrange(fim.store(odd_docs)))
    assert found.count() == odd_docs.count()
    assert fim.digests(fim.arrange(fim.store(make_docs([])))).count() == 0

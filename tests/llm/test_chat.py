import hashlib

import pytest

from stratalake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, window int, piece string, c string, loss string"


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "x", "x") for r in rows], SCHEMA)


def plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        lines = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(lines.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.fixture
def rows():
    odd = ["</s>[INST] ok [/INST]", "<|assistant|>", "<|/|>", "<.", "<..[.[", "|>", "", None, "é😀\n", "<" * 9, "[|.]|"]
    out = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(odd)]
    out += [(2, 0, "system", "be kind " * 10)] + [(2, i, "assistant" if i % 2 == 0 else "user", f"turn {i} " * (i * 7 % 40)) for i in range(1, 60)]
    out += [(3, i, "assistant", "very long " * 400) for i in range(3)] + [(4, 0, "system", "s" * 9000), (4, 1, "user", "q"), (4, 2, "assistant", "a")]
    out += [(5, 0, "user", "only")] * 3 + [(None, None, None, None), (None, 1, "tool|>", "x"), (6, 3, "assistant", "late"), (6, None, "system", "first")]
    return out + [(7, i, "user" if i % 2 else "assistant", "short") for i in range(700)]


@pytest.mark.parametrize("budget, history", [(512, 64), (60, 20), (64, 0), (10_000, 100)])
def test_windows_hold_every_turn_and_target_once(spark, rows, budget, history):
    windows = chat.windows(make(spark, rows), budget, history).cache()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(windows).collect()}
    assert got == plain(rows)
    by = {}
    for w in windows.collect():
        by.setdefault(w.conv_id, []).append(w)
        pieces = w.formatted.split("<|/|>")[:-1]
        assert "".join(p + "<|/|>" for p in pieces) == w.formatted
        tokens = [-(-len(p + "<|/|>") // 4) for p in pieces]
        assert w.tokens == sum(tokens)
        systems = sum(p.startswith("<|system|>") for p in pieces)
        if w.conv_id == 2:
            assert systems == 1
        own = pieces[w.context :]
        assert w.tokens <= budget or len(own) == 1 or tokens[0] > budget - history - 4
        repeated = sum(tokens[systems if w.window else 0 : w.context]) if w.window else 0
        assert repeated <= history
        assert [w.formatted[s.start : s.start + s.length] for s in w.loss] == [p.split("|>", 1)[1] for p in own if p.startswith("<|assistant|>")]
    if budget == 512:
        assert len(by[2]) > 1 and any(w.context > 1 for w in by[2])


def test_empty(spark):
    assert chat.digests(chat.windows(make(spark, []))).count() == 0

"""Sum-of-squares packing of tokenized documents into sequences.

Of the open sequences that have room for it, a document goes to the one after which the sum of squares of N(g) is
smallest, N(g) being the number of open sequences with g places left. It opens a new one only if none has room,
and long documents come first, which leaves fewer sequences than the rule on arrival order (about two in a thousand
above the number of tokens divided by the capacity, against four in a hundred, for 4,000 pieces like those given).

Pieces are dealt into buckets of about equal number by a hash and each bucket is packed in one task, over numbers
alone. A bucket ends with at most one sequence that is not over half full, since two of them would have met; these
are packed with each other in the next round, until one bucket takes them all. A round has as many rows as the one
before had buckets.
"""

from __future__ import annotations

import string
import struct
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import parts, staged, whole_text

CAPACITY = 2048
BUCKET = 4096
_WORDS = 1_000_000
_SLICE = 1 << 20
_NONE = np.iinfo(np.int64).max
_BLANKS = b" \t\n\v\f\r"
_POINTS = string.punctuation
_BEYOND = "\u0250"  # composed letters below it are their own normal form


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Words(dict):
    """Token ids, as bytes, of words between ASCII white space.

    White space separates words before they are looked up, so a word's ids never depend on its neighbours. Words
    of Latin letters and points at their end go to the model directly, any other word through the whole library call.
    """

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self._library = Tokenizer.from_str(spec)
        self._model = self._library.model
        # byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for code points from 256 on
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        self._bytes = "".join(chr(b if b in printable else next(others)) for b in range(256))
        self._known: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        ids = self._known.get(piece)
        if ids is None:
            spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self._bytes)
            ids = self._known[piece] = _raw([t.id for t in self._model.tokenize(spelled)])
        return ids

    def __missing__(self, word: bytes) -> bytes:
        if len(self) + len(self._known) > _WORDS:
            self.clear()
            self._known.clear()
        text = word.decode("utf-8", "surrogatepass")
        core = text.rstrip(_POINTS)
        tail = text[len(core) :]
        plain = core.isascii()
        lower = core.lower() if plain else "".join(map(str.lower, core))
        if lower.isalpha() and (plain or max(core + lower) < _BEYOND):
            ids = self._piece(lower) + (self._piece(tail) if tail else b"")
        else:
            ids = _raw(self._library.encode(text, add_special_tokens=False).ids)
        self[word] = ids
        return ids


def _raw(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _worker_words(spec: str) -> _Words:
    """The words known to this Python worker: kept from task to task, since a worker runs many."""
    memo = sys.modules.setdefault("_packing_memo", types.ModuleType("_packing_memo")).__dict__
    key = zlib.crc32(spec.encode()), len(spec)
    if memo.get("key") != key:
        memo["words"], memo["key"] = _Words(spec), key
    return memo["words"]


def token_ids(text: bytes, words) -> Iterator[bytes]:
    """The ids of a text in slices, cut at white space so that few words of a long text are objects at a time."""
    at = 0
    while at < len(text):
        stop = min(at + _SLICE, len(text))
        while stop < len(text) and text[stop] not in _BLANKS:
            stop += 1
        yield b"".join(map(words.__getitem__, text[at:stop].split()))
        at = stop


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``uid, doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every row of ``docs``, staged.

    A document is its token ids and the id 0; only those longer than ``capacity`` are cut. ``uid`` numbers the
    pieces of the staged table, so repeated rows are told apart. Null and empty texts are the id 0 alone. Extra
    columns are ignored; an empty table gives no rows.
    """
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())  # bounded by the vocabulary
    types_of = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    if with_ids:
        types_of["ids"] = pa.list_(pa.int32())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _worker_words(spec.value)
        for part in parts(batches):
            rows = {name: [] for name in types_of}
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                ids = b"".join([*token_ids(text, words), bytes(4)])
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at : at + 4 * capacity]
                    rows["doc_id"].append(doc)
                    rows["piece"].append(i)
                    rows["start"].append(at // 4)
                    rows["length"].append(len(piece) // 4)
                    rows["ids_crc32"].append(zlib.crc32(piece))
                    if with_ids:
                        rows["ids"].append(np.frombuffer(piece, "<u4").astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in types_of.items()], names=list(types_of))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    cut_up = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(cut, schema)
    return staged(cut_up.withColumn("uid", F.monotonically_increasing_id()), "pieces")


def place(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and place in it of each length, in the order given, by the sum-of-squares rule.

    Moving a sequence from gap g to g - s changes the sum by 2 (N(g - s) - N(g) + 1), filling one by 1 - 2 N(g).
    Of equal changes the smallest gap wins.
    """
    open_ = np.zeros(capacity + 1, np.int64)
    at_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    count = 0
    for i, s in enumerate(lengths.tolist()):
        gaps = open_[s:capacity]
        change = np.where(gaps > 0, 2 * (open_[: capacity - s] - gaps + 1), _NONE)
        if len(gaps) and gaps[0]:
            change[0] = 1 - 2 * gaps[0]
        best = int(np.argmin(change)) if len(gaps) else 0
        if not len(gaps) or change[best] == _NONE:
            gap, home = capacity, count
            count += 1
        else:
            gap = best + s
            home = at_gap[gap].pop()
            open_[gap] -= 1
        sequence[i], offset[i] = home, capacity - gap
        if gap > s:
            at_gap[gap - s].append(home)
            open_[gap - s] += 1
    return sequence, offset


def _packed(items: DataFrame, buckets: int, round_: int, capacity: int) -> DataFrame:
    """``uid, length, home, at`` of items ``uid, length``: a sequence is named by its first item."""

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "uid"], ascending=[False, True])
        sequence, offset = place(rows["length"].to_numpy(), capacity)
        uid = rows["uid"].to_numpy()
        first = np.zeros(int(sequence.max()) + 1, np.int64)
        first[sequence[offset == 0]] = uid[offset == 0]
        return pd.DataFrame({"uid": uid, "length": rows["length"].to_numpy(), "home": first[sequence], "at": offset})

    dealt = items.select("uid", "length", F.pmod(F.xxhash64(F.lit(round_), "uid"), F.lit(buckets)).alias("bucket"))
    return staged(dealt.groupBy("bucket").applyInPandas(fill, "uid long, length long, home long, at long"), "placed")


def pack(cut: DataFrame, capacity: int = CAPACITY, bucket: int = BUCKET) -> DataFrame:
    """``cut`` (staged pieces with ``uid, length``) with ``sequence_id`` and ``offset``.

    Sequences hold at most ``capacity`` tokens and no gaps between pieces. A bucket holds about ``bucket`` pieces;
    pieces of full length are sequences of their own and need none. Equal lengths go by ``uid``.
    """
    if bucket < 2:
        raise ValueError("a bucket must hold two pieces at least")
    items = cut.where(F.col("length") < capacity).select("uid", "length")
    homes, round_ = None, 0
    while True:
        buckets = max(1, -(-items.count() // bucket))
        placed = _packed(items, buckets, round_, capacity)
        if homes is None:
            homes = placed.select("uid", "home", "at")
        else:
            moved = placed.select(F.col("uid").alias("home"), F.col("home").alias("_to"), F.col("at").alias("_by"))
            homes = homes.join(moved, "home", "left").select(
                "uid", F.coalesce("_to", "home").alias("home"), (F.col("at") + F.coalesce("_by", F.lit(0))).alias("at")
            )
        if buckets == 1:
            break
        filled = placed.groupBy("home").agg(F.sum("length").alias("length"))
        items = staged(filled.where(F.col("length") <= capacity // 2).select(F.col("home").alias("uid"), "length"), "open")
        round_ += 1
    joined = cut.join(homes, "uid", "left")
    return joined.withColumns({"sequence_id": F.coalesce("home", "uid"), "offset": F.coalesce("at", F.lit(0).cast("long"))}).drop("home", "at", "uid")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of packed pieces with their ids: a group has at most a sequence's tokens."""
    held = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(held, lambda p: p["ids"])).alias("ids"))

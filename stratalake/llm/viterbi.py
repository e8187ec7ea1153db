"""SentencePiece encoding and decoding: best paths over the pieces of a model file, in numpy batches.

A text is a sequence of words, each with the spaces before it; no piece reaches over a word's end, so words
are encoded on their own and each distinct word of a batch once. Words of equal length advance together: hashes
of all substrings probe the sorted keys of the pieces, and column by column the best of all pieces that end there
stores its length as back-pointer. Characters that no piece covers become byte pieces.

For a unigram file the score of a path is the sum of its pieces' scores. For a byte-pair file a path must be the one
that merging leaves: a step scores minus infinity if merging would join the two pieces, or parts of them, over their
border. Whether it would is found by undoing the merges of both pieces, the latest first. Exactly one path stays, so
its ids are those of the public library.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from stratalake.llm.common import unused, whole_text

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
KIND = "bpe"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the public library: an uncovered character costs the least score less 10
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_TOP = np.uint64(44)
_ESCAPED = 0x110001  # stands for a space mark that the text itself holds
_WORD = re.compile(r"\n| *[^ \n]+| +")
_STEP = 300_000
_CACHE = 200_000
_ROWS = 512
_PAIRS = 1 << 20
_NEVER = np.int64(1 << 40)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _prefix(points: np.ndarray) -> np.ndarray:
    """Hashes of all beginnings of each row; the hash of a substring is a difference of two of them."""
    out = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    np.cumsum((points + np.uint64(1)) * _powers(_BASE, points.shape[1]), axis=1, out=out[:, 1:])
    return out


@dataclass
class Pieces:
    """Sorted keys with ids; per id score, length, hash, bytes, and for byte pairs when and from what it is merged."""

    kind: str
    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    sizes: np.ndarray
    hashes: np.ndarray
    longest: int
    byte_ids: list[int]
    spelled: list[bytes]
    named: dict[str, int]
    present: np.ndarray
    formed: np.ndarray = field(default=None)
    left: np.ndarray = field(default=None)
    right: np.ndarray = field(default=None)
    usable: np.ndarray = field(default=None)

    @staticmethod
    def load(path: str = MODEL, kind: str = KIND) -> Pieces:
        """Read the model file on the driver; the table is bounded by the vocabulary and goes with the tasks."""
        if kind not in ("bpe", "unigram"):
            raise ValueError("kind must be bpe or unigram")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        spelled, byte_ids, named = [b""] * size, [-1] * 256, {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
                spelled[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if SPACE in piece.lstrip(SPACE) or "\n" in piece:
                    raise ValueError(f"piece {piece!r} reaches over the end of a word")
                spelled[i] = piece.replace(SPACE, " ").encode()
                named[piece] = i
        if min(byte_ids) < 0:
            raise ValueError("the model has no byte pieces, so not every text can be decoded")
        scores, sizes, hashes = np.zeros(size), np.zeros(size, np.int64), np.zeros(size, np.uint64)
        for piece, i in named.items():
            scores[i], sizes[i] = model.get_score(i), len(piece)
            hashes[i] = _prefix(np.array([[ord(c) for c in piece]], np.uint64))[0, -1]
        ids = np.array(sorted(named.values()), np.int32)
        keys = hashes[ids] + sizes[ids].astype(np.uint64) * _LENGTH
        order = np.argsort(keys)
        keys, ids = keys[order], ids[order]
        if (keys[1:] == keys[:-1]).any():
            raise ValueError("two pieces have one key")
        present = np.zeros(1 << 20, bool)
        present[(keys >> _TOP).astype(np.int32)] = True
        out = Pieces(kind, keys, ids, scores, sizes, hashes, int(sizes.max()), byte_ids, spelled, named, present)
        if kind == "bpe":
            out._trace()
        return out

    def _trace(self) -> None:
        """When each piece is merged (0: a single character), and its two parts; pieces that merging never makes."""
        n = len(self.scores)
        several = sorted((i for p, i in self.named.items() if len(p) > 1), key=lambda i: -self.scores[i])
        self.formed, self.usable = np.zeros(n, np.int64), np.zeros(n, bool)
        self.left, self.right = np.arange(n, dtype=np.int32), np.arange(n, dtype=np.int32)
        self.formed[several] = np.arange(1, len(several) + 1)
        for piece, i in self.named.items():
            if len(piece) == 1:
                self.usable[i] = True
            else:
                last: list[str] = []
                if len(self.merge(piece, last)) == 1:
                    self.usable[i] = True
                    self.left[i], self.right[i] = self.named.get(last[0], -1), self.named.get(last[1], -1)
        if (self.left[self.usable] < 0).any() or (self.right[self.usable] < 0).any():
            raise ValueError("a piece is merged from characters that are no pieces")

    def merge(self, word: str, last: list[str] | None = None) -> list[str]:
        """Byte-pair merges of one word, best score first and leftmost among equals; ``last`` gets the last two parts."""
        parts: list[str | None] = list(word)
        before, after = list(range(-1, len(word) - 1)), list(range(1, len(word) + 1))
        todo: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(parts):
                found = self.named.get(parts[a] + parts[b])
                if found is not None:
                    heapq.heappush(todo, (-self.scores[found], a, b, parts[a] + parts[b]))

        for a in range(len(word) - 1):
            offer(a, a + 1)
        while todo:
            _, a, b, joined = heapq.heappop(todo)
            if parts[a] is None or parts[b] is None or after[a] != b or parts[a] + parts[b] != joined:
                continue
            if last is not None:
                last[:] = [parts[a], parts[b]]
            parts[a], parts[b], after[a] = joined, None, after[b]
            if after[b] < len(parts):
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [p for p in parts if p is not None]

    def spell(self, text: str) -> list[int]:
        return [self.byte_ids[b] for b in text.encode("utf-8", "surrogatepass")]

    def find(self, hashes: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        """Id of the piece with each hash and length, -1 where there is none."""
        probes = hashes + np.asarray(sizes, np.uint64) * _LENGTH
        out = np.full(probes.shape, -1, np.int32)
        maybe = np.nonzero(self.present[(probes >> _TOP).astype(np.int32)])  # spares most searches
        few = probes[maybe]
        at = np.minimum(np.searchsorted(self.keys, few), len(self.keys) - 1)
        out[maybe] = np.where(self.keys[at] == few, self.ids[at], -1)
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves the border between the pieces ``a`` and ``b`` standing."""
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), _NEVER)
        out = np.zeros(len(a), bool)
        live = np.arange(len(a))
        powers = _powers(_BASE, self.longest + 1)
        while len(live):
            x, y = a[live], b[live]
            size = self.sizes[x] + self.sizes[y]
            joined = self.find(self.hashes[x] + self.hashes[y] * powers[self.sizes[x]], size)
            when = np.where(joined >= 0, self.formed[joined], _NEVER)
            fx, fy = self.formed[x], self.formed[y]
            whole = when >= limit[live]
            done = whole & (fx == 0) & (fy == 0)
            out[live[done]] = True
            undo_x = fx > fy
            limit[live] = np.where(undo_x, fx, fy + 1)
            a[live] = np.where(undo_x, self.right[x], x)
            b[live] = np.where(undo_x, y, self.left[y])
            live = live[whole & ~done]
        return out


def _points(words: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64).reshape(len(words), -1)
    raw[raw == ord(SPACE)] = _ESCAPED
    raw[raw == ord(" ")] = ord(SPACE)
    return raw


class Encoder:
    """Encodes texts; remembers a bounded number of words and of pairs of pieces."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pair_keys = np.full(_PAIRS, -1, np.int64)
        self.pair_apart = np.zeros(_PAIRS, bool)

    def encode(self, texts) -> Iterator[np.ndarray]:
        """Ids of each text, about ``_STEP`` words at a time; an empty text has none."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            words = _WORD.findall(" " + text) if text else []
            held.append(words)
            size += len(words)
            if size >= _STEP:
                yield from self._encode(held)
                held, size = [], 0
        yield from self._encode(held)

    def _encode(self, held: list[list[str]]) -> Iterator[np.ndarray]:
        if len(self.known) > _CACHE:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        by_size: dict[int, list[str]] = {}
        for word in {w for words in held for w in words if w not in known}:
            if word in older:
                known[word] = older[word]
            elif self.pieces.kind == "bpe" and word.startswith("  "):
                known[word] = self._spaces(word)  # pieces of several spaces have equal scores: the leftmost comes first
            else:
                by_size.setdefault(len(word), []).append(word)
        for size, words in by_size.items():
            most = max(1, (1 << 18) // size)
            for at in range(0, len(words), most):
                part = words[at : at + most]
                known.update(zip(part, self.best_paths(part)))
        for words in held:
            yield np.frombuffer(b"".join([known[w] for w in words]), np.int32)

    def _spaces(self, word: str) -> bytes:
        named, spell = self.pieces.named, self.pieces.spell
        marked = word.replace(SPACE, chr(0xFFFFF)).replace(" ", SPACE)  # no piece holds that character
        parts = self.pieces.merge(marked)
        ids = [i for p in parts for i in ([named[p]] if p in named else spell(p.replace(chr(0xFFFFF), SPACE)))]
        return np.array(ids, np.int32).tobytes()

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        slot = ((key.astype(np.uint64) * _BASE) >> _TOP).astype(np.int64)
        out = self.pair_apart[slot]
        new = np.flatnonzero(self.pair_keys[slot] != key)
        if len(new):
            pairs, back = np.unique(key[new], return_inverse=True)
            found = self.pieces.apart((pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32))
            out[new] = found[back]
            at = ((pairs.astype(np.uint64) * _BASE) >> _TOP).astype(np.int64)
            self.pair_keys[at], self.pair_apart[at] = -1, False
            keep = np.unique(at, return_index=True)[1]  # of several pairs for one slot, one
            self.pair_keys[at[keep]], self.pair_apart[at[keep]] = pairs[keep], found[keep]
        return out

    def best_paths(self, words: list[str]) -> list[bytes]:
        """Ids of the best path through each of several words of one length; among equals the longer last piece."""
        pieces, merged = self.pieces, self.pieces.kind == "bpe"
        points = _points(words)
        n, size = points.shape
        begun, back = _prefix(points), _powers(_INVERSE, size)
        steps_in: list[tuple[np.ndarray, ...]] = []
        for k in range(1, min(size, pieces.longest) + 1):
            ids = pieces.find((begun[:, k:] - begun[:, :-k]) * back[: size - k + 1], k)
            word, start = np.nonzero(ids >= 0 if not merged else (ids >= 0) & pieces.usable[ids])
            steps_in.append((start + k, word, np.full(len(word), k), ids[word, start]))
        ends, word, length, piece = (np.concatenate(x) for x in zip(*steps_in))
        order = np.argsort(ends, kind="stable")
        borders = np.searchsorted(ends[order], np.arange(1, size + 2))
        unknown = pieces.scores.min() - UNKNOWN_PENALTY
        best, last, step = np.zeros((size + 1, n)), np.full((size + 1, n), -1, np.int32), np.ones((size + 1, n), np.int32)
        for end in range(1, size + 1):
            column = order[borders[end - 1] : borders[end]]
            w, k, found = word[column], length[column], piece[column]
            before = last[end - k, w]
            if merged:
                keep = before < 0
                pairs = np.flatnonzero(~keep)
                keep[pairs] = self._apart(before[pairs], found[pairs])
                w, k, found = w[keep], k[keep], found[keep]
            else:
                best[end] = best[end - 1] + unknown  # an uncovered character stands alone
                single = w[k == 1]
                best[end, single] = -np.inf
                scores = best[end - k, w] + pieces.scores[found]
                rise = np.lexsort((k, scores))  # the best of each word is written last
                w, k, found, scores = w[rise], k[rise], found[rise], scores[rise]
                better = scores > best[end, w]
                w, k, found, scores = w[better], k[better], found[better], scores[better]
                best[end, w] = scores
            last[end, w], step[end, w] = found, k
        return self._traced(words, last, step)

    def _traced(self, words: list[str], last: np.ndarray, step: np.ndarray) -> list[bytes]:
        """Follow the back-pointers of all words at once, from the end; words with byte pieces are spelled out after."""
        n, every = len(words), np.arange(len(words))
        at, columns, spelled = np.full(n, len(step) - 1), [], np.zeros(n, bool)
        count = np.zeros(n, np.int64)
        while at.any():
            live = at > 0
            found = np.where(live, last[at, every], 0)
            spelled |= found < 0
            columns.append(found)
            count += live
            at = np.where(live, at - step[at, every], 0)
        width = len(columns)
        path = np.ascontiguousarray(np.stack(columns[::-1], axis=1), np.int32)  # right-aligned
        flat = path.tobytes()
        out = [flat[(w * width + width - c) * 4 : (w + 1) * width * 4] for w, c in enumerate(count.tolist())]
        for w in np.flatnonzero(spelled).tolist():
            ids, end = [], len(step) - 1
            while end:
                piece = int(last[end, w])
                ids += [piece] if piece >= 0 else reversed(self.pieces.spell(words[w][end - 1]))
                end -= int(step[end, w])
            out[w] = np.array(ids[::-1], np.int32).tobytes()
        return out


def decode_ids(ids, spelled: list[bytes]) -> str:
    """The text of the ids, without the space that encoding put before it."""
    raw = b"".join([spelled[i] for i in ids])
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def _parts(batches: Iterator[pa.RecordBatch], rows: int = _ROWS) -> Iterator[pa.RecordBatch]:
    """Small parts of the batches, so that a worker holds few texts and ids at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *values])))


def encode(docs: DataFrame, path: str = MODEL, kind: str = KIND, text: str = "text", ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) and the piece ids of the whole ``text`` in ``ids`` (replaced if there).

    Null and empty texts have no ids; rows may repeat; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(path, kind))  # bounded by the vocabulary
    carried = docs.select(*[F.col(c) for c in (docs.columns if keep is None else keep) if c.lower() != ids.lower()])
    schema = StructType([*carried.schema.fields, StructField(ids, ArrayType(IntegerType()))])
    names = schema.names

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for part in _parts(batches):
            *columns, texts = part.columns
            yield pa.RecordBatch.from_arrays([*columns, _lists(list(encoder.encode(texts.to_pylist())))], names=names)

    return docs.select(*carried.columns, whole_text(text).alias(unused(carried, "_text"))).mapInArrow(code, schema)


def decode(docs: DataFrame, path: str = MODEL, kind: str = KIND, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with the text of ``ids`` in ``text`` (replaced if there): exactly the text that was encoded."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(path, kind).spelled)

    @F.pandas_udf("string")
    def of(rows: pd.Series) -> pd.Series:
        return pd.Series([decode_ids(row.tolist(), shared.value) for row in rows], dtype=object)

    return docs.withColumn(text, of(F.coalesce(ids, F.array().cast("array<int>"))))


def encoded_documents(docs: DataFrame, path: str = MODEL, kind: str = KIND) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256, restored`` of every row of ``docs`` (``doc_id, text``).

    ``decoded_sha256`` is of the text decoded from the ids again, ``restored`` whether it is the text itself.
    Null and empty texts have no ids. Rows may repeat; extra columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(path, kind))  # bounded by the vocabulary
    names = ["doc_id", "n_tokens", "ids", "decoded_sha256", "restored"]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, spelled = Encoder(shared.value), shared.value.spelled
        for part in _parts(batches):
            texts = part.column(1).to_pylist()
            ids = list(encoder.encode(texts))
            back = [decode_ids(i.tolist(), spelled) for i in ids]
            digests = [hashlib.sha256(b.encode("utf-8", "surrogatepass")).hexdigest() for b in back]
            same = [b == t for b, t in zip(back, texts)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(i) for i in ids], pa.int64()), _lists(ids), pa.array(digests, pa.string()), pa.array(same, pa.bool_())], names=names
            )

    schema = "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string, restored boolean"
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(code, schema)

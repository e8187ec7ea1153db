"""Fill-in-middle over seekable compressed frames.

A text is stored as zstandard frames that decompress on their own, with the number of units and of code points
that end in the frames up to each. A cut after k units needs a search in the cumulative counts and one frame; the
frames between two cuts move into the output as they are. Digests stream the frames in the order of the output,
and the text is rebuilt from the output alone: its marks are searched in the stream, then the three ranges are
read in the order of the text. Work on a text never holds more of it decompressed than a frame and its
neighbours' cut parts, however long the text is.

A unit is a word with the white space before it, or white space at the end of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import parts, staged, whole_text

FRAME_BYTES = 1 << 16
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


class Frames:
    """A text as frames: ``units`` and ``chars`` count what ends in the frames up to each one."""

    def __init__(self, frames: list[bytes], units: list[int], chars: list[int]) -> None:
        self.frames, self.units, self.chars = frames, np.asarray(units, np.int64), np.asarray(chars, np.int64)
        self._open = zstandard.ZstdDecompressor()
        self._pack = zstandard.ZstdCompressor()

    @classmethod
    def of(cls, text: bytes, frame_bytes: int = FRAME_BYTES) -> Frames:
        pack = zstandard.ZstdCompressor()
        frames, units, chars = [], [], []
        start, n, c = 0, 0, 0
        while start < len(text):
            stop = min(start + frame_bytes, len(text))
            while stop < len(text) and text[stop] & 0xC0 == 0x80 and stop - 1 > start:
                stop -= 1
            while stop < len(text) and text[stop] & 0xC0 == 0x80:  # a frame smaller than a code point
                stop += 1
            n += len(_unit_ends(text[start : stop + 1], stop - start, stop == len(text)))
            c += _count_chars(text[start:stop])
            frames.append(pack.compress(text[start:stop]))
            units.append(n)
            chars.append(c)
            start = stop
        return cls(frames, units, chars)

    def frame(self, i: int) -> bytes:
        return self._open.decompress(self.frames[i])

    def cut(self, k: int) -> tuple[int, int, int]:
        """Frame, byte within it and code points before the border after ``k`` units; one frame is decompressed."""
        if k == 0:
            return 0, 0, 0
        at = int(np.searchsorted(self.units, k))
        data, before = self.frame(at), int(self.units[at - 1]) if at else 0
        ends = _unit_ends(data, len(data), at + 1 == len(self.frames))
        stop = int(ends[k - before - 1]) if k - before <= len(ends) else len(data)
        return at, stop, (int(self.chars[at - 1]) if at else 0) + _count_chars(data[:stop])

    def span(self, left: tuple[int, int, int], right: tuple[int, int, int]) -> list[bytes]:
        """Frames of the text between two cuts: whole ones as they are stored, cut ones packed anew."""
        (f, a, _), (g, b, _) = left, right
        if f == g:
            return [self._pack.compress(self.frame(f)[a:b])] if a < b else []
        head = self.frame(f)[a:]
        out = [self._pack.compress(head)] if head else []
        out += self.frames[f + 1 : g]
        return out + ([self._pack.compress(self.frame(g)[:b])] if b else [])

    @property
    def end(self) -> tuple[int, int, int]:
        return len(self.frames), 0, int(self.chars[-1]) if len(self.chars) else 0


def _unit_ends(data: bytes, length: int, last: bool) -> np.ndarray:
    """Byte offsets after each unit that ends in ``data[:length]``; a byte beyond tells whether its last word ends.

    Without that byte a word at the very end counts only in the ``last`` frame of a text.
    """
    blank = _BLANK[np.frombuffer(data, np.uint8)]
    after = np.append(blank[1:length], blank[length] if len(data) > length else last)
    ends = np.flatnonzero(~blank[:length] & after) + 1
    return np.append(ends, length) if last and length and blank[length - 1] else ends


def _count_chars(data: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80))


def store(docs: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """``doc_id, n, marked, frames, units, chars`` of every row of ``docs`` (``doc_id, text``), written once.

    ``n`` is the number of units, ``marked`` whether the text holds one of the marks. Null and empty texts have no
    frames. Rows may repeat; extra columns are ignored; an empty table gives no rows.
    """
    names = ["doc_id", "n", "marked", "frames", "units", "chars"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            packed = [Frames.of(t.encode("utf-8", "surrogatepass"), frame_bytes) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([int(p.units[-1]) if p.frames else 0 for p in packed], pa.int64()),
                    part.column(2),
                    pa.array([p.frames for p in packed], pa.list_(pa.binary())),
                    pa.array([p.units for p in packed], pa.list_(pa.int64())),
                    pa.array([p.chars for p in packed], pa.list_(pa.int64())),
                ],
                names=names,
            )

    text = whole_text()
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    schema = "doc_id long, n long, marked boolean, frames array<binary>, units array<long>, chars array<long>"
    return staged(docs.select(F.col("doc_id").cast("long"), text.alias("text"), marked.alias("marked")).mapInArrow(pack, schema), "frames")


def _draw(i: int, seed: int) -> Column:
    """The i-th 8-digit group of the document's SHA-256, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def arrange(stored: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of stored texts: the output as frames.

    ``rate`` of 100 documents are transformed, ``spm_rate`` of 100 of these with the suffix first. Draws come
    from the id, so rows with the same id (null: an empty one) get the same draws. Empty texts and those that hold
    a mark stay plain; plain rows have null counts. Cuts may leave any of the parts empty.
    """
    cut = [F.pmod(_draw(i, seed), F.col("n") + 1) for i in (0, 1)]
    plain = (F.col("n") == 0) | F.col("marked") | (_draw(2, seed) % 100 >= rate)
    form = F.when(plain, "plain").when(_draw(3, seed) % 100 < spm_rate, "spm").otherwise("psm")
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor()
        p, s, m = ([pack.compress(mark)] for mark in _MARKS)
        for part in parts(batches):
            outputs, before, between = [], [], []
            for shape, a, b, frames, units, chars in zip(*(c.to_pylist() for c in part.columns[2:])):
                if shape == "plain":
                    outputs.append(frames)
                    before.append(None)
                    between.append(None)
                    continue
                text = Frames(frames, units, chars)
                left, right = text.cut(a), text.cut(b)
                prefix, middle, suffix = text.span((0, 0, 0), left), text.span(left, right), text.span(right, text.end)
                outputs.append(s + suffix + p + prefix + m + middle if shape == "spm" else p + prefix + s + suffix + m + middle)
                before.append(left[2])
                between.append(right[2] - left[2])
            counts = [pa.array(x, pa.int64()) for x in (before, between)]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *counts, pa.array(outputs, pa.list_(pa.binary()))], names=names)

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>"
    cuts = [F.least(*cut).alias("a"), F.greatest(*cut).alias("b")]
    return stored.select("doc_id", "n", form.alias("form"), *cuts, "frames", "units", "chars").mapInArrow(cut_up, schema)


def _spread(frames: list[bytes], seen=None) -> tuple[list[int], dict[bytes, int]]:
    """Byte ends of the frames and the first place of each mark, from one pass; ``seen`` gets every frame's bytes."""
    unpack = zstandard.ZstdDecompressor()
    ends, found, end, tail = [], {}, 0, b""
    for frame in frames:
        data = unpack.decompress(frame)
        if seen is not None:
            seen(data)
        window = tail + data
        for mark in _MARKS:
            if mark not in found and (at := window.find(mark)) >= 0:
                found[mark] = end - len(tail) + at
        end += len(data)
        ends.append(end)
        tail = window[-2:]
    return ends, found


def _rebuilt(frames: list[bytes], form: str, ends: list[int], found: dict[bytes, int]) -> Iterator[bytes]:
    """The text's bytes in its own order, read from the output and its form."""
    unpack = zstandard.ZstdDecompressor()
    if form == "plain":
        yield from map(unpack.decompress, frames)
        return
    p, s, m = (found[mark] for mark in _MARKS)
    after_p, after_s = (s, m) if form == "psm" else (m, p)
    for a, b in ((p + 3, after_p), (m + 3, ends[-1]), (s + 3, after_s)):
        i = int(np.searchsorted(ends, a, side="right"))
        while a < b:
            start = ends[i - 1] if i else 0
            yield unpack.decompress(frames[i])[a - start : b - start]
            a = ends[i]
            i += 1


def restored(output: list[bytes], form: str) -> str:
    """The text that ``arrange`` was given, from its output and form alone."""
    return b"".join(_rebuilt(output, form, *_spread(output))).decode("utf-8", "surrogatepass")


def digests(arranged: DataFrame) -> DataFrame:
    """``arranged`` with ``output_sha256`` and ``restored_sha256`` in place of the frames."""

    @F.pandas_udf("output_sha256 string, restored_sha256 string")
    def of(outputs: pd.Series, forms: pd.Series) -> pd.DataFrame:
        rows = []
        for frames, form in zip(outputs, forms):
            frames, whole, text = list(frames), hashlib.sha256(), hashlib.sha256()
            ends, found = _spread(frames, whole.update)
            for data in _rebuilt(frames, form, ends, found):
                text.update(data)
            rows.append((whole.hexdigest(), text.hexdigest()))
        return pd.DataFrame(rows, columns=["output_sha256", "restored_sha256"])

    kept = [c for c in arranged.columns if c != "output"]
    return arranged.select(*kept, of("output", "form").alias("_d")).select(*kept, "_d.output_sha256", "_d.restored_sha256")


def texts(arranged: DataFrame) -> DataFrame:
    """``arranged`` with the output as a string instead of frames."""

    @F.pandas_udf("string")
    def of(outputs: pd.Series) -> pd.Series:
        unpack = zstandard.ZstdDecompressor()
        return pd.Series([b"".join(map(unpack.decompress, frames)).decode("utf-8", "surrogatepass") for frames in outputs], dtype=object)

    return arranged.withColumn("output", of("output"))

"""Order MinHash document fingerprints, sensitive to edits and to the order of the text.

The k-mers of a text are numbered by occurrence, so repeats differ. Each sketch keeps the ``length`` minimal
numbered k-mers of its own hash range, puts them back in text order and hashes that tuple. One pass serves all
sketches: a k-mer's hash names the sketch it competes in (one permutation), and a sketch that gets too few
borrows the tuple of the next one, with the distance mixed in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bucket_of, whole_text

K = 8
LENGTH = 2
SKETCHES = 64
BUCKET_ROWS = 1000
MOST_BUCKETS = 2048
_POSITION_BITS = 24
_BASE = np.uint64(0x9E3779B97F4A7C15)
_OCCURRENCE = np.uint64(0xD6E8FEB86659FD93)
_SPREAD = np.uint64(0xA0761D6478BD642F)
_LOW = np.uint64((1 << _POSITION_BITS) - 1)
_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words; the high bits are the good ones."""
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x


def _windows(points: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every window, put together from windows of 1, 2, 4, ... points."""
    n = len(points) - width + 1
    out, done, span, base, hashes = None, 0, 1, _BASE, points + np.uint64(1)
    while True:
        if width & span:
            part = hashes[done : done + n]
            out = part if out is None else out * base + part
            done += span
        if span * 2 > width:
            return out
        hashes = hashes[:-span] * base + hashes[span:]
        base, span = np.multiply([base], [base])[0], span * 2  # wraps around


def numbered_kmers(text: str, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-mers with their occurrence numbers, and their positions in the text.

    A text shorter than ``k`` is one k-mer, an empty one has none.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(points):
        return points, np.empty(0, np.int64)
    width = min(k, len(points))
    kmer = ((_windows(points, width) + np.uint64(width)) * _SPREAD) >> np.uint64(_POSITION_BITS)
    n = len(kmer)
    if n <= 1 << _POSITION_BITS:
        keys = (kmer << np.uint64(_POSITION_BITS)) | np.arange(n, dtype=np.uint64)
        keys.sort()
        kmer, position = keys >> np.uint64(_POSITION_BITS), (keys & _LOW).astype(np.int64)
    else:
        position = np.argsort(kmer, kind="stable")
        kmer = kmer[position]
    again = np.flatnonzero(kmer[1:] == kmer[:-1]) + 1
    if len(again):
        index = np.arange(n)
        index[again] = 0
        kmer = kmer + (np.arange(n) - np.maximum.accumulate(index)).astype(np.uint64) * _OCCURRENCE
    return _mix(kmer), position


def signature(text: str, k: int = K, length: int = LENGTH, sketches: int = SKETCHES) -> np.ndarray:
    """One 32-bit value per sketch (a power of two many); all zero for an empty text."""
    values, positions = numbered_kmers(text, k)
    if not len(values):
        return np.zeros(sketches, np.uint32)
    shift = np.uint64(64 - (sketches.bit_length() - 1))
    enough = 6 * length * sketches  # only the least hashes of each range matter
    if len(values) > enough * 4 // 3:
        share = np.uint64(int((1 << int(shift)) * (enough / len(values))))
        near = np.flatnonzero((values & ((np.uint64(1) << shift) - np.uint64(1))) < share)
        tuples, full = _tuples(values[near], positions[near], shift, length, sketches)
        if full.all():
            return (tuples >> np.uint64(32)).astype(np.uint32)
    tuples, full = _tuples(values, positions, shift, length, sketches)
    if not full.any():
        order = np.argsort(values)[:length]
        whole = _fold(values[order[np.argsort(positions[order])]][None, :])
        tuples = _mix(whole + np.arange(sketches, dtype=np.uint64))
    elif not full.all():
        owners = np.flatnonzero(full)
        here = np.arange(sketches)
        lender = owners[np.searchsorted(owners, here) % len(owners)]
        away = ((lender - here) % sketches).astype(np.uint64)
        tuples = np.where(full, tuples, _mix(tuples[lender] + away * _BASE))
    return (tuples >> np.uint64(32)).astype(np.uint32)


def _fold(chosen: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of each row of numbered k-mer hashes."""
    out = np.full(len(chosen), _BASE, np.uint64)
    for column in chosen.T:
        out = _mix(out * _OCCURRENCE + column)
    return out


def _tuples(values: np.ndarray, positions: np.ndarray, shift: np.uint64, length: int, sketches: int) -> tuple[np.ndarray, np.ndarray]:
    """Tuple hash of each sketch, and whether it had ``length`` k-mers of its own."""
    order = np.argsort(values)
    values, positions = values[order], positions[order]
    starts = np.searchsorted(values, np.arange(sketches, dtype=np.uint64) << shift)
    full = np.diff(np.append(starts, len(values))) >= length
    rows = starts[full][:, None] + np.arange(length)
    by_place = np.argsort(positions[rows], axis=1)
    out = np.zeros(sketches, np.uint64)
    out[full] = _fold(values[np.take_along_axis(rows, by_place, axis=1)])
    return out, full


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal sketches; an empty text is like an empty text only."""
    if a.any() != b.any():
        return 0.0
    return float(np.mean(a == b))


def as_text(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def edit(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def edited_pairs(docs: DataFrame, k: int = K, length: int = LENGTH, sketches: int = SKETCHES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next text are.

    ``docs`` has ``doc_id, text``; the next document is the one with the next smaller id, after the last
    the first. Null texts are empty. Equal ids go by text, null ids come last, repeated rows follow each
    other. An empty table gives no rows. Texts move once: ids are cut into buckets at sampled quantiles,
    and each bucket also gets the first text of the bucket that follows.
    """
    rows = docs.select("doc_id", whole_text().alias("text"))
    n = rows.count()
    if n == 0:
        return docs.sparkSession.createDataFrame([], _RESULT)
    wanted = max(1, min(MOST_BUCKETS, n // bucket_rows))
    shares = [i / wanted for i in range(1, wanted)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 20 * MOST_BUCKETS).alias("c")).first().c if shares else []
    cuts = sorted({-c for c in cuts or []})
    # buckets follow the descending id; nulls have the last one to themselves
    last = len(cuts) + 1
    bucket = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(bucket_of(-F.col("doc_id"), cuts))
    rows = rows.withColumn("bucket", bucket)
    heads = sorted((r.bucket, r.head) for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect())
    before = {b: heads[i - 1][0] for i, (b, _) in enumerate(heads)}  # of the first: the last
    firsts = rows.where(F.col("doc_id").isin([h for _, h in heads if h is not None]) | F.col("doc_id").isNull())
    firsts = firsts.groupBy("bucket", "doc_id").agg(F.min("text").alias("text"))
    follow = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    borders = firsts.select("doc_id", "text", follow[F.col("bucket")].alias("bucket"), F.lit(1).alias("border"))
    dealt = rows.withColumn("border", F.lit(0)).unionByName(borders).repartition(max(wanted, 1), "bucket")
    ordered = dealt.sortWithinPartitions("bucket", "border", F.desc_nulls_last("doc_id"), "text")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            out = []
            for doc_id, text, where, border in zip(batch["doc_id"].tolist(), batch["text"], batch["bucket"].tolist(), batch["border"].tolist()):
                sig = signature(text, k, length, sketches)
                if held is not None:
                    own_id, own, own_sig, own_where = held
                    if own_where != where:
                        raise RuntimeError(f"bucket {own_where} has no following text")
                    other = edit(own, text)
                    other_sig = signature(other, k, length, sketches)
                    out.append((
                        None if own_id is None else int(own_id), len(own), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(),
                        as_text(own_sig), as_text(other_sig), likeness(own_sig, other_sig), likeness(own_sig, sig),
                    ))
                held = None if border else (doc_id, text, sig, where)
            if out:
                frame = pd.DataFrame(out, columns=[c.split()[0] for c in _RESULT.split(", ")])
                yield frame.astype({"doc_id": pd.Int64Dtype()})

    return ordered.select(F.col("doc_id").cast("string"), "text", "bucket", "border").mapInPandas(compare, _RESULT)

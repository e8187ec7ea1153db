"""Document quality: random-indexing word vectors, pooled per document, and a small calibrated network.

Every token has a fixed sparse index vector; its word vector is the sum of the index vectors around all its
occurrences in all documents. Tokens are hashed into a fixed number of rows, so the vector table has one size
whatever the corpus, and the integer sums do not depend on the order of tasks. A document is the mean and the
spread of its word vectors and the mean product of neighbouring ones. A network with one hidden layer learns from
a bounded sample of labelled rows, and a temperature fitted on rows it did not see calibrates its probability.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import label_sample, whole_text

ROWS = 1 << 14
DIMS = 32
NONZERO = 4
REACH = 2
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
FEATURES = 3 * DIMS + 2
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_STEP = 16_000
_CACHE = 200_000


class TokenRows:
    """Table row of each token, remembered for a bounded number of tokens."""

    def __init__(self, rows: int) -> None:
        self.rows = rows
        self.known: dict[str, int] = {}

    def __missing__(self, token: str) -> int:
        row = zlib.crc32(token.encode("utf-8", "surrogatepass")) % self.rows
        if len(self.known) >= _CACHE:
            self.known.clear()
        self.known[token] = row
        return row

    def of(self, text: str) -> list[int]:
        known, missing = self.known, self.__missing__
        return [known[t] if t in known else missing(t) for t in _TOKEN.findall(text)]


def steps(texts, tokens: TokenRows, most: int = _STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token rows of consecutive texts and the length of each, about ``most`` tokens at a time."""
    rows: list[int] = []
    lengths: list[int] = []
    for text in texts:
        found = tokens.of(text)
        rows += found
        lengths.append(len(found))
        if len(rows) >= most:
            yield np.array(rows, np.uint16), np.array(lengths)
            rows, lengths = [], []
    if lengths:
        yield np.array(rows, np.uint16), np.array(lengths)


def index_vectors(rows: int = ROWS, dims: int = DIMS, nonzero: int = NONZERO, seed: int = 11) -> np.ndarray:
    """Sparse vectors of +1 and -1, and one zero vector for the space between documents."""
    rng = np.random.default_rng(seed)
    out = np.zeros((rows + 1, dims), np.int8)
    where = np.argsort(rng.random((rows, dims)), axis=1)[:, :nonzero]
    out[np.arange(rows)[:, None], where] = rng.choice([-1, 1], (rows, nonzero))
    return out


def add_contexts(table: np.ndarray, index: np.ndarray, rows: np.ndarray, lengths: np.ndarray, reach: int = REACH) -> None:
    """Add the index vectors within ``reach`` of every token to the token's row; documents do not touch."""
    gap = len(index) - 1
    ends = np.cumsum(lengths + reach)
    apart = np.full(int(ends[-1]) + reach, gap, np.int32)
    shifted = np.arange(len(rows)) + np.repeat(np.arange(1, len(lengths) + 1) * reach, lengths)
    apart[shifted] = rows
    context = np.zeros((len(rows), index.shape[1]), np.int8)
    for away in range(1, reach + 1):
        context += index[apart[shifted - away]]
        context += index[apart[shifted + away]]
    order = np.argsort(rows, kind="stable")
    if len(order):
        seen, starts = np.unique(rows[order], return_index=True)
        table[seen] += np.add.reduceat(context[order], starts, axis=0, dtype=np.int64)


def word_vectors(docs: DataFrame, rows: int = ROWS, dims: int = DIMS, reach: int = REACH) -> np.ndarray:
    """Unit word vectors of all documents: one ``rows`` x ``dims`` table, whatever the corpus."""
    text = whole_text().alias("text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, index, tokens = np.zeros((rows, dims), np.int64), index_vectors(rows, dims), TokenRows(rows)
        for batch in batches:
            for found, lengths in steps(batch["text"], tokens):
                add_contexts(table, index, found, lengths, reach)
        used = np.flatnonzero(table.any(axis=1))
        yield pd.DataFrame({"row": used, "v": pd.Series(list(table[used]), dtype=object)})

    parts = docs.select(text).mapInPandas(count, "row long, v array<long>")
    sums = parts.groupBy("row").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(dims)]).alias("v"))
    table = np.zeros((rows, dims), np.float32)
    for r in sums.toLocalIterator():  # at most ``rows`` rows
        table[r.row] = r.v
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)


def pooled(vectors: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Features of each document: mean, spread, mean neighbour product, log length, share of repeats."""
    out = np.zeros((len(lengths), 3 * vectors.shape[1] + 2), np.float32)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    n = lengths[full][:, None]
    starts = np.concatenate(([0], np.cumsum(lengths[full])[:-1]))
    words = vectors[rows]
    mean = np.add.reduceat(words, starts, axis=0, dtype=np.float64) / n
    square = np.add.reduceat(words * words, starts, axis=0, dtype=np.float64) / n
    pair = np.zeros_like(words)
    pair[:-1] = words[:-1] * words[1:]
    last = np.append(starts[1:], len(rows)) - 1
    pair[last] = 0  # no product over the end of a document
    product = np.add.reduceat(pair, starts, axis=0, dtype=np.float64) / n
    same = np.zeros(len(rows), np.float64)
    same[:-1] = rows[:-1] == rows[1:]
    same[last] = 0
    repeats = np.add.reduceat(same, starts)[:, None] / n
    out[full] = np.hstack([mean, np.sqrt(np.maximum(square - mean * mean, 0)), product, np.log1p(n), repeats])
    return out


def _features_of(vectors: Broadcast):
    """Column function from text to features, for vectors that are broadcast: ``ROWS`` x ``DIMS`` floats."""

    @F.pandas_udf("array<float>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = TokenRows(len(vectors.value))
        for texts in batches:
            yield pd.Series([f for rows, lengths in steps(texts, tokens) for f in pooled(vectors.value, rows, lengths)], dtype=object)

    return of


@dataclass
class Network:
    """Standardised features, one hidden layer of tanh units, a logit divided by the temperature."""

    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.center) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60, batch: int = 256, decay: float = 1e-3, seed: int = 5) -> Network:
    """Fit on four fifths of the rows by Adam, keep the best round, and set the temperature on the other fifth.

    Without rows, or with one class only, the score is the smoothed share of label 1 for every document.
    """
    rng = np.random.default_rng(seed)
    prior = (y.sum() + 1.0) / (len(y) + 2.0)
    center = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    scale = np.maximum(x.std(axis=0), 1e-3) if len(x) else np.ones(x.shape[1])
    w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), np.zeros(hidden), np.array(np.log(prior / (1 - prior)))]
    if len(np.unique(y)) < 2:
        return Network(center, scale, w[0], w[1], w[2], float(w[3]))
    w[2] = rng.normal(0, 1 / np.sqrt(hidden), hidden)
    order = rng.permutation(len(y))
    check, fit = order[: len(y) // 5], order[len(y) // 5 :]
    z = (x - center) / scale
    moments, squares, best, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], (np.inf, w), 0
    for _ in range(epochs):
        rng.shuffle(fit)
        for at in range(0, len(fit), batch):
            rows = fit[at : at + batch]
            h = np.tanh(z[rows] @ w[0] + w[1])
            error = (sigmoid(h @ w[2] + w[3]) - y[rows]) / len(rows)
            back = np.outer(error, w[2]) * (1 - h * h)
            grads = [z[rows].T @ back + decay * w[0], back.sum(axis=0), h.T @ error + decay * w[2], error.sum()]
            step += 1
            for i, g in enumerate(grads):
                moments[i] = 0.9 * moments[i] + 0.1 * g
                squares[i] = 0.999 * squares[i] + 0.001 * g * g
                rate = 3e-3 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                w[i] = w[i] - rate * moments[i] / (np.sqrt(squares[i]) + 1e-8)
        if len(check):
            now = _loss(np.tanh(z[check] @ w[0] + w[1]) @ w[2] + w[3], y[check])
            if now < best[0]:
                best = now, list(w)
    w = best[1] if np.isfinite(best[0]) else w
    net = Network(center, scale, w[0], w[1], w[2], float(w[3]))
    if len(check):
        logits = net.logits(x[check])
        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=lambda t: _loss(logits / t, y[check])))
    return net


def held_out(modulus: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """Whether the CRC-32 of the id as text leaves the remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, vectors: Broadcast, train_rows: int = TRAIN_ROWS) -> Network:
    """The network of a bounded sample of the labelled documents."""
    known = label_sample(labels, "quality", ~held_out(5, 0), train_rows)
    taught = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(known), "doc_id")  # train_rows ids at most
    taught = taught.select("doc_id", "label", _features_of(vectors)("text").alias("features")).toPandas()
    taught = taught.sort_values("doc_id").drop_duplicates("doc_id")
    x = np.stack(taught["features"].to_list()).astype(np.float64) if len(taught) else np.zeros((0, FEATURES))
    return train(x, taught["label"].to_numpy(np.float64))


def with_score(docs: DataFrame, labels: DataFrame, alias: str, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` and the probability of label 1 of each text as a further column ``alias``.

    Word vectors come from all texts of ``docs``.
    """
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(docs))
    shared = context.broadcast(fit(docs, labels, vectors, train_rows))

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = TokenRows(len(vectors.value))
        for texts in batches:
            parts = [shared.value.probability(pooled(vectors.value, rows, lengths).astype(np.float64)) for rows, lengths in steps(texts, tokens)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    return docs.withColumn(alias, probability(whole_text()))


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (``doc_id, text``).

    ``labels`` has ``doc_id, quality``; rows with a null in either, and held-out rows, teach nothing; of
    several labels for one id the largest counts. Word vectors come from all texts; the network learns from at
    most ``train_rows`` labelled rows, drawn by a hash of the id. A null or empty text gets the score of zero
    features. Equal texts get equal scores. Extra columns are ignored; an empty table gives no rows.
    """
    scored = with_score(docs.select("doc_id", "text"), labels, "score", train_rows)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

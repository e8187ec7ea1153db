"""Toxicity: a factorization machine over hashed terms.

Terms are the words of a text in lower case and the beginnings of longer words, each counted once and hashed.
The model keeps the terms that tell the labels apart in the labelled sample, alone or together with another term: two
terms that are each common among clean texts stay if their meeting is not. Besides a weight, each has a factor vector,
and the products of factors score pairs of terms that a sum of weights cannot.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import label_sample, shipped, whole_text
from stratalake.llm.quality import held_out, sigmoid

SPACE = 1 << 20
PREFIXES = (4, 5, 6)
TRAIN_ROWS = 12_000
TERMS = 4096
STRENGTH = 4.0
PAIR_STRENGTH = 6.0  # higher than for terms, since there are many more pairs to meet a label by chance
PAIR_SUPPORT = 10
FACTORS = 8
THRESHOLD = 0.7
_WORD = re.compile(r"\w+")
_CACHE = 200_000
_MET = 1024


class Terms:
    """Hashed terms of a word, remembered for a bounded number of words."""

    def __init__(self, keep: dict[int, int] | None = None, space: int = SPACE) -> None:
        self.keep, self.space = keep, space
        self.known: dict[str, tuple[int, ...]] = {}

    def _of_word(self, word: str) -> tuple[int, ...]:
        named = ["w" + word, *[f"{n}" + word[:n] for n in PREFIXES if len(word) > n]]
        hashed = (zlib.crc32(t.encode("utf-8", "surrogatepass")) % self.space for t in named)
        found = tuple(hashed) if self.keep is None else tuple(self.keep[h] for h in hashed if h in self.keep)
        if len(self.known) >= _CACHE:
            self.known.clear()
        self.known[word] = found
        return found

    def of(self, text: str) -> np.ndarray:
        """Sorted distinct terms of the whole text."""
        known, out = self.known, set()
        for word in set(_WORD.findall(text.lower())):
            found = known.get(word)
            out.update(self._of_word(word) if found is None else found)
        return np.array(sorted(out), np.int32)


@dataclass
class Machine:
    """``keep`` maps a hashed term to its row in ``weights`` and ``factors``."""

    keep: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logit(self, rows: np.ndarray) -> float:
        v = self.factors[rows]
        total = v.sum(axis=0)
        return float(self.bias + self.weights[rows].sum() + 0.5 * (total @ total - (v * v).sum()))


def choose(samples: list[np.ndarray], y: np.ndarray, space: int = SPACE, terms: int = TERMS, least: float = STRENGTH) -> np.ndarray:
    """The hashed terms whose presence, alone or in a pair, tells most about the label, in standard deviations.

    One more text is counted: it keeps rare terms out, which meet a label by chance in a sample of so many terms.
    """
    n = np.zeros(space)
    positive = np.zeros(space)
    for rows, label in zip(samples, y):
        n[rows] += 1
        positive[rows] += label
    base = y.mean()
    strength = np.abs(positive - base * n) / np.sqrt(n * base * (1 - base) + 1.0)
    best = np.lexsort((np.arange(space), -strength))[:terms]
    best = best[strength[best] >= least]
    paired = pair_strengths(samples, y, n, positive)
    more = sorted(set(paired) - set(best.tolist()), key=lambda t: (-paired[t], t))
    return np.sort(np.concatenate([best, np.array(more[: terms - len(best)], best.dtype)]))


def pair_strengths(samples: list[np.ndarray], y: np.ndarray, n: np.ndarray, positive: np.ndarray,
                   least: float = PAIR_STRENGTH, support: int = PAIR_SUPPORT) -> dict[int, float]:
    """Terms that meet another one in ``support`` toxic texts or more, far more often than either alone explains.

    Maps each to the strength of its best pair: toxic texts with both, beyond the larger of both terms' own shares. A pair
    of that support has members of that support, so all other terms are left out first. Each pair is counted from its
    rarer term, one vector of counts at a time; clean texts are looked at only where the toxic ones alone would do.
    """
    common = np.flatnonzero(positive >= support)
    common = common[np.argsort(n[common], kind="stable")]
    place = np.full(len(n), -1, np.int32)
    place[common] = np.arange(len(common), dtype=np.int32)
    known = place >= 0
    sizes = np.array([np.count_nonzero(known[s]) for s in samples], np.int64)
    stops = np.cumsum(sizes)
    flat = np.empty(sizes.sum(), np.int32)  # the places of each text, one text after the other, ascending in a text
    for s, stop, size in zip(samples, stops, sizes):
        flat[stop - size : stop] = np.sort(place[s[known[s]]])
    texts = np.repeat(np.arange(len(samples), dtype=np.int32), sizes)
    order = np.argsort(flat, kind="stable").astype(np.int32)
    ends = np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=len(common)))])
    share = (positive[common] + y.mean()) / (n[common] + 1.0)
    best = np.zeros(len(common))
    for a in range(len(common)):
        mine = order[ends[a] : ends[a + 1]]

        def met(which: np.ndarray) -> np.ndarray:
            """How often each term from the one at hand meets it in the given entries, _MET texts at a time."""
            total = np.zeros(len(common) - a, np.int64)
            for at in range(0, len(which), _MET):
                part = which[at : at + _MET]
                later = [flat[e + 1 : stop] for e, stop in zip(part.tolist(), stops[texts[part]].tolist())]
                total += np.bincount(np.concatenate(later) - a, minlength=len(total))
            return total

        bad = met(mine[y[texts[mine]] > 0])
        rate = np.maximum(share[a], share[a:])
        hopeful = (bad >= support) & (bad * (1 - rate) >= least * np.sqrt(bad * rate * (1 - rate) + 1.0))
        if hopeful.any():
            both = bad + met(mine[y[texts[mine]] <= 0])
            strength = np.where(hopeful, (bad - rate * both) / np.sqrt(both * rate * (1 - rate) + 1.0), 0.0)
            strength[strength < least] = 0
            best[a] = max(best[a], strength.max())
            best[a:] = np.maximum(best[a:], strength)
    return {int(common[i]): float(best[i]) for i in np.flatnonzero(best)}


def train(samples: list[np.ndarray], y: np.ndarray, space: int = SPACE, terms: int = TERMS, factors: int = FACTORS,
          least: float = STRENGTH, epochs: int = 25, batch: int = 128, decay: float = 5e-5, seed: int = 3) -> Machine:
    """Fit by Adam on the log loss. One class only, or no rows, gives the smoothed share of label 1."""
    rng = np.random.default_rng(seed)
    prior = (y.sum() + 1.0) / (len(y) + 2.0)
    bias = np.log(prior / (1 - prior))
    if len(np.unique(y)) < 2:
        return Machine({}, float(bias), np.zeros(0), np.zeros((0, factors)))
    chosen = choose(samples, y, space, terms, least)
    place = np.full(space, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    rows = [place[s][place[s] >= 0] for s in samples]
    # column 0 holds the weights, the others the factors
    w = np.hstack([np.zeros((len(chosen), 1)), rng.normal(0, 0.02, (len(chosen), factors))])
    m, s, order, step = np.zeros_like(w), np.zeros_like(w), np.arange(len(y)), 0
    for _ in range(epochs):
        rng.shuffle(order)
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            index = np.concatenate([rows[i] for i in part]) if len(part) else np.zeros(0, np.int32)
            owner = np.repeat(np.arange(len(part)), [len(rows[i]) for i in part])
            totals = np.zeros((len(part), factors + 1))
            np.add.at(totals, owner, w[index])
            squares = np.zeros(len(part))
            np.add.at(squares, owner, (w[index, 1:] ** 2).sum(axis=1))
            z = bias + totals[:, 0] + 0.5 * ((totals[:, 1:] ** 2).sum(axis=1) - squares)
            error = (sigmoid(z) - y[part]) / len(part)
            grad = decay * w
            each = np.empty((len(index), factors + 1))
            each[:, 0] = error[owner]
            each[:, 1:] = error[owner][:, None] * (totals[owner, 1:] - w[index, 1:])
            np.add.at(grad, index, each)
            bias -= 0.05 * error.sum()
            step += 1
            m = 0.9 * m + 0.1 * grad
            s = 0.999 * s + 0.001 * grad * grad
            w = w - 0.02 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * m / (np.sqrt(s) + 1e-8)
    return Machine({int(h): i for i, h in enumerate(chosen)}, float(bias), w[:, 0].copy(), w[:, 1:].copy())


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Machine:
    """The model of a bounded sample of the labelled documents; copies with equal labels teach once."""
    known = label_sample(labels, "toxic", ~held_out(3, 1), train_rows)

    @F.pandas_udf("binary")
    def hashed(texts: pd.Series) -> pd.Series:
        terms = Terms()
        return pd.Series([terms.of(t).tobytes() for t in texts], dtype=object)

    sample = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(known), "doc_id")  # train_rows ids at most
    sample = sample.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # one text of a repeated id
    sample = sample.select("doc_id", "label", hashed("text").alias("terms")).toPandas()
    sample = sample.sort_values("doc_id").drop_duplicates(["terms", "label"])
    return train([np.frombuffer(t, np.int32) for t in sample["terms"]], sample["label"].to_numpy(np.float64))


def with_score(docs: DataFrame, labels: DataFrame, alias: str, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` and the probability of toxicity of each text as a further column ``alias``."""
    shared = shipped(docs.sparkSession, fit(docs, labels, train_rows))

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared()
        terms = Terms(model.keep)
        for texts in batches:
            yield pd.Series(sigmoid(np.array([model.logit(terms.of(t)) for t in texts])), dtype="float64")

    return docs.withColumn(alias, probability(whole_text()))


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (``doc_id, text``).

    ``labels`` has ``doc_id, toxic``; rows with a null in either, and held-out rows, teach nothing; of several
    labels for one id the largest counts. The model learns from at most ``train_rows`` labelled rows, drawn by a
    hash of the id; the smallest text of a repeated id teaches. A null or empty text has no terms and gets the score of the bias alone. Equal texts get equal
    scores. Extra columns are ignored; an empty table gives no rows.
    """
    scored = with_score(docs.select("doc_id", "text"), labels, "score", train_rows)
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

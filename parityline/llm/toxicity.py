"""Toxicity classifier, regularised by counterfactuals.

A logistic model over the words and word stems of a text. For each training text with an identity term,
counterfactuals are made by swapping the term within its sentences for the others of its
kind, and for none at all; the squared change of the logit is penalised. A group that is
named more often in toxic texts therefore gains no weight by that, and neutral mentions
are not held against a text.

The model is fitted on a bounded sample of labelled rows (``sample``) in a stated hash
order, over at most ``VOCABULARY`` words; scoring covers every row and whole texts.

Defined results: a null text counts as empty and gets a score; without labels of both
kinds the score is the share of ones (0.5 without any); repeated labels of a document
count as their largest; null labels and labels without a document are ignored; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityline.llm.common import written
from parityline.llm.quality import sampled_labels

#: Terms that can stand for one another in a sentence, by kind.
IDENTITY = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"),
    ("mexican", "american", "chinese", "indian", "german", "french", "russian", "turkish"),
    ("immigrants", "refugees", "natives", "foreigners", "citizens"),
    ("disabled", "deaf", "blind", "autistic"),
    ("old", "young", "elderly"),
)
#: Words of the model, and the least chi-squared of one against the label.
VOCABULARY, LEAST_CHI = 5_000, 15.0
_KIND = {term: kind for kind in IDENTITY for term in kind}
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def words(text: str | None) -> set[str]:
    """The words of a text, and the stems (first four letters, marked) of longer ones.

    Identity terms have no stem, so that a swap changes one word for another and no more.
    """
    found = set(_WORD.findall((text or "").lower()))
    return found | {w[:4] + "*" for w in found if len(w) > 4 and w not in _KIND}


def counterfactuals(text: str | None) -> list[tuple[set[str], set[str]]]:
    """For each sentence with identity terms, its words and those of each swap."""
    out = []
    for sentence in _SENTENCE.split((text or "").lower()):
        own = set(_WORD.findall(sentence))
        for term in sorted(own & _KIND.keys()):
            rest = own - {term}
            out += [(own, rest | {other}) for other in _KIND[term] if other != term]
            out.append((own, rest))
    return out


class Model:
    """Word weights; the score is the logistic function of their sum over a text's words."""

    def __init__(self, intercept: float, weights: dict[str, float]):
        self.intercept, self.weights = intercept, weights

    def logit(self, found: set[str]) -> float:
        weights = self.weights
        return self.intercept + math.fsum(weights[w] for w in found & weights.keys())

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, self.logit(words(text))))))


def _telling(texts: list[set[str]], y: np.ndarray, vocabulary: int, least: float) -> list[str]:
    """The words with the largest chi-squared against the label, at least ``least``.

    Identity terms are always among them: it is for the penalty to weigh them.
    """
    every, toxic = Counter(w for t in texts for w in t), Counter()
    for t, label in zip(texts, y, strict=True):
        if label > 0:
            toxic.update(t)
    n, ones, found = len(y), y.sum(), []
    for w, k in every.items():
        a, expected = toxic[w], k * ones / n
        chi = (a - expected) ** 2 * (1 / expected + 1 / (k - k * ones / n))
        if chi >= least and k >= 3 or w in _KIND:
            found.append((w not in _KIND, -chi, w))
    return [w for *_, w in sorted(found)[:vocabulary]]


def fit(
    texts: list[set[str]],
    y: np.ndarray,
    swaps: dict[tuple[str, str | None], float],
    penalty: float = 10.0,
    vocabulary: int = VOCABULARY,
    least: float = LEAST_CHI,
) -> Model:
    """Choose the telling words of the texts, and fit their weights: see ``weigh``."""
    if not len(y) or not 0 < y.sum() < len(y):
        return _constant(y)
    kept = _telling(texts, y, vocabulary, least)
    at = {w: i for i, w in enumerate(kept)}
    # Sorted, so that sums, and by that the model, are the same at every run.
    found = [np.sort(np.fromiter((at[w] for w in t if w in at), np.int64)) for t in texts]
    return weigh(kept, found, y, swaps, penalty)


def _constant(y: np.ndarray) -> Model:
    """The share of ones, where there are none of one kind."""
    share = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
    return Model(math.log(share / (1 - share)), {})


def weigh(
    kept: list[str],
    texts: list[np.ndarray],
    y: np.ndarray,
    swaps: dict[tuple[str, str | None], float],
    penalty: float = 10.0,
    l2: float = 0.3,
    steps: int = 300,
) -> Model:
    """Minimise the weighted log loss, a ridge, and the penalty on changes by swaps.

    ``texts`` hold the sorted places of their words in ``kept``. In a linear model over sets
    of words, a swap changes the logit by the difference of two weights; ``swaps`` counts the
    swaps by (term, other or None).
    """
    at = {w: i for i, w in enumerate(kept)}
    rows = np.repeat(np.arange(len(texts)), [len(c) for c in texts])
    cols = np.concatenate(texts) if len(rows) else np.zeros(0, np.int64)
    pairs = [(at.get(a, -1), at.get(b, -1), n) for (a, b), n in swaps.items()]
    pairs = [p for p in pairs if p[0] != p[1]]
    one, two = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    often = np.array([p[2] for p in pairs], float) / max(1, len(texts))

    # Both classes weigh the same; the last weight, always 0, stands for words not kept.
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) * len(y)
    w, bias = np.zeros(len(kept) + 1), 0.0

    one, two = one % len(w), two % len(w)

    def slope(w: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
        z = np.bincount(rows, w[cols], len(y)) + bias
        error = weight * (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y)
        g = np.bincount(cols, error[rows], len(w)) + l2 * w
        change = 2 * penalty * often * len(y) * (w[one] - w[two]) if len(pairs) else np.zeros(0)
        g += np.bincount(one, change, len(w)) - np.bincount(two, change, len(w))
        g[-1] = 0
        return g, float(error.sum())

    # Adam: a step size per weight copes with rare and frequent words alike.
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, steps + 1):
        g, gb = slope(w, bias)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 * (1 - step / (steps + 1))
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        bias -= rate * (mb / (1 - 0.9**step)) / (math.sqrt(vb / (1 - 0.99**step)) + 1e-8)
    return Model(bias, dict(zip(kept, w[:-1].tolist(), strict=True)))


def swap_counts(text: str | None) -> Counter:
    """How many sentences of the text each swap changes, by (term, other or None)."""
    out: Counter = Counter()
    for own, swapped in counterfactuals(text):
        (term,) = own - swapped or {None}
        other = next(iter(swapped - own), None)
        out[term, other] += 1
    return out


def train(
    docs: DataFrame,
    labels: DataFrame,
    in_train: Column,
    sample: int = 10_000,
    penalty: float = 10.0,
    label: str = "toxic",
) -> Model:
    """Fit on at most ``sample`` labelled documents of the training fold.

    The documents' words are counted on the executors. What reaches the driver are the
    ``VOCABULARY`` words that tell most, for each sampled document the places of its words
    among them, and the number of swaps of each pair of identity terms.
    """
    chosen = F.broadcast(sampled_labels(labels, label, in_train, sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("t"))
    # Of rows that repeat an id one counts: that of the largest hash, ties by the text.
    rows = rows.join(chosen, "id").withColumn("h", F.xxhash64("t"))
    rows = rows.groupBy("id", "y").agg(F.max(F.struct("h", "t")).alias("r")).select("id", "y", "r.t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found = [sorted(words(t)) for t in texts]
            swaps = [[(a, b, n) for (a, b), n in swap_counts(t).items()] for t in texts]
            kind = pa.list_(pa.struct([("a", pa.string()), ("b", pa.string()), ("n", pa.int32())]))
            swaps = [[{"a": a, "b": b, "n": n} for a, b, n in s] for s in swaps]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))]
            names = ["id", "y", "words", "swaps"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(swaps, kind)], names)

    schema = "id long, y double, words array<string>, swaps array<struct<a: string, b: string, n: int>>"
    rows = written(rows.mapInArrow(run, schema), "toxic-words")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if not 0 < ones < n:
        return _constant(np.repeat([1.0, 0.0], [int(ones), int(n - ones)]))
    each = rows.select("y", F.explode("words").alias("w")).groupBy("w")
    each = each.agg(F.count("*").cast("double").alias("k"), F.sum("y").alias("a"))
    chi = f"(a - k * {ones!r}D / {n}) * (a - k * {ones!r}D / {n}) * (1 / (k * {ones!r}D / {n}) + 1 / (k - k * {ones!r}D / {n}))"
    each = each.select("w", "k", F.expr(chi).alias("chi"), (~F.col("w").isin(*_KIND)).alias("other"))
    each = each.where(f"not other or chi >= {LEAST_CHI} and k >= 3")
    kept = [r["w"] for r in each.orderBy("other", F.desc("chi"), "w").limit(VOCABULARY).collect()]
    held = rows.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(kept)})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = held.value
        for batch in batches:
            found = [sorted(at[w] for w in t if w in at) for t in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "y", "at"])

    placed = sorted(rows.select("id", "y", "words").mapInArrow(place, "id long, y double, at array<int>").collect())
    swaps = rows.select(F.explode("swaps").alias("s")).groupBy("s.a", "s.b").agg(F.sum("s.n").alias("n"))
    swaps = {(r["a"], r["b"]): r["n"] for r in sorted(swaps.collect(), key=lambda r: (r["a"] or "", r["b"] or ""))}
    y = np.array([r["y"] for r in placed], float)
    return weigh(kept, [np.array(r["at"], np.int64) for r in placed], y, swaps, penalty)


def scorer(model: Model) -> Callable[[list[str | None]], list[float]]:
    return lambda texts: [model.score(t) for t in texts]

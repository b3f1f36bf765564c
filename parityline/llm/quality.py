"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature's values fall into bins. Rounds of boosting go through the features in a
cycle; each step fits a shallow tree on one feature to the gradient and adds its leaves,
shrunk, to the feature's lookup table. Then the same is done for the pairs of features
whose joint tables explain most of what is left. A score is a sum of table entries.

The model is fitted on a bounded sample of labelled rows (``sample``) in a stated hash
order; scoring covers every row and whole texts, as one pass without a shuffle.

Defined results: a null text counts as empty and gets a score; without a label of both
kinds the score is the share of ones (0.5 without any label); repeated labels of a
document count as their largest; null labels and labels without a document are ignored;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = (
    "words",
    "word_length",
    "distinct_words",
    "top_word",
    "repeats_next",
    "letters",
    "capitals",
    "digits",
    "symbols",
    "doubled_symbols",
    "line_words",
    "distinct_lines",
)
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_SYMBOL = (_BYTES < 128) & ~_LETTER & ~_DIGIT & ~_SPACE & ~np.isin(_BYTES, [*b".,;:'\"-()?"])


def features(text: str | None) -> list[float]:
    """One number for each of ``FEATURES``, from the whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, size = max(1, len(words)), max(1, len(raw))
    codes = np.frombuffer(raw, np.uint8)
    counts = np.bincount(codes, minlength=256)
    seen = Counter(words)
    symbol = _SYMBOL[codes]
    return [
        math.log1p(len(words)),
        math.log1p(size / n),
        len(seen) / n,
        max(seen.values(), default=0) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        counts[_LETTER].sum() / size,
        counts[_UPPER].sum() / max(1, counts[_LETTER].sum()),
        counts[_DIGIT].sum() / size,
        counts[_SYMBOL].sum() / size,
        float((symbol[1:] & (codes[1:] == codes[:-1])).sum()) / size,
        math.log1p(n / max(1, len(lines))),
        len(set(lines)) / max(1, len(lines)),
    ]


@dataclass
class Additive:
    """Lookup tables over binned features; ``pairs`` maps (i, j) to a joint table."""

    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)
    single: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities: for all rows at once, one addition per table."""
        total = np.full(len(x), self.intercept)
        bins = [np.searchsorted(c, x[:, i], "right") for i, c in enumerate(self.cuts)]
        for i, table in enumerate(self.single):
            total += table[bins[i]]
        for (i, j), table in self.pairs.items():
            total += table[bins[i], bins[j]]
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def _split(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[int, float]:
    """Where to cut a run of bins in two, and what that gains."""
    left_g, left_h = g.cumsum()[:-1], h.cumsum()[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2)
    if not len(gain):
        return 0, 0.0
    at = int(gain.argmax())
    return at + 1, float(gain[at] - g.sum() ** 2 / (h.sum() + l2))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, l2: float) -> np.ndarray:
    """Leaf value of each bin of a tree with at most ``leaves`` leaves, cut best first."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = max(((_split(g[a:b], h[a:b], l2), a, b) for a, b in parts), key=lambda s: s[0][1])
        (at, gain), a, b = best
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + l2)
    return out


def _joint(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[np.ndarray, float]:
    """A tree over two features: cut one, then each side by the other. Values and gain."""
    best, gain = np.zeros_like(g), 0.0
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        at, _ = _split(a.sum(axis=1), b.sum(axis=1), l2)
        out, total = np.zeros_like(a), 0.0
        for rows in (slice(0, at), slice(at, len(a))):
            leaf = _tree(a[rows].sum(axis=0), b[rows].sum(axis=0), 2, l2)
            out[rows] = leaf
            total += float((leaf * a[rows].sum(axis=0)).sum())
        if total > gain:
            best, gain = (out.T if turned else out), total
    return best, gain


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 120,
    rate: float = 0.15,
    bins: int = 32,
    leaves: int = 3,
    pairs: int = 6,
    l2: float = 2.0,
) -> Additive:
    """Fit by cyclic boosting: first single features, then the best ``pairs``."""
    share = (y.sum() + 0.5) / (len(y) + 1) if 0 < y.sum() < len(y) else None
    if share is None:
        share = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
        return Additive(math.log(share / (1 - share)))
    model = Additive(math.log(share / (1 - share)))
    grid = np.linspace(0, 1, bins + 1)[1:-1]
    model.cuts = [np.unique(np.quantile(x[:, i], grid)) for i in range(x.shape[1])]
    at = [np.searchsorted(c, x[:, i], "right") for i, c in enumerate(model.cuts)]
    size = [len(c) + 1 for c in model.cuts]
    model.single = [np.zeros(n) for n in size]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i, b in enumerate(at):
            g, h = slopes()
            step = rate * _tree(
                np.bincount(b, g, size[i]), np.bincount(b, h, size[i]), leaves, l2
            )
            model.single[i] += step
            total += step[b]

    def joint(i: int, j: int) -> tuple[np.ndarray, float]:
        g, h = slopes()
        cell, shape = at[i] * size[j] + at[j], (size[i], size[j])
        g, h = (np.bincount(cell, v, size[i] * size[j]).reshape(shape) for v in (g, h))
        return _joint(g, h, l2)

    every = [(i, j) for i in range(len(at)) for j in range(i)]
    chosen = sorted(every, key=lambda ij: -joint(*ij)[1])[:pairs]
    model.pairs = {ij: np.zeros((size[ij[0]], size[ij[1]])) for ij in chosen}
    for _ in range(rounds // 2):
        for i, j in chosen:
            step = rate * joint(i, j)[0]
            model.pairs[i, j] += step
            total += step[at[i], at[j]]
    return model


def sampled_labels(
    labels: DataFrame, label: str, train: Column, sample: int, id_col: str = "doc_id"
) -> DataFrame:
    """At most ``sample`` rows (id, y) of the training fold, first in a hash order of the id."""
    rows = labels.where(train).where(f"`{id_col}` is not null and `{label}` is not null")
    rows = rows.groupBy(F.col(f"`{id_col}`").cast("long").alias("id"))
    rows = rows.agg(F.max(F.col(f"`{label}`").cast("double")).alias("y"))
    return rows.orderBy(F.xxhash64("id"), "id").limit(sample)


def train(docs: DataFrame, labels: DataFrame, in_train: Column, sample: int = 10_000) -> Additive:
    """Fit on the features of at most ``sample`` labelled documents of the training fold.

    Only the numbers of the sampled documents reach the driver, one row each: rows that
    repeat an id are reduced to the largest numbers on the executors.
    """
    chosen = F.broadcast(sampled_labels(labels, "quality", in_train, sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t) for t in batch.column(2).to_pylist()]
            x = pa.array(x, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), x], ["id", "y", "x"])

    rows = rows.join(chosen, "id").select("id", "y", "t")
    rows = rows.mapInArrow(run, "id long, y double, x array<double>")
    found = sorted(rows.groupBy("id", "y").agg(F.max("x").alias("x")).collect())
    x = np.array([r["x"] for r in found], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["y"] for r in found], float))


def scorer(model: Additive) -> Callable[[list[str | None]], np.ndarray]:
    def score(texts: list[str | None]) -> np.ndarray:
        return model.scores(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES)))

    return score


def scored(docs: DataFrame, keep: Column, score: Callable, text_col: str = "text") -> DataFrame:
    """(kept, score) per row of ``docs``: one pass over the whole texts, no shuffle.

    ``score`` turns a list of texts into probabilities; ``keep`` is carried along.
    """
    rows = docs.select(keep.alias("kept"), F.col(f"`{text_col}`").alias("t"))
    kind = rows.schema["kept"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = pa.array(score(batch.column(1).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), p], ["kept", "score"])

    return rows.mapInArrow(run, f"kept {kind}, score double")


def drop_rejected(docs: DataFrame, model: Additive, threshold: float = 0.5) -> DataFrame:
    """``docs`` without those that score below ``threshold``."""
    rows = scored(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]), scorer(model))
    return rows.where(F.col("score") >= threshold).select("kept.*")

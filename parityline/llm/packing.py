"""Packing of documents into training sequences along a space-filling curve.

Every document's token ids are hashed into a vector of counts, which a fixed random
projection takes to three dimensions; these are spread evenly by the corpus's means and
deviations and joined to one Hilbert key. Documents are range-sorted by that key, and
each range is cut into sequences in order, so a sequence holds neighbours on the curve,
which are alike. A document that does not fit into the rest of a sequence is cut there,
so that only the last sequence of a range is not full.

The ids move through two steps: a pass that encodes the texts and writes ids and places,
and the range sort. Ranges hold about ``RANGE_TOKENS`` tokens, in parts of at most ``PART``
ids, so neither long documents nor many equal ones make a range heavy: keys that tie are
split by id and part.

Defined results: a null or empty text has the end id alone; repeated rows are packed each;
rows with a null id are packed under it; an empty table gives no sequences; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityline.llm.common import written
from parityline.llm.pretokens import WORD_PATTERN, Encoder

LENGTH = 2048
END_ID = 1
BUCKETS, DIMENSIONS, SEED = 256, 3, 42
ORDER = 16  # bits per dimension of the curve
RANGE_TOKENS = 4_000_000
PART = 2 * LENGTH


def _bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 16-bit numbers."""
    return struct.pack(f"<{len(ids)}H", *ids)


def _ids(encoder: Encoder, text: str) -> bytes:
    """Ids of the whole text and the end id."""
    if not encoder.plain(text):
        return _bytes([*encoder.whole(text), END_ID])
    found = encoder.cached(encoder.pieces(text), _bytes)
    return b"".join([*found, _bytes([END_ID])])


def _buckets(size: int) -> np.ndarray:
    """A fixed hash of every id to a bucket."""
    return ((np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.int64)


def encoded(docs: DataFrame, path: str, id_col: str, text_col: str) -> DataFrame:
    """(doc, start, ids, n, p0, p1, p2): a document's ids in parts of at most ``PART`` ids.

    ``n`` is the document's number of ids and p0 to p2 its projected vector, on every part.
    Parts make rows alike in size, so that ranges of rows are ranges of tokens.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc"), F.coalesce(f"`{text_col}`", F.lit("")).alias("t")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bucket = Encoder.of(path, WORD_PATTERN, lower=True), _buckets(1 << 16)
        axes = np.random.default_rng(SEED).standard_normal((BUCKETS, DIMENSIONS))
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                ids = [_ids(encoder, t) for t in part.column(1).to_pylist()]
                vectors = np.zeros((len(ids), BUCKETS))
                for k, data in enumerate(ids):
                    vectors[k] = np.bincount(bucket[np.frombuffer(data, "<u2")], minlength=BUCKETS)
                vectors = np.log1p(vectors)
                vectors /= np.maximum(1e-9, np.linalg.norm(vectors, axis=1, keepdims=True))
                at = vectors @ axes
                cuts = [(k, s) for k, data in enumerate(ids) for s in range(0, len(data), 2 * PART)]
                row = np.array([k for k, _ in cuts], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row)),
                        pa.array([s // 2 for _, s in cuts], pa.int64()),
                        pa.array([ids[k][s : s + 2 * PART] for k, s in cuts], pa.binary()),
                        pa.array([len(ids[k]) // 2 for k in row], pa.int64()),
                        *[pa.array(at[row, d]) for d in range(DIMENSIONS)],
                    ],
                    ["doc", "start", "ids", "n", "p0", "p1", "p2"],
                )

    return rows.mapInArrow(
        run, "doc long, start long, ids binary, n long, p0 double, p1 double, p2 double"
    )


def hilbert(cells: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells``: coordinates of ``order`` bits.

    From the highest bit down, an axis whose bit is set inverts the lower bits of the first
    axis, any other swaps them with its own; then the bits are read as a Gray code.
    """
    x = cells.astype(np.int64).T.copy()
    for b in range(order - 1, 0, -1):
        low = (1 << b) - 1
        for axis in x:
            is_set = (axis >> b) & 1 == 1
            swap = np.where(is_set, 0, (x[0] ^ axis) & low)
            axis ^= swap
            x[0] ^= np.where(is_set, low, swap)
    key, gray = np.zeros(x.shape[1], np.int64), np.zeros(x.shape[1], np.int64)
    for b in range(order - 1, -1, -1):
        for axis in x:
            gray ^= (axis >> b) & 1
            key = (key << 1) | gray
    return key


def _curve_key(spread: list[tuple[float, float]]) -> Callable[..., Column]:
    """Hilbert key of projected vectors, each dimension spread by its mean and deviation."""

    @F.pandas_udf("long")
    def key(p0: pd.Series, p1: pd.Series, p2: pd.Series) -> pd.Series:
        cells = []
        for p, (mean, deviation) in zip((p0, p1, p2), spread, strict=True):
            even = 1 / (1 + np.exp(-1.7 * (p.to_numpy() - mean) / max(deviation, 1e-12)))
            cells.append(np.clip((even * (1 << ORDER)).astype(np.int64), 0, (1 << ORDER) - 1))
        return pd.Series(hilbert(np.stack(cells, axis=1)))

    return key


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of one range's documents, in its order, into sequences of ``LENGTH`` ids."""
    sequence, filled = TaskContext.get().partitionId() << 32, 0
    names = ["doc", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part, out = batch.slice(begin, 256), []
            for doc, start, total, data in zip(*(c.to_pylist() for c in part.columns), strict=True):
                ids, at = np.frombuffer(data, "<u2").astype("<u4"), 0
                while at < len(ids):
                    n = min(len(ids) - at, LENGTH - filled)
                    piece = ids[at : at + n].tobytes()
                    out.append((doc, start + at, n, total, sequence, filled, piece))
                    at, filled = at + n, filled + n
                    if filled == LENGTH:
                        sequence, filled = sequence + 1, 0
            kinds = [pa.int64()] * 6 + [pa.binary()]
            columns = zip(*out, strict=True) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )


def packed(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (doc, start, length, doc_tokens, sequence_id, offset, ids).

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers; ``start``
    counts the document's ids before them, ``offset`` the sequence's.
    """
    rows = encoded(docs, path, id_col, text_col).withColumn("uid", F.monotonically_increasing_id())
    rows = written(rows, "encoded")
    places = [f(f"p{d}") for d in range(DIMENSIONS) for f in (F.avg, F.stddev_pop)]
    total, *stats = rows.where("start = 0").agg(F.coalesce(F.sum("n"), F.lit(0)), *places).first()
    stats = [s or 0.0 for s in stats]
    key = _curve_key(list(zip(stats[::2], stats[1::2], strict=True)))
    ranges = max(1, round(total / RANGE_TOKENS))
    rows = rows.select("doc", "start", "n", "ids", "uid", key("p0", "p1", "p2").alias("key"))
    rows = rows.repartitionByRange(ranges, "key", "doc", "uid").sortWithinPartitions("key", "doc", "uid")
    return rows.select("doc", "start", "n", "ids").mapInArrow(
        _cut,
        "doc long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary",
    )

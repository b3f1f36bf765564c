"""Token counts by a two-tier lookup on the map side.

Tier one is a compact table of frequent pre-tokens and their numbers of tokens, made from
a bounded sample of documents and broadcast. Tier two is a cache in each Python worker:
a pre-token that the table lacks is encoded by the library once and remembered. No
pre-token is ever shuffled, and the counts do not depend on what the table holds.

Defined results: a null text counts as empty and has no tokens; repeated rows are counted
each; a null id stays null; an empty table gives an empty result; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityline.llm.pretokens import BYTE_PATTERN, LONGEST, Encoder


def frequent(docs: DataFrame, path: str, text_col: str, sample: int, entries: int) -> dict[str, int]:
    """Numbers of tokens of the ``entries`` most frequent pre-tokens in ``sample`` documents,
    but for very long ones.

    The sample is the first in a hash order of the texts; it only decides what is looked
    up fast. One task counts it, so only the table reaches the driver.
    """
    rows = docs.select(F.col(f"`{text_col}`").alias("t")).where("t is not null")
    rows = rows.select(F.xxhash64("t").alias("h"), "t")
    total = rows.count()
    # About twice the wanted share by hash, so that few rows reach the exact limit.
    share = min(1.0, 2 * sample / max(1, total))
    below = min(2**63 - 1, int(-(2**63) + share * 2**64))
    rows = rows.where(F.col("h") <= F.lit(below))
    rows = rows.orderBy("h", F.length("t")).limit(sample).select("t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = Encoder.of(path, BYTE_PATTERN, lower=False), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if encoder.plain(text):
                    seen.update(p for p in encoder.pieces(text) if len(p) <= LONGEST)
        words = sorted(seen, key=lambda w: (-seen[w], w))[:entries]
        lengths = [len(encoder.piece(w)) for w in words]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(lengths, pa.int32())], ["word", "n"]
        )

    return {r["word"]: r["n"] for r in rows.coalesce(1).mapInArrow(run, "word string, n int").collect()}


def token_counts(
    docs: DataFrame,
    path: str,
    keep: Column,
    text_col: str = "text",
    sample: int = 2_000,
    entries: int = 65_536,
) -> DataFrame:
    """(kept, n_bytes, n_tokens) per row of ``docs``, over whole texts."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent(docs, path, text_col, sample, entries))
    rows = docs.select(keep.alias("kept"), F.coalesce(f"`{text_col}`", F.lit("")).alias("t"))
    kind = rows.schema["kept"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, first = Encoder.of(path, BYTE_PATTERN, lower=False), table.value

        def count(text: str) -> int:
            if not encoder.plain(text):
                return len(encoder.whole(text))
            pieces = encoder.pieces(text)
            found = list(map(first.get, pieces))
            if None not in found:
                return sum(found)
            rare = [p for p, n in zip(pieces, found, strict=True) if n is None]
            return sum(filter(None, found)) + sum(encoder.cached(rare, len))

        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                    pa.array([count(t) for t in texts], pa.int64()),
                ],
                ["kept", "n_bytes", "n_tokens"],
            )

    return rows.mapInArrow(run, f"kept {kind}, n_bytes long, n_tokens long")

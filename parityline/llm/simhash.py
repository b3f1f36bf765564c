"""Near-duplicates by SimHash with deletion-variant signatures.

Any two fingerprints that differ in at most three of 64 bits agree, up to one bit, in
one of their two halves. So each fingerprint is filed under every half with every bit of
it left out: 64 signatures. Fingerprints that share a signature are candidates, and their
whole distance decides. A signature that many fingerprints share is split by filing its
members again under the halves of the part that it leaves open, so that no group of
candidates exceeds a size that follows from the number of bits.

Defined results: a null text counts as empty; a text without words has fingerprint zero
and is linked like any other; rows with a null id get a null id back and take part in
linking; repeated rows each get a result; an empty table gives an empty result; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.llm.common import broadcast_if_small, fresh_name, row_key, written
from parityline.llm.components import connected

SEED = 42
BITS = 64
#: Members of a signature that are compared in one go. Three signatures one within
#: another leave 8 bits open and one bit in each, so at most 2 ** 11 fingerprints share them.
GROUP = 2048
#: Signatures of three fingerprints or more, up to this count, are sent to all executors.
BROADCAST_ROWS = 1_000_000


def _hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of every shingle of the text, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    out = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)])
    return np.frombuffer(out, ">u8")


def fingerprint(text: str | None, width: int = 3) -> int:
    """The fingerprint as an unsigned number: bits set in over half the shingles' hashes."""
    hashes = _hashes(text or "", width)
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    whole = len(bits) // 255 * 255
    ones = bits[:whole].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    ones += bits[whole:].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = 3) -> DataFrame:
    """(id, fp) per row; fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, width) for t in batch.column(1).to_pylist()]
            prints = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], ["id", "fp"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t"))
    return rows.mapInArrow(run, "id long, fp long")


def _signatures(rows: DataFrame) -> DataFrame:
    """Rows (key, fp, low, width) under both halves of their open bits, each bit left out.

    ``low`` and ``width`` of the result are the half that remains open.
    """
    half = F.expr("int(width / 2)")
    at = F.col("low") + F.when(F.col("p") < half, 0).otherwise(half)
    rest = F.col("low") + F.when(F.col("p") < half, half).otherwise(0)
    mask = F.expr("shiftleft(1L, int(width / 2)) - 1L")
    part = F.expr("shiftright(fp, at)").bitwiseAND(mask)
    bit = F.expr("shiftleft(1L, low + p - at)")
    return (
        rows.withColumn("p", F.explode(F.expr("sequence(0, width - 1)")))
        .withColumn("at", at)
        .select(
            F.xxhash64("key", "p", part.bitwiseAND(F.bitwise_not(bit))).alias("key"),
            "fp",
            rest.alias("low"),
            half.alias("width"),
        )
    )


def _forest(distance: int):
    """Links that connect what lies within ``distance`` in each group of fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for group in batch.column(0).to_pylist():
                fps = np.array(group, np.int64)
                bits, left = fps.view(np.uint64), np.arange(len(fps))
                while len(left):
                    root, edge, left = fps[left[0]], left[:1], left[1:]
                    while len(edge) and len(left):
                        step = max(1, 2**20 // len(left))
                        near = np.zeros(len(left), bool)
                        for i in range(0, len(edge), step):
                            apart = bits[edge[i : i + step], None] ^ bits[left]
                            near |= (np.bitwise_count(apart) <= distance).any(axis=0)
                        edge, left = left[near], left[~near]
                        a += [root] * len(edge)
                        b += fps[edge].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def links(prints: DataFrame, distance: int = 3, group: int = GROUP) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints ``fp`` that connect all within ``distance``.

    Fingerprints of a signature that two share are paired as they are; of one that up to
    ``group`` share, a forest is returned that connects the same ones.
    """
    if not 2 <= distance <= 3:
        raise ValueError("two halves serve distances of two and three bits")
    rows = prints.select(
        F.lit(0).cast("long").alias("key"), "fp", F.lit(0).alias("low"), F.lit(BITS).alias("width")
    )
    found, depth = None, 0
    while True:
        depth += 1
        # The third signature leaves 8 bits open and one in each: a group is bounded by that.
        most = group if depth < 3 else max(group, GROUP)
        signed = _signatures(rows)
        keys = signed.groupBy("key").agg(
            F.min("fp").alias("a"), F.max("fp").alias("b"), F.count("*").alias("n")
        )
        keys = written(keys.where("n > 1"), "signatures")
        pairs = keys.where("n = 2").select("a", "b")
        pairs = pairs.where(F.expr(f"bit_count(a ^ b) <= {distance}"))
        shared = keys.where(f"n between 3 and {most}").select("key")
        shared = broadcast_if_small(shared, shared.count(), BROADCAST_ROWS)
        some = signed.join(shared, "key", "left_semi")
        some = some.groupBy("key").agg(F.array_sort(F.collect_set("fp")).alias("fps"))
        some = some.select("fps").distinct().mapInArrow(_forest(distance), "a long, b long")
        part = written(pairs.unionAll(some).distinct(), "links")
        found = part if found is None else found.unionAll(part)
        large = keys.where(f"n > {most}").select("key")
        if large.isEmpty():
            return found
        rows = written(signed.join(large, "key", "left_semi"), "open")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3
) -> DataFrame:
    """(id, fp, component) per row: the smallest id that links lead to, itself included.

    Null ids count last: a component has one only if it has no other.
    """
    prints = written(fingerprints(docs, id_col, text_col, width), "prints")
    distinct = written(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    nodes = written(connected(links(distinct, distance)), "nodes")
    named = distinct.join(nodes, F.col("fp") == F.col("node"))
    roots = named.groupBy("root").agg(F.min("first").alias("smallest"))
    smallest = nodes.join(roots, "root").select(F.col("node").alias("fp"), "smallest")
    label = distinct.join(smallest, "fp", "left").select(
        "fp", F.coalesce("smallest", "first").alias("component")
    )
    return prints.join(written(label, "label"), "fp").select("id", "fp", "component")


def drop_near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id.

    Of rows that repeat its doc_id one stays. Rows without a doc_id stay only if no
    other row of their component has one.
    """
    name = fresh_name(docs, "key")
    keyed = docs.withColumn(name, row_key(docs))
    found = near_duplicates(keyed, name, "text", width, distance)
    ids = found.groupBy("id").agg(F.min("component").alias("c"), F.count("*").alias("n"))
    ids = written(ids.where("n > 1 or c < id").select(F.col("id").alias(name), "n", "c"), "copies")
    single = keyed.join(ids.select(name), name, "left_anti")
    repeated = ids.where(f"c = `{name}`").select(name)
    repeated = keyed.join(repeated, name, "left_semi").dropDuplicates([name])
    return single.unionByName(repeated).select(*[f"`{c}`" for c in docs.columns])

"""Exact top-k inner products by branch and bound over ball trees, one tree per shard.

Vectors are quantised to integers and dealt to shards of a bounded size by a hash of their
id, themselves and a row number. Each shard's tree is built once and written to a file, and
so are the queries, in blocks. A search task holds one shard, and searches it for a bounded
number of blocks; what is shuffled are the vectors, once, the files' names and the results,
so shuffled bytes grow with the table and not with its square. A block goes down a tree
best bound first: no vector in a ball has a larger inner product with q than q.c + |q| r.
Nodes whose bound is below a query's current kth score are left out for it.

The kth score is shared as the search goes on: it runs in rounds, of one shard a block, then
of seven times as many as before, and after each one the best kth score of every query that
any shard has found is written for all tasks of the next. Scores are sums of products of
integers, so ties are exact; a node is left out only if its bound is below the kth score,
and of equal scores the smaller id wins.

Bounds leave out what is far from the best, as in tables of clusters; vectors of many
dimensions that point all ways alike lie within every bound, and all of them are compared.

Defined results: vectors that are null, or hold a null or a number that is not finite,
take no part; neither do rows with a null id; queries meet vectors of their own length
only; vectors that repeat an id are searched each, and none is found by its own id; with
fewer candidates than k all are returned; an inner product that no long could hold is an
error; an empty table gives an empty result; further columns are ignored, whatever their
names.
"""

from __future__ import annotations

import heapq
import io
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parityline.llm.common import shared_path, written

SCALE = 256
SHARD_ROWS = 8192
LEAF_ROWS = 64
BLOCK_ROWS = 512
#: Blocks of queries that one task searches a shard for.
BLOCKS = 16
#: A round has so many times the shards of all rounds before it.
WIDENING = 7
#: Whole numbers up to this size are exact in floating point.
EXACT = 2.0**52
#: Tasks of a round at most.
TASKS = 10_000


def quantised(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v) of the rows that take part; v holds floor(scale * x) as longs."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), x.alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(~bad)
    return rows.select("id", F.transform("v", lambda c: F.floor(c * scale)).alias("v"))


def _matrix(vectors: list) -> np.ndarray:
    return np.array([np.asarray(v, np.int64) for v in vectors], np.int64).reshape(len(vectors), -1)


def _put(path: str, **arrays: np.ndarray) -> str:
    """Write arrays to a file of the shared folder."""
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    data = io.BytesIO()
    np.savez(data, **arrays)
    with store.open_output_stream(place, compression=None) as out:
        out.write(data.getvalue())
    return path


def _get(path: str) -> dict[str, np.ndarray]:
    store, place = fs.FileSystem.from_uri(path)
    with store.open_input_file(place) as source:
        return dict(np.load(io.BytesIO(source.read())))


class Tree:
    """A ball tree over the rows of a matrix, as arrays.

    A node has a ball, the range of rows in it, and the number of its second child, 0 for a
    leaf; its first child follows it.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, centre: np.ndarray, radius: np.ndarray, ranges: np.ndarray, second: np.ndarray):
        self.ids, self.rows, self.centre, self.radius, self.ranges, self.second = ids, rows, centre, radius, ranges, second

    @classmethod
    def of(cls, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF_ROWS) -> Tree:
        x, order = rows.astype(float), np.arange(len(ids))
        centre, radius, ranges, second = [], [], [], []
        waiting = [(0, len(ids), -1)]
        while waiting:
            low, high, parent = waiting.pop()
            node, at = len(centre), order[low:high]
            if parent >= 0:
                second[parent] = node
            middle = x[at].mean(axis=0)
            apart = np.linalg.norm(x[at] - middle, axis=1)
            centre.append(middle)
            radius.append(float(apart.max(initial=0.0)))
            ranges.append((low, high))
            second.append(0)
            if len(at) > leaf and radius[node] > 0:
                # Halves along the line through two far points.
                one = x[at[apart.argmax()]]
                two = x[at[np.linalg.norm(x[at] - one, axis=1).argmax()]]
                order[low:high] = at[(x[at] @ (two - one)).argsort(kind="stable")]
                half = low + len(at) // 2
                waiting += [(half, high, node), (low, half, -1)]
        return cls(ids[order], rows[order], np.array(centre), np.array(radius), np.array(ranges), np.array(second))

    def search(
        self, ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray
    ) -> tuple[list[np.ndarray], int]:
        """The best k (score, id) of each query, those below ``least`` left out, and the
        number of pairs of a query and a vector that were compared.

        All queries of the block share the walk; a node serves those whose bound holds.
        """
        q = queries.astype(float)
        top = float(np.abs(q).max(initial=0)) * float(np.abs(self.rows).max(initial=0)) * q.shape[1]
        if top >= 2.0**63:
            raise ValueError("inner products beyond 64 bits")
        bound = q @ self.centre.T + np.linalg.norm(q, axis=1, keepdims=True) * self.radius
        # Rounding can only have taken a little from a bound.
        bound += 1e-6 * (1 + np.abs(bound))
        left, right = (queries, self.rows) if top >= EXACT else (q, self.rows.astype(float))
        kth = least.astype(float).copy()
        best = [np.zeros((0, 2), np.int64) for _ in ids]
        heap, compared = [(-bound[:, 0].max(initial=-np.inf), 0)], 0
        while heap:
            _, node = heapq.heappop(heap)
            active = np.flatnonzero(bound[:, node] >= kth)
            if not len(active):
                continue
            if self.second[node]:
                for child in (node + 1, int(self.second[node])):
                    heapq.heappush(heap, (-bound[active, child].max(), child))
                continue
            low, high = self.ranges[node]
            compared += len(active) * int(high - low)
            scores, own = left[active] @ right[low:high].T, self.ids[low:high]
            hits = (scores >= kth[active, None]) & (own != ids[active, None])
            for i, row, hit in zip(active[hits.any(axis=1)], scores[hits.any(axis=1)], hits[hits.any(axis=1)], strict=True):
                new = np.stack([row[hit].astype(np.int64), own[hit]], axis=1)
                both = np.concatenate([best[i], new])
                best[i] = both = both[np.lexsort((both[:, 1], -both[:, 0]))][:k]
                if len(both) == k:
                    kth[i] = max(kth[i], float(both[-1, 0]))
        return best, compared


def _written_groups(folder: str, kind: str, make: Callable[[pd.DataFrame], dict[str, np.ndarray]]) -> Callable:
    """Write what ``make`` makes of each group (d, ``kind``) to a file; its row names it."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        path = _put(f"{folder}/{uuid.uuid4().hex}.npz", **make(rows))
        found = {"d": rows["d"].iloc[:1], kind: rows[kind].iloc[:1], "path": path, "n": len(rows)}
        return pd.DataFrame(found)

    return run


def _tree(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    return vars(Tree.of(rows["id"].to_numpy(), _matrix(rows["v"].tolist())))


def _block(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    rows = rows.sort_values("id")
    return {"ids": rows["id"].to_numpy(), "vectors": _matrix(rows["v"].tolist())}


def _bounds(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    rows = rows.sort_values("query")
    return {"ids": rows["query"].to_numpy(), "least": rows["kth"].to_numpy(float)}


def planted(vectors: DataFrame, shards: int, folder: str) -> DataFrame:
    """(d, shard, path, n): the trees of vectors (id, v, no), written to files of ``folder``."""
    # Rows that repeat an id go to all shards.
    dealt = F.expr(f"pmod(xxhash64(id, v, no), {shards})").cast("int")
    held = vectors.select("id", "v", F.size("v").alias("d"), dealt.alias("shard")).groupBy("d", "shard")
    schema = "d int, shard int, path string, n long"
    return written(held.applyInPandas(_written_groups(folder, "shard", _tree), schema), "trees")


def _search(k: int) -> Callable:
    """Searches trees for blocks of queries, both read from files; rows of a tree are together."""
    names = ["d", "block", "query", "id", "score"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tree = None, None
        for batch in batches:
            for d, block, path, asked, kth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != at:
                    at, tree = path, Tree(**_get(path))
                queries = _get(asked)
                ids, least = queries["ids"], np.full(len(queries["ids"]), -np.inf)
                if kth is not None:
                    known = _get(kth)
                    least[np.searchsorted(ids, known["ids"])] = known["least"]
                found, _ = tree.search(ids, queries["vectors"], k, least)
                out = [(d, block, i, b, a) for i, best in zip(ids.tolist(), found, strict=True) for a, b in best.tolist()]
                columns = zip(*out, strict=True) if out else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return run


def nearest(
    rows: DataFrame,
    is_query: str,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query, rank, id, score): the ``k`` largest inner products of each query, exactly.

    ``is_query`` is SQL over the column id. A query that repeats an id is asked once, with
    the smallest of its vectors.
    """
    spark = rows.sparkSession
    # Written at once: the numbers stay the same from then on.
    vectors = quantised(rows, id_col, vector_col).withColumn("no", F.monotonically_increasing_id())
    vectors = written(vectors, "vectors")
    shards = max(1, -(-vectors.count() // shard_rows))
    folder = shared_path(spark, "ball-trees")
    trees = planted(vectors, shards, folder)

    queries = vectors.where(is_query).groupBy("id").agg(F.min(F.struct("v", F.size("v").alias("d"))).alias("q"))
    queries = written(queries.select("id", "q.*"), "queries")
    # Blocks by a hash, so that their sizes vary around half the limit.
    per = max(1, -(-2 * queries.count() // block_rows))
    blocks = queries.withColumn("block", F.expr(f"pmod(xxhash64(id, 1), {per})").cast("int"))
    schema = "d int, block int, path string, n long"
    asked = blocks.groupBy("d", "block").applyInPandas(_written_groups(folder, "block", _block), schema)
    asked = written(asked.select("d", "block", F.col("path").alias("asked")), "asked")

    # Each block meets the shards in an order of its own, so that a round uses all of them.
    turn = F.expr(f"pmod(shard - block, {shards})")
    pairs = asked.join(trees.select("d", "shard", "path"), "d").withColumn("turn", turn)
    pairs = pairs.withColumn("batch", F.expr(f"block div {BLOCKS}"))
    ordered = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = kth = None
    done = 0
    while done < shards:
        upto = min(shards, done + max(1, WIDENING * done))
        some = pairs.where(F.col("turn").between(done, upto - 1))
        if kth is None:
            some = some.withColumn("kth", F.lit(None).cast("string"))
        else:
            some = some.join(kth, ["d", "block"], "left")
        tasks = min(TASKS, (upto - done) * per, shards * -(-per // BLOCKS))
        some = some.repartition(tasks, "path", "batch").sortWithinPartitions("path", "block")
        found = some.select("d", "block", "path", "asked", "kth").mapInArrow(
            _search(k), "d int, block int, query long, id long, score long"
        )
        found = found if best is None else found.unionByName(best.drop("rank"))
        best = written(found.withColumn("rank", F.row_number().over(ordered)).where(f"rank <= {k}"), "best")
        done = upto
        if done < shards:
            last = best.where(f"rank = {k}").select("d", "block", "query", F.col("score").alias("kth"))
            kth = last.groupBy("d", "block").applyInPandas(_written_groups(folder, "block", _bounds), schema)
            kth = written(kth.select("d", "block", F.col("path").alias("kth")), "kth")
    return best.select("query", "rank", "id", "score")


def oracle(k: int = 5, every: int = 50) -> str:
    """The same by DuckDB, multiplying every query with every vector."""
    return f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
          FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding,
            lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {every} = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""

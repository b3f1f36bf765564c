"""Connected components of an undirected graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(lo, hi))")).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable.

    Each round hangs every node's larger neighbours on its smallest one, then its
    smaller ones; both are one grouped minimum and one join. The rounds grow with the
    logarithm of the longest chain, and each is written to the shared folder. Nodes
    without an edge to another node do not appear.
    """
    lo, hi = F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")
    edges = written(edges.select(lo, hi).where("lo < hi").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        smallest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u")
            .join(smallest, "u")
            .select(F.least("m", "u").alias("lo"), F.col("v").alias("hi"))
            .distinct()
        )
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(smallest, "hi").select(
            F.explode(
                F.array(
                    F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")),
                    F.struct(F.col("m").alias("lo"), F.col("hi")),
                )
            ).alias("e")
        )
        edges = written(small.select("e.lo", "e.hi").where("lo < hi").distinct(), "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )

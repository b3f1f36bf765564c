"""Rows that stand for a range of numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WIDTH = 1000


def expand_ranges(df: DataFrame, first: Column, last: Column, out: str, by: list[str]) -> DataFrame:
    """One row per integer from ``first`` to ``last``, numbered in ``out``.

    A row may stand for billions of copies. It is first cut at multiples of 1000
    and the cuts are spread over the cluster by ``by`` and the cut's number, so
    no task writes out more than short runs. Rows whose numbers share a cut stay
    together.
    """
    cut = F.explode(F.sequence(F.expr("_first div 1000"), F.expr("_last div 1000")))
    return (
        df.withColumns({"_first": first, "_last": last})
        .withColumn("_cut", cut)
        .repartition(*by, "_cut")
        .withColumn(
            out,
            F.explode(
                F.sequence(
                    F.greatest("_first", F.col("_cut") * _WIDTH),
                    F.least("_last", F.col("_cut") * _WIDTH + (_WIDTH - 1)),
                )
            ),
        )
        .drop("_first", "_last", "_cut")
    )

"""Shared tables, keys and folds for the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityline.session import shared_path, written

__all__ = ["broadcast_if_small", "fold", "fresh_name", "row_key", "shared_path", "written"]


def broadcast_if_small(df: DataFrame, rows: int, limit: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are within ``limit``.

    Beyond it no hint is given, and Spark joins by a shuffle.
    """
    return F.broadcast(df) if rows <= limit else df


def row_key(df: DataFrame, id_col: str = "doc_id") -> Column:
    """The id, or for rows without one a large number made of the whole row.

    Rows without an id that are equal in all columns share a key.
    """
    made = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).bitwiseAND(F.lit(2**62 - 1))
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), made.bitwiseOR(F.lit(2**62)))


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus, F.lit(0))

"""Joins to a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Equi-join on ``key``, safe when one key holds much of the left side.

    No broadcast hint: Spark broadcasts the right side when its measured size is
    small, and else sorts and merges. There the adaptive skew rule splits a hot
    key over many tasks, but only if both inputs come straight from a shuffle.
    ``right`` is often clustered by ``key`` already, so joining on the key's hash
    as well makes Spark shuffle it (the small side) once more for the rule.
    """
    keyed = right.withColumnRenamed(key, "_key").withColumn("_key_hash", F.hash("_key"))
    on = (F.col(key) == F.col("_key")) & (F.hash(key) == F.col("_key_hash"))
    return left.join(keyed, on, how).drop("_key", "_key_hash")


def left_lookup(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows all stay; a key missing from ``right`` gives nulls."""
    return lookup(left, right, key, "left")


def inner_lookup(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Only left rows whose key is in ``right``."""
    return lookup(left, right, key, "inner")

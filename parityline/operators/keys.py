"""Attaching primary keys to tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.operators.lookup import left_lookup
from parityline.operators.substring import names_containing, names_ending_with, names_listing

NAME = "eds_equivalent_table"


def _names(tickets: DataFrame, name: str) -> DataFrame:
    return tickets.select(name).where(F.col(name).isNotNull()).distinct()


def _ingestion_rows(names: DataFrame, ingestion_keys: DataFrame, name: str) -> DataFrame:
    return names_ending_with(names, ingestion_keys.select("table", "key_cols"), name, "table")


def _view_rows(names: DataFrame, view_keys: DataFrame, name: str, exact: bool) -> DataFrame:
    find = names_listing if exact else names_containing
    return find(names, view_keys.select("view_table", "view_key_cols"), name, "view_table")


def join_ingestion_keys(tickets: DataFrame, ingestion_keys: DataFrame, name: str = NAME) -> DataFrame:
    """Left join on "name ends with .<table>_vw"; one row per matching config."""
    return left_lookup(tickets, _ingestion_rows(_names(tickets, name), ingestion_keys, name), name)


def join_view_keys(
    tickets: DataFrame, view_keys: DataFrame, name: str = NAME, *, exact: bool = False
) -> DataFrame:
    """Left join on "name contains view name"; one row per matching view."""
    return left_lookup(tickets, _view_rows(_names(tickets, name), view_keys, name, exact), name)


def attach_keys(
    tickets: DataFrame,
    ingestion_keys: DataFrame,
    view_keys: DataFrame,
    name: str = NAME,
    *,
    exact: bool = False,
    empty_is_missing: bool = False,
    distinct_columns: bool = False,
) -> DataFrame:
    """Tickets with ``table``, ``view_table`` and ``primary_keys``.

    The ingestion key wins over the view key, even an empty one unless
    ``empty_is_missing``. Keys are resolved once per distinct name, and the
    tickets, of which many may share a name, are joined to that result once. Both
    lookups start from one frame of distinct names, which is shuffled once.
    """
    names = _names(tickets, name)
    # Each name occurs once here, so plain joins on one partitioning will do.
    per_name = names.join(_ingestion_rows(names, ingestion_keys, name), name, "left").join(
        _view_rows(names, view_keys, name, exact), name, "left"
    )
    ingested, viewed = F.col("key_cols"), F.col("view_key_cols")
    if empty_is_missing:
        ingested, viewed = (F.when(F.size(c) > 0, c) for c in (ingested, viewed))
    merged = F.coalesce(ingested, viewed)
    if distinct_columns:
        merged = F.array_distinct(merged)
    resolved = per_name.select(name, "table", "view_table", merged.alias("primary_keys"))
    return left_lookup(tickets, resolved, name)


def pk_coverage(merged: DataFrame) -> DataFrame:
    """Rows in total, with and without a key, as one row."""
    with_pk = F.count("primary_keys")
    return merged.agg(
        F.count("*").alias("total"),
        with_pk.alias("with_pk"),
        (F.count("*") - with_pk).alias("without_pk"),
    )

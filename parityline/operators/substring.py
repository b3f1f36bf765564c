"""Joins on "name ends with" and "name contains", as equi-joins.

Each function takes names that are distinct and returns them with every matching row
of ``keys``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.functions.names import VIEW_SUFFIX
from parityline.operators.lookup import inner_lookup

_SEED = 8


def names_ending_with(names: DataFrame, keys: DataFrame, name: str, key: str) -> DataFrame:
    """Rows where ``name`` ends with ``"." + key + "_vw"``.

    What may stand before the suffix is known: the text after each dot. So every
    name offers as many candidates as it has dots, and an equality finds the key.
    """
    stem = F.substring(F.col(name), F.lit(1), F.length(name) - len(VIEW_SUFFIX))
    parts = F.split(stem, r"\.")
    tails = F.transform(
        F.sequence(F.lit(2), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )
    candidates = (
        names.select(name)
        .where(F.endswith(F.col(name), F.lit(VIEW_SUFFIX)) & (F.size(parts) > 1))
        .select(name, F.explode(tails).alias(key))
    )
    return inner_lookup(candidates, keys, key)


def names_containing(names: DataFrame, keys: DataFrame, name: str, key: str) -> DataFrame:
    """Rows where ``name`` contains ``key``, without comparing all pairs.

    Two equalities replace the nested loop. First the opening letters of each
    key (at most 8) are looked up among all 8-letter pieces of each name; this
    tells where in the name a key may start and how long it may be. Then only
    the pieces of those lengths at those places are looked up among the keys.
    Both steps grow with the text and the true hits, never with names x keys.
    """
    known = keys.where(F.col(key).isNotNull())
    # Lengths are bounded by the longest name, however many keys share a seed.
    seeds = known.groupBy(F.left(F.col(key), F.lit(_SEED)).alias("_seed")).agg(
        F.collect_set(F.length(key)).alias("_lengths")
    )
    # At most 9 values: seeds are shorter than 8 letters only for shorter keys.
    seed_sizes = known.agg(F.collect_set(F.least(F.length(key), F.lit(_SEED)))).scalar()
    size = F.length(name)
    starts = F.sequence(F.lit(1), size - F.col("_size") + 1)
    places = (
        names.select(name)
        .where(F.col(name).isNotNull())
        .select(name, F.explode(seed_sizes).alias("_size"))
        .where(size >= F.col("_size"))
        .select(name, "_size", F.explode(starts).alias("_at"))
        .select(name, "_at", F.substring(F.col(name), F.col("_at"), F.col("_size")).alias("_seed"))
    )
    pieces = (
        inner_lookup(places, seeds, "_seed")
        .select(name, "_at", F.explode("_lengths").alias("_length"))
        .where(F.col("_at") + F.col("_length") - 1 <= size)
        .select(name, "_at", F.substring(F.col(name), F.col("_at"), F.col("_length")).alias(key))
        # A piece that occurs again in the same name counts where it comes first.
        .where(F.instr(F.col(name), F.col(key)) == F.col("_at"))
        .drop("_at")
    )
    return inner_lookup(pieces, known, key)


def names_listing(names: DataFrame, keys: DataFrame, name: str, key: str) -> DataFrame:
    """Rows where a ``/``-separated cell lists ``key`` as a whole name.

    The strict form of ``names_containing``: schema and table of a listed name
    must equal the key, so a name no longer matches its own prefixes.
    """
    parts = F.transform(F.split(name, "/"), lambda one: F.split(F.trim(one), r"\."))
    whole = F.filter(parts, lambda p: F.size(p) > 1)
    listed = F.array_distinct(F.transform(whole, lambda p: F.array_join(F.slice(p, -2, 2), ".")))
    candidates = names.select(name, F.explode(listed).alias(key))
    return inner_lookup(candidates, keys, key)

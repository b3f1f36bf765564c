"""Row comparison of two tables by key and row hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from parityline.functions.hashing import row_hash


def shared_columns(left: DataFrame, right: DataFrame) -> dict[str, DataType]:
    """Columns with the same name and type on both sides, in left order."""
    other = {f.name: f.dataType for f in right.schema.fields}
    return {
        f.name: f.dataType
        for f in left.schema.fields
        if f.name in other and other[f.name] == f.dataType
    }


def _columns_to_hash(
    left: DataFrame, right: DataFrame, keys: list[str], columns: list[str] | None
) -> list[str]:
    shared = list(shared_columns(left, right))
    for role, names in (("compared", columns or []), ("key", keys)):
        for name in names:
            if name not in shared:
                raise ValueError(f"{role} column {name!r} is not in the shared schema")
    return [c for c in (columns or shared) if c not in keys]


def hash_rows(df: DataFrame, hashed: list[str], kept: list[str], **options: bool) -> DataFrame:
    """The ``kept`` columns and ``hash``; a kept column that is hashed is text."""
    return df.select(
        *[
            F.col(f"`{c}`").cast("string").alias(c) if c in hashed else F.col(f"`{c}`")
            for c in kept
        ],
        row_hash(df.schema, hashed, **options).alias("hash"),
    )


def _row_counts(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    columns: list[str] | None,
    bucketed: bool,
    **options: bool,
) -> DataFrame:
    """One ``_row`` of keys and hash with its number of rows on either side.

    Both sides go into a single aggregation instead of a join: one shuffle of
    key and hash only, no sort, each side read once, and copies of a row - even
    a third of the table - collapse before the shuffle. A null in a key never
    matches, so such rows are dropped on the right and share one group on the
    left, where they only count.
    """
    hashed = _columns_to_hash(left, right, keys, columns)
    if bucketed:
        return _bucketed_row_counts(left, right, keys, hashed, **options)

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        usable = _all_known(keys)
        row = F.struct(
            *[F.col(f"`{k}`").alias(k) for k in keys],
            row_hash(df.schema, hashed, **options).alias("_hash"),
        )
        if is_left:
            row = F.when(usable, row)
        else:
            df = df.where(usable)
        return df.select(
            row.alias("_row"),
            F.lit(int(is_left)).alias("_left"),
            F.lit(int(not is_left)).alias("_right"),
        )

    # One struct as key keeps Spark from trying its small first-level map, which
    # mostly unique rows only fill up.
    return (
        side(left, True)
        .unionByName(side(right, False))
        .groupBy("_row")
        .agg(F.sum("_left").alias("left_rows"), F.sum("_right").alias("right_rows"))
    )


def _bucketed_row_counts(
    left: DataFrame, right: DataFrame, keys: list[str], hashed: list[str], **options: bool
) -> DataFrame:
    """The same counts where each side keeps the buckets it was written in."""

    def side(df: DataFrame, counted: str) -> DataFrame:
        fingerprint = row_hash(df.schema, hashed, **options).alias("_hash")
        rows = df.select(*[F.col(f"`{k}`") for k in keys], fingerprint)
        return rows.groupBy(*[f"`{k}`" for k in keys], "_hash").agg(F.count("*").alias(counted))

    on = [*keys, "_hash"]
    return (
        side(left, "left_rows")
        .join(side(right.where(_all_known(keys)), "right_rows"), on, "left")
        .select(
            F.when(_all_known(keys), F.struct(*[F.col(f"`{c}`").alias(c) for c in on])).alias("_row"),
            "left_rows",
            F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
        )
    )


def _all_known(keys: list[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(f"`{k}`").isNotNull()
    return known


def match_ratio(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    columns: list[str] | None = None,
    *,
    bounded: bool = False,
    bucketed: bool = False,
    **options: bool,
) -> DataFrame:
    """Share of left rows found on the right by key and hash, as one row.

    Copies multiply, as in a join, so duplicate keys can lift the ratio above 1;
    ``bounded`` counts each left row at most once. ``matched_rows`` is a whole
    decimal, wide enough for any product of counts. ``options`` go to ``row_hash``.

    ``bucketed`` is for two tables bucketed alike by key columns: together with
    ``spark.sql.requireAllClusterKeysForCoPartition=false`` no row is shuffled.
    """
    n, m = F.col("left_rows"), F.col("right_rows")
    found = F.when(m > 0, n).otherwise(0)
    # Either count is 0 or 1 in all but duplicate groups, whose product may
    # leave the bigint range when one row makes up much of both tables.
    duplicates = F.lit(False) if bounded else (n > 1) & (m > 1)
    wide = F.when(duplicates, n.cast("decimal(19,0)") * m.cast("decimal(19,0)"))
    plain = F.when(~duplicates, found if bounded else n * m)
    totals = _row_counts(left, right, keys, columns, bucketed, **options).agg(
        F.coalesce(F.sum("left_rows"), F.lit(0)).alias("left_rows"),
        (
            F.coalesce(F.sum(plain), F.lit(0)).cast("decimal(38,0)")
            + F.coalesce(F.sum(wide), F.lit(0)).cast("decimal(38,0)")
        ).alias("_matched"),
    )
    matched = F.col("_matched")
    return totals.select(
        F.when(n == 0, F.lit(0.0))
        .otherwise(matched.cast("double") / n.cast("double"))
        .alias("ratio"),
        n,
        matched.alias("matched_rows"),
    )


def row_matches(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    columns: list[str] | None = None,
    *,
    bucketed: bool = False,
    **options: bool,
) -> DataFrame:
    """Per distinct left row with a usable key: its copies and whether it matched."""
    counts = _row_counts(left, right, keys, columns, bucketed, **options)
    return counts.where((F.col("left_rows") > 0) & F.col("_row").isNotNull()).select(
        *[F.col("_row").getField(k).alias(k) for k in keys],
        "left_rows",
        "right_rows",
        (F.col("right_rows") > 0).alias("matched"),
    )

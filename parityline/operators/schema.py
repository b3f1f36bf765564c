"""Comparison of table schemas held as rows.

Schema rows are ``(pair_id, side, name, ordinal, type, type_id)`` with ``side``
being ``left`` or ``right``, so any number of table pairs is one job. ``type`` is
for reading; ``type_id`` decides equality and includes nested nullability.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityline.operators.lookup import left_lookup

SCHEMA_ROWS = "pair_id string, side string, name string, ordinal int, type string, type_id string"


def schema_rows(spark: SparkSession, pair_id: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """Schema rows of one pair of frames, from metadata alone."""
    rows = [
        (pair_id, side, f.name, i, f.dataType.simpleString(), f.dataType.json())
        for side, df in (("left", left), ("right", right))
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, SCHEMA_ROWS)


def compare_schemas(rows: DataFrame) -> DataFrame:
    """Class of every column name of every pair.

    One aggregation on (pair, name) takes the place of a full outer join.
    """
    by_side = {
        side: F.when(F.col("side") == side, F.struct("type", "type_id", "ordinal"))
        for side in ("left", "right")
    }
    both = rows.groupBy("pair_id", "name").agg(
        F.max(by_side["left"]).alias("l"), F.max(by_side["right"]).alias("r")
    )
    # The four class labels.
    return both.select(
        "pair_id",
        "name",
        F.when(F.col("r").isNull(), "df1_only")
        .when(F.col("l").isNull(), "df2_only")
        .when(F.col("l.type_id") == F.col("r.type_id"), "same_types")
        .otherwise("diff_types")
        .alias("class"),
        F.col("l.type").alias("left_type"),
        F.col("r.type").alias("right_type"),
        F.col("l.ordinal").alias("left_ordinal"),
    )


def shared_schema(rows: DataFrame) -> DataFrame:
    """Columns of equal name and type per pair; ``ordinal`` is the left order."""
    return (
        compare_schemas(rows)
        .where(F.col("class") == "same_types")
        .select("pair_id", "name", F.col("left_type").alias("type"),
                F.col("left_ordinal").alias("ordinal"))
    )


def key_presence(
    manifest: DataFrame,
    columns: DataFrame,
    *,
    keys: str = "primary_keys",
    tables: tuple[str, ...] = ("edw_table", "eds_equivalent_table", "eds_base_table"),
) -> DataFrame:
    """Do the key columns exist in all tables of each manifest row?

    ``columns`` holds ``(table_name, column_name)`` for each readable table. An
    empty key list passes even over unreadable tables. Otherwise a table that
    cannot be read, or a null key list, fails the row and marks it broken.
    """
    # A table's column list is as long as the table is wide, never longer.
    known = columns.groupBy("table_name").agg(F.collect_set("column_name").alias("_columns"))
    checked = manifest
    for i, table in enumerate(tables):
        side = known.select(F.col("table_name").alias(table), F.col("_columns").alias(f"_c{i}"))
        checked = left_lookup(checked, side, table)
    found = [F.col(f"_c{i}") for i in range(len(tables))]
    no_keys = F.size(keys) == 0
    missing = F.lit(False)
    complete = F.lit(True)
    for cols in found:
        missing = missing | cols.isNull()
        complete = complete & (F.size(F.array_except(keys, cols)) == 0)
    broken = F.col(keys).isNull() | (~no_keys & missing)
    return checked.select(
        *manifest.columns,
        F.when(broken, False).when(no_keys, True).otherwise(complete).alias("keys_present"),
        broken.alias("broken"),
    )


def broken_tables(checked: DataFrame, table: str = "eds_equivalent_table") -> DataFrame:
    """Published tables whose check could not be made."""
    name = F.col(table)
    return checked.where(F.col("broken") & name.isNotNull() & (name != "")).select(table).distinct()

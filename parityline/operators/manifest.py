"""Validation manifests in batches per schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parityline.functions.hashing import digest
from parityline.operators.ranges import expand_ranges

BATCH_SIZE = 20
_TIE = ("issue_key", "table", "view_table")


def _no_key_last() -> Column:
    return F.when(F.col("primary_keys").isNotNull(), 0).otherwise(1)


def not_replaced_first() -> Column:
    """Sort key inside a batch: tickets known not to be replaced come first."""
    return F.when(F.col("is_table_replaced") == "No", 0).otherwise(1)


def valid_schema() -> Column:
    """Schemas that can be batched: known, and not a piece of a cell of names."""
    schema = F.col("eds_schema")
    return schema.isNotNull() & ~F.contains(schema, F.lit("/"))


def assign_batches(merged: DataFrame, size: int = BATCH_SIZE, tie: tuple[str, ...] = _TIE) -> DataFrame:
    """Number the rows of each schema, keyed ones first, and cut them into batches.

    ``batch_id`` is row number div ``size``, so batch 0 has one row less. Among
    rows with a key, and among those without, the order is that of an MD5 over
    ``tie``. That makes the numbering repeatable, and lets a schema holding most
    rows be numbered by many tasks: counts per (schema, keyed, leading digits)
    give each such slice its first number, and slices are numbered on their own.
    Equal rows are counted before the first shuffle and written out at the end.
    """
    columns = [F.col(f"`{c}`") for c in merged.columns]
    packed = (
        merged.where(valid_schema())
        .groupBy(*columns)
        .agg(F.count("*").alias("_copies"))
        .withColumns({"_flag": _no_key_last(), "_digest": digest(*[F.col(f"`{c}`") for c in tie])})
        .withColumn("_slice", F.left("_digest", F.lit(3)))
    )
    slice_of = ["eds_schema", "_flag", "_slice"]
    # At most 2 x 4096 slices per schema, whatever its number of rows.
    earlier_slices = Window.partitionBy("eds_schema").orderBy("_flag", "_slice")
    starts = (
        packed.groupBy(*slice_of)
        .agg(F.sum("_copies").alias("_rows"))
        .select(*slice_of, (F.sum("_rows").over(earlier_slices) - F.col("_rows")).alias("_start"))
    )
    ordered = [F.col(f"`{c}`") for c in (*tie, *(c for c in merged.columns if c not in tie))]
    in_slice = (
        Window.partitionBy(*slice_of)
        .orderBy("_digest", *ordered)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = packed.withColumn("_upto", F.sum("_copies").over(in_slice)).join(starts, slice_of)
    last = F.col("_start") + F.col("_upto")
    numbered = expand_ranges(
        placed, last - F.col("_copies") + 1, last, "_number", by=["eds_schema"]
    )
    return numbered.select(
        *columns, F.expr(f"cast(_number div {int(size)} as int)").alias("batch_id")
    )


def schema_batches(batched: DataFrame) -> DataFrame:
    """The batches of each schema, with their rows and rows that have a key."""
    return batched.groupBy("eds_schema", "batch_id").agg(
        F.count("*").alias("rows"), F.count("primary_keys").alias("rows_with_key")
    )


def validation_manifest(merged: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Rows to validate: batched, and only those that have a key."""
    return assign_batches(merged, size).where(F.col("primary_keys").isNotNull())


def skipped_schemas(merged: DataFrame) -> DataFrame:
    """How many rows were left out of the batches, and why, as one row."""
    schema = F.col("eds_schema")
    return merged.agg(
        F.count_if(schema.isNull()).alias("null_schema"),
        F.count_if(F.contains(schema, F.lit("/"))).alias("mixed_schema"),
    )


def batch_documents(manifest: DataFrame) -> DataFrame:
    """One JSON array per (schema, batch); nulls are kept as members.

    A group is a batch, so it never holds more rows than the batch size.
    """
    payload = F.struct(*manifest.columns)
    ordered = F.sort_array(F.collect_list(F.struct(not_replaced_first(), *_TIE, payload.alias("_p"))))
    return (
        manifest.groupBy("eds_schema", "batch_id")
        .agg(ordered.alias("_rows"))
        .select(
            "eds_schema",
            "batch_id",
            F.to_json(F.transform("_rows", lambda r: r["_p"]), {"ignoreNullFields": "false"}).alias(
                "document"
            ),
        )
    )

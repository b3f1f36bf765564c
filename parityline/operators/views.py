"""Keys and complexity of views, from their texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.functions.text import (
    columns_named_in,
    first_keyword,
    key_section,
    loosened,
    without_comment_lines,
)

# Fixed value: stem of model files that describe no view.
SOURCES = "sources"


def keys_from_descriptions(docs: DataFrame, *, whole_words: bool = False) -> DataFrame:
    """Key columns named in each model's description; null when none are found.

    ``docs`` has ``path``, ``schema``, ``table``, ``description``, ``columns``.
    """
    described = docs.where(F.col("table") != SOURCES).withColumn(
        "_section", key_section(F.col("description"))
    )
    return described.select(
        "path",
        F.concat_ws(".", "schema", "table").alias("view_table"),
        columns_named_in(F.col("_section"), F.col("columns"), whole_words).alias("view_key_cols"),
    )


def extraction_counts(extracted: DataFrame) -> DataFrame:
    """Models with and without a key, as one row."""
    return extracted.agg(
        F.count("view_key_cols").alias("found"),
        (F.count("*") - F.count("view_key_cols")).alias("not_found"),
    )


def view_keys(extracted: DataFrame) -> DataFrame:
    """The found keys, one row per view; the last path wins among namesakes."""
    found = extracted.where(F.col("view_key_cols").isNotNull())
    return found.groupBy("view_table").agg(
        F.max_by("view_key_cols", "path").alias("view_key_cols")
    )


def view_complexity(views: DataFrame, sql: str = "sql", *, loose: bool = False) -> DataFrame:
    """The first keyword that makes each view more than a plain select, or null."""
    code = without_comment_lines(F.col(sql))
    if loose:
        code = loosened(code)
    others = [c for c in views.columns if c != sql]
    stripped = views.select(*others, code.alias("_code"))
    return stripped.select(*others, first_keyword(F.col("_code"), loose).alias("keyword"))


def complexity_counts(classified: DataFrame) -> DataFrame:
    """All views, and those with a keyword, as one row."""
    return classified.agg(
        F.count("*").alias("views"), F.count("keyword").alias("non_select_views")
    )

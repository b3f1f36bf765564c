"""Key configs, view models and view definitions: one document per file."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: name given to a config entry that has none.
NO_TABLE = "NO TABLE"


def _plain_path(path: Column) -> Column:
    """Local paths without their scheme, so listed and found paths compare."""
    return F.regexp_replace(path, "^file:/+", "/")


def literal_path(path: str) -> str:
    """A path meant as it is: what a glob would read is escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_documents(
    spark: SparkSession,
    paths: str | list[str] | None = None,
    only: DataFrame | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Whole files as ``(path, content)``.

    ``paths`` may be files, folders or globs, of which ``pattern`` (a glob over file
    names) keeps some. ``only`` names the files in its ``path`` column instead; these
    alone are opened, and one that is missing is an error. A list is a few bytes a
    file and is read by the driver, which has to list files in any case.
    """
    options = {"pathGlobFilter": pattern} if pattern else {}
    if only is not None:
        listed = [r["path"] for r in only.select("path").distinct().collect()]
        paths = [literal_path(p) for p in listed]
        if not paths:
            return spark.createDataFrame([], "path string, content string")
    found = spark.read.text(paths, wholetext=True, recursiveFileLookup=True, **options)
    # Spark reports paths as URIs, in which a plus sign stands for itself.
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return found.select(_plain_path(path).alias("path"), F.col("value").alias("content"))


def listed_paths(spark: SparkSession, list_files: str | list[str], base: str = "") -> DataFrame:
    """Paths from files that list one per line, below ``base``, for ``only``."""
    line = F.trim("value")
    path = _plain_path(F.concat(F.lit(base), line))
    return spark.read.text(list_files).where(line != "").select(path.alias("path"))


def _yaml_as_json(content: str) -> Column:
    """YAML text as JSON text; the only step that needs Python."""

    # A local function travels to the executors with the plan.
    def convert(texts: pd.Series) -> pd.Series:
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading YAML needs PyYAML on the executors") from error
        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
        return texts.map(
            lambda text: json.dumps(yaml.load(text, Loader=loader), default=str, ensure_ascii=False),
            na_action="ignore",
        )

    return F.pandas_udf(convert, StringType())(content)


_FAIL = {"mode": "FAILFAST"}


def _key_list(raw: Column) -> Column:
    """Keys given as a list, as a mapping with ``snapshots``, or not at all.

    A mapping without ``snapshots`` is an error, as is a list of anything but values.
    """
    snapshots = F.from_json(raw, "struct<snapshots: array<string>>", _FAIL)["snapshots"]
    lost = F.raise_error(F.concat(F.lit("key_columns without snapshots: "), raw))
    return (
        F.when(F.startswith(raw, F.lit("[")), F.from_json(raw, "array<string>", _FAIL))
        .when(F.startswith(raw, F.lit("{")), F.coalesce(snapshots, lost.cast("array<string>")))
        .otherwise(F.array().cast("array<string>"))
    )


def ingestion_keys(docs: DataFrame) -> DataFrame:
    """``(table, key_cols)`` of every config entry but the first of each file.

    A missing key list gives an empty array: configured, but without a key. A file
    whose entries are not all mappings is an error, not a file without entries.
    """
    parsed = docs.select(
        F.from_json(
            _yaml_as_json("content"), "struct<configurations: array<map<string, string>>>", _FAIL
        )["configurations"].alias("_entries")
    )
    entries = parsed.select(F.explode(F.filter("_entries", lambda _, i: i > 0)).alias("_entry"))
    raw = F.try_element_at("_entry", F.lit("key_columns"))
    named = F.map_contains_key("_entry", "target_table")
    return entries.select(
        F.when(named, F.try_element_at("_entry", F.lit("target_table")))
        .otherwise(NO_TABLE)
        .alias("table"),
        _key_list(raw).alias("key_cols"),
    )


def view_keys(docs: DataFrame) -> DataFrame:
    """``(view_table, view_key_cols)`` from JSON objects of lists.

    A member given twice in one file counts once, with its last list. An object
    is parsed as a whole, so large inventories belong into several files, or into
    the lines of ``write_view_keys``.
    """
    members = docs.select(
        "path",
        F.posexplode(
            F.from_json("content", "map<string, array<string>>", {"mode": "FAILFAST"})
        ).alias("_at", "view_table", "_keys"),
    )
    return (
        members.groupBy("path", "view_table")
        .agg(F.max_by("_keys", "_at").alias("view_key_cols"))
        .select("view_table", "view_key_cols")
    )


def load_view_keys(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """View keys from files; no such file gives no rows, in the same columns."""
    try:
        return view_keys(read_documents(spark, paths))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "view_table string, view_key_cols array<string>")


def view_models(docs: DataFrame) -> DataFrame:
    """``(path, schema, table, description, columns)`` of each view model file.

    Schema and table are the third-last and last path segments up to a dot. Columns
    that are not mappings with a name are an error.
    """
    model = F.get(
        F.from_json(
            _yaml_as_json("content"),
            "struct<models: array<struct<description: string, columns: array<struct<name: string>>>>>",
            _FAIL,
        )["models"],
        F.lit(0),
    )
    segments = F.split("path", "/")

    def stem(position: int) -> Column:
        return F.substring_index(F.try_element_at(segments, F.lit(position)), ".", 1)

    return docs.select(
        "path", stem(-3).alias("schema"), stem(-1).alias("table"), model.alias("_model")
    ).select(
        "path",
        "schema",
        "table",
        F.coalesce("_model.description", F.lit("")).alias("description"),
        F.col("_model.columns.name").alias("columns"),
    )


def view_texts(spark: SparkSession, list_files: str | list[str], base: str = "") -> DataFrame:
    """``(path, sql_text)`` of the view definitions that the files list, for ``view_complexity``."""
    docs = read_documents(spark, only=listed_paths(spark, list_files, base))
    return docs.withColumnRenamed("content", "sql_text")

"""Manifest and view-key files."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityline.operators.manifest import batch_documents, not_replaced_first
from parityline.sinks.folders import mounted, partitions, read_texts, write_texts
from parityline.sources.documents import literal_path

_DYNAMIC = ("partitionOverwriteMode", "dynamic")
_PLACE = "eds_schema string, batch_id int, document string"


def _gone(documents: DataFrame, path: str, place: str | None) -> DataFrame:
    """Empty documents for the batches in ``path`` that their schema no longer has."""
    spark = documents.sparkSession
    mine = documents.select("eds_schema", "batch_id").distinct()
    if place is not None:
        there = partitions(mine, place, "eds_schema", "batch_id")
        return there.join(mine, ["eds_schema", "batch_id"], "left_anti").withColumn("document", F.lit("[]"))
    try:
        # Only the folders' names are read.
        there = spark.read.schema("document string, eds_schema string, batch_id int").text(path)
        there = there.select("eds_schema", "batch_id").distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _PLACE)
    there = there.join(mine.select("eds_schema").distinct(), "eds_schema", "left_semi")
    there = there.join(mine, ["eds_schema", "batch_id"], "left_anti")
    return there.withColumn("document", F.lit("[]"))


def write_manifest(manifest: DataFrame, path: str, *, whole: bool = False) -> None:
    """One JSON array file per (schema, batch), of all schemas at once.

    The batches of the manifest's schemas are replaced and those of other schemas stay, so
    one schema can be run again; a batch that its schema no longer has becomes an empty
    list. With ``whole`` the manifest is all there is afterwards.
    """
    documents = batch_documents(manifest).select("eds_schema", "batch_id", "document")
    place = mounted(manifest.sparkSession, path)
    if not whole:
        documents = documents.unionByName(_gone(documents, path, place))
    if place is not None:
        write_texts(documents, place, ("eds_schema", "batch_id"), "document", whole=whole)
        return
    writer = documents.write.mode("overwrite").partitionBy("eds_schema", "batch_id")
    (writer if whole else writer.option(*_DYNAMIC)).text(path)


def write_manifest_lines(manifest: DataFrame, path: str, *, whole: bool = False) -> None:
    """One row per JSON line, a folder per schema: few files for many batches.

    The schema is also kept inside each line; batches come in their order. The folders of
    the manifest's schemas are replaced and others stay, unless ``whole`` is set.
    """
    rows = manifest.withColumn("schema", F.col("eds_schema")).sortWithinPartitions(
        "schema", "batch_id", not_replaced_first()
    )
    writer = rows.write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("schema")
    (writer if whole else writer.option(*_DYNAMIC)).json(path)


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the files of ``write_manifest``; ``schema`` is a row's DDL."""
    place = mounted(spark, path)
    if place is not None and os.path.isdir(place) and literal_path(path) == path:
        texts = read_texts(spark, place)
    else:
        texts = spark.read.text(path, wholetext=True)
    return texts.select(F.inline(F.from_json("value", f"array<struct<{schema}>>")))


def write_view_keys(keys: DataFrame, path: str) -> None:
    """JSON objects of one view each, as lines, for ``read_view_keys``."""
    keys.select("view_table", "view_key_cols").write.mode("overwrite").json(path)


def read_view_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys written by ``write_view_keys``."""
    return spark.read.schema("view_table string, view_key_cols array<string>").json(path)

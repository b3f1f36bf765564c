"""Ticket exports."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from parityline.functions.names import schema_part
from parityline.sources.documents import literal_path

# Export headers and the names used here.
EXPORT_COLUMNS = {
    "Custom field (EDW table)": "edw_table",
    "Custom field (EDS equivalent table)": "eds_equivalent_table",
    "Status": "status",
    "Custom field (EDW table replaced with external table?)": "is_table_replaced",
    "Issue key": "issue_key",
}


def project_tickets(export: DataFrame) -> DataFrame:
    """The five ticket columns under short names, and the target schema."""
    return export.select(
        *[F.col(f"`{header}`").alias(name) for header, name in EXPORT_COLUMNS.items()],
        schema_part(F.col("eds_equivalent_table")).alias("eds_schema"),
    )


def load_tickets(
    spark: SparkSession, path: str | list[str], *, multi_line: bool = True, **options: str
) -> DataFrame:
    """Read CSV exports by header, all columns as text.

    Types are not inferred, which would read everything twice. Quoted line
    breaks are kept whole, so the unit of parallel reading is a file; with
    ``multi_line=False`` large files are split, which is safe only when no field
    has a line break. Each file is read by its own header, whatever the order of its
    columns; files with equal headers are read together. One job looks at the first line of
    all files, so there is a look at a header for each kind of export, not for each file.
    """
    reader = spark.read.options(header=True, multiLine=multi_line, escape='"', **options)
    try:
        files = spark.read.text(path).inputFiles()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(str(path)) from error
        raise
    groups = _alike(spark, reader, files) if files else []
    if not groups:
        raise FileNotFoundError(f"{path} holds no export")
    parts = [project_tickets(reader.csv(group)) for group in groups]
    return reduce(DataFrame.unionAll, parts)


def _alike(spark: SparkSession, reader: DataFrameReader, files: list[str]) -> list[list[str]]:
    """The files in groups of equal headers; a file without lines is left out."""
    paths = sorted(literal_path(unquote(f)) for f in files)  # they come as addresses
    lines = spark.read.text(paths).select(
        F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("path"),
        F.struct(F.monotonically_increasing_id().alias("at"), "value").alias("line"),
    )
    alike: dict[str, list[str]] = {}
    for row in lines.groupBy("path").agg(F.min("line")["value"].alias("first")).sort("path").collect():
        # A header that goes on in the next line is known by its columns only.
        file = literal_path(row["path"])
        whole = row["first"].count('"') % 2 == 0
        key = row["first"] if whole else repr(reader.csv(file).columns)
        alike.setdefault(key, []).append(file)
    return list(alike.values())

"""Tables by name, and their columns as rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SESSION_CATALOG = "spark_catalog"
COLUMN_ROWS = "table_name string, column_name string, ordinal int, type string, type_id string"


def quoted(name: str) -> str:
    """A dotted name with each of its parts quoted."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def resolve(
    spark: SparkSession, name: str | None, known: Mapping[str, DataFrame] | None = None
) -> DataFrame | None:
    """The named table, from ``known`` or the catalog; None if it cannot be read.

    Whatever keeps a table from being read, a missing name or a failing store, makes
    that one table unreadable and does not end the others' check.
    """
    if known and name in known:
        return known[name]
    if not name:
        return None
    try:
        table = spark.table(name)
        table.schema  # resolves the name now also under a lazy client
        return table
    except Exception:  # noqa: BLE001
        return None


def table_columns(
    spark: SparkSession, name: str, columns: list[str], known: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The named columns of a table."""
    source = known[name] if known and name in known else spark.table(name)
    return source.select(*[f"`{c}`" for c in columns])


def column_rows(
    spark: SparkSession, names: Iterable[str], known: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Columns of the given tables; a table that cannot be read has no rows.

    Meant for the tables of a batch or two, as every name is a catalog call. For a whole
    manifest see ``catalog_columns`` and ``read_columns``.
    """
    rows = []
    for name in dict.fromkeys(names):
        table = resolve(spark, name, known)
        if table is not None:
            rows += [
                (name, f.name, i, f.dataType.simpleString(), f.dataType.json())
                for i, f in enumerate(table.schema.fields, 1)
            ]
    return spark.createDataFrame(rows, COLUMN_ROWS)


def batch_columns(
    batch: DataFrame,
    known: Mapping[str, DataFrame] | None = None,
    tables: tuple[str, ...] = ("edw_table", "eds_equivalent_table", "eds_base_table"),
    size: int = 20,
) -> DataFrame:
    """``column_rows`` of the tables that one batch of the manifest names.

    A batch has at most ``size`` rows by its making; a larger frame is an error, so
    that no more than a batch's names reach the driver.
    """
    rows = batch.select(*tables).take(size + 1)
    if len(rows) > size:
        raise ValueError(f"a batch has at most {size} rows; filter the manifest by schema and batch_id")
    names = [r[t] for r in rows for t in tables if r[t]]
    return column_rows(batch.sparkSession, names, known)


def schema_of(name: str | Column) -> Column:
    """The schema of a table's full name: all but its last part."""
    return F.regexp_extract(name, r"^(.*)\.[^.]*$", 1)


def manifest_schemas(
    manifest: DataFrame,
    tables: tuple[str, ...] = ("edw_table", "eds_equivalent_table", "eds_base_table"),
) -> DataFrame:
    """(table_schema): the schemas of all tables that a manifest names."""
    names = manifest.select(F.explode(F.array(*[F.col(f"`{t}`") for t in tables])).alias("_name"))
    return names.select(schema_of("_name").alias("table_schema")).where("table_schema <> ''").distinct()


def _names(schemas: DataFrame, limit: int) -> list[str]:
    """The schemas' names, which the driver may hold up to ``limit`` of."""
    names = [r[0] for r in schemas.select("table_schema").where("table_schema <> ''").distinct().take(limit + 1)]
    if len(names) > limit:
        raise ValueError(f"more than {limit} schemas; list them in parts")
    return sorted(names)


def catalog_columns(spark: SparkSession, schemas: DataFrame, limit: int = 10_000) -> DataFrame:
    """(table_schema, table_name, column_name, ordinal, type) of all tables of the schemas.

    One listing a schema, which the catalog answers at once, however many tables it has; a
    schema that cannot be listed has no rows. Its texts are taken apart by the executors.
    Types are given as far as the listing tells them. More than ``limit`` schemas are an
    error.
    """
    found = spark.createDataFrame([], "table_schema string, name string, information string")
    for name in _names(schemas, limit):
        try:
            listed = spark.sql(f"SHOW TABLE EXTENDED IN {quoted(name)} LIKE '*'")
        except AnalysisException:
            continue
        listed = listed.where("not isTemporary").select(
            F.lit(name).alias("table_schema"), F.col("tableName").alias("name"), "information"
        )
        found = found.unionAll(listed)
    # The tree of a schema; what lies inside a column is further in.
    tree = F.substring_index("information", "\nSchema: root\n", -1)
    line = F.lit(r"(?m)^ \|-- (.*): [^:]* \(nullable = (?:true|false)\)$")
    kind = F.lit(r"(?m)^ \|-- .*: ([^:]*) \(nullable = (?:true|false)\)$")
    pairs = F.arrays_zip(F.regexp_extract_all(tree, line, F.lit(1)), F.regexp_extract_all(tree, kind, F.lit(1)))
    columns = found.select("table_schema", "name", F.posexplode(pairs).alias("_at", "_column"))
    return columns.select(
        "table_schema",
        F.concat_ws(".", "table_schema", "name").alias("table_name"),
        F.col("_column")["0"].alias("column_name"),
        (F.col("_at") + 1).alias("ordinal"),
        F.col("_column")["1"].alias("type"),
    )


def write_columns(columns: DataFrame, path: str) -> None:
    """Keep a column listing, a folder per schema; listings of other schemas stay.

    ``columns`` has at least (table_name, column_name); the schema is that of the name.
    """
    rows = columns.withColumn("table_schema", schema_of("table_name")).repartition("table_schema", "table_name")
    writer = rows.sortWithinPartitions("table_schema", "table_name").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("table_schema").parquet(path)


def read_columns(
    spark: SparkSession, path: str, schemas: DataFrame | None = None, limit: int = 10_000
) -> DataFrame:
    """A kept column listing, of which only the folders of ``schemas`` are read.

    ``schemas`` may hold any number of names, of which the executors find those that have a
    folder. Up to ``limit`` of these are named in the read; of more, a join picks the rows.
    """
    rows = spark.read.parquet(path)
    if schemas is None:
        return rows
    # Only the folders' names are needed: without its content no file is opened.
    folders = spark.read.format("binaryFile").load(path).select("table_schema").distinct()
    asked = schemas.select("table_schema").where("table_schema <> ''")
    there = asked.join(folders, "table_schema", "left_semi").distinct()
    names = [r[0] for r in there.take(limit + 1)]
    if len(names) > limit:
        return rows.join(there, "table_schema", "left_semi").select(*rows.columns)
    return rows.where(F.col("table_schema").isin(sorted(names)))

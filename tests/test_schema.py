import pytest
from conftest import rows
from pyspark.sql import functions as F

from parityline.operators.schema import (
    broken_tables,
    compare_schemas,
    key_presence,
    schema_rows,
    shared_schema,
)
from parityline.sources.catalog import (
    catalog_columns,
    column_rows,
    manifest_schemas,
    read_columns,
    resolve,
    table_columns,
    write_columns,
)


def test_classes_of_two_pairs_in_one_job(spark):
    a = spark.createDataFrame([], "id int, grade int, old string, tags array<string>")
    b = spark.createDataFrame([], "tags array<string>, id int, grade string, new date")
    both = schema_rows(spark, "p", a, b).union(schema_rows(spark, "q", a, a))
    got = compare_schemas(both)
    assert rows(got.where("pair_id = 'p'"), "name", "class", "left_type", "right_type") == [
        ("grade", "diff_types", "int", "string"),
        ("id", "same_types", "int", "int"),
        ("new", "df2_only", None, "date"),
        ("old", "df1_only", "string", None),
        ("tags", "same_types", "array<string>", "array<string>"),
    ]
    assert got.where("pair_id = 'q' and class <> 'same_types'").count() == 0
    assert rows(shared_schema(both).where("pair_id = 'p'")) == [
        ("p", "id", "int", 1),
        ("p", "tags", "array<string>", 4),
    ]


def test_nested_nullability_makes_types_differ(spark):
    a = spark.range(1).select(F.array(F.lit("x")).alias("v"))
    b = spark.createDataFrame([(["x"],)], "v array<string>")
    assert rows(compare_schemas(schema_rows(spark, "p", a, b)), "class") == [("diff_types",)]


def test_names_are_case_sensitive(spark):
    a = spark.createDataFrame([], "Id int")
    b = spark.createDataFrame([], "id int")
    assert rows(compare_schemas(schema_rows(spark, "p", a, b)), "name", "class") == [
        ("Id", "df1_only"),
        ("id", "df2_only"),
    ]


def test_key_presence(spark):
    known = {
        name: spark.createDataFrame([], "id int, ts date")
        for name in ("w.s.a", "p.s.a_vw", "p.b.a")
    } | {"p.b.short": spark.createDataFrame([], "id int")}
    names = [*known, "p.none.x", None, "gone"]
    columns = column_rows(spark, names, known)
    manifest = spark.createDataFrame(
        [
            ("all", "w.s.a", "p.s.a_vw", "p.b.a", ["id", "ts"]),
            ("dup", "w.s.a", "p.s.a_vw", "p.b.a", ["id", "id"]),
            ("absent", "w.s.a", "p.s.a_vw", "p.b.short", ["id", "ts"]),
            ("unread", "w.s.a", "p.none.x", "p.b.a", ["id"]),
            ("nullname", "w.s.a", None, "p.b.a", ["id"]),
            ("empty", "gone", "gone", "gone", []),
            ("nokeys", "w.s.a", "p.s.a_vw", "p.b.a", None),
        ],
        "t string, edw_table string, eds_equivalent_table string, eds_base_table string, "
        "primary_keys array<string>",
    )
    got = key_presence(manifest, columns)
    assert got.columns == [*manifest.columns, "keys_present", "broken"]
    assert {r[0]: r[1:] for r in rows(got, "t", "keys_present", "broken")} == {
        "all": (True, False),
        "dup": (True, False),
        "absent": (False, False),
        "unread": (False, True),
        "nullname": (False, True),
        "empty": (True, False),
        "nokeys": (False, True),
    }
    assert rows(broken_tables(got)) == [("p.none.x",), ("p.s.a_vw",)]


def test_catalog_tables_resolve_by_name(spark):
    spark.range(3).withColumn("v", F.lit("x")).createOrReplaceTempView("known_table")
    assert resolve(spark, "known_table").count() == 3
    assert resolve(spark, "no.such.table") is None
    assert table_columns(spark, "known_table", ["v"]).columns == ["v"]
    assert rows(column_rows(spark, ["known_table", "missing"]), "column_name", "type") == [
        ("id", "bigint"),
        ("v", "string"),
    ]


class Denied:
    """A table whose store refuses."""

    @property
    def schema(self):
        raise PermissionError("denied")


def test_batch_of_the_manifest(spark, monkeypatch):
    from parityline.sources.catalog import batch_columns

    spark.range(3).toDF("k").createOrReplaceTempView("good_table")
    table = spark.table
    monkeypatch.setattr(type(spark), "table", lambda self, n: Denied() if n == "denied" else table(n))
    schema = "edw_table string, eds_equivalent_table string, eds_base_table string, primary_keys array<string>"
    batch = spark.createDataFrame(
        [("good_table", "good_table", "good_table", ["k"]), ("good_table", "denied", None, ["k"])], schema
    )
    columns = batch_columns(batch)
    assert rows(columns, "table_name", "column_name") == [("good_table", "k")]
    got = key_presence(batch, columns)
    assert rows(got, "eds_equivalent_table", "keys_present", "broken") == [
        ("denied", False, True), ("good_table", True, False)
    ]
    with pytest.raises(ValueError, match="at most 1"):
        batch_columns(batch, size=1)
    spark.catalog.dropTempView("good_table")


def test_listing_of_the_catalog_by_schemas(spark):
    """One listing a schema, for tables of any columns."""
    for name in ("list_a", "list_b", "list_c"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.range(2).selectExpr(
        "id", "'x' as `a: b (nullable = true)`", "named_struct('p', id, 'q', array(1)) as s", "map(1, 'x') as m",
        "cast(1 as decimal(9, 2)) as d",
    ).write.mode("overwrite").saveAsTable("list_a.wide")
    spark.range(2).write.mode("overwrite").saveAsTable("list_a.narrow")
    spark.range(2).toDF("k").write.mode("overwrite").saveAsTable("list_b.t")
    spark.range(2).toDF("k").write.mode("overwrite").saveAsTable("list_c.not_asked")
    manifest = spark.createDataFrame(
        [
            ("list_a.wide", "list_b.t", "list_a.narrow", ["id"]),
            ("list_a.wide", "list_a.narrow", "list_a.wide", ["id"]),
            ("list_a.wide", "no_such.t", None, ["id"]),
        ],
        "edw_table string, eds_equivalent_table string, eds_base_table string, primary_keys array<string>",
    )
    schemas = manifest_schemas(manifest)
    assert rows(schemas) == [("list_a",), ("list_b",), ("no_such",)]
    columns = catalog_columns(spark, schemas)
    assert rows(columns, "table_name", "column_name", "ordinal") == [
        ("list_a.narrow", "id", 1), ("list_a.wide", "a: b (nullable = true)", 2), ("list_a.wide", "d", 5),
        ("list_a.wide", "id", 1), ("list_a.wide", "m", 4), ("list_a.wide", "s", 3), ("list_b.t", "k", 1),
    ]
    one_by_one = column_rows(spark, ["list_a.wide", "list_a.narrow", "list_b.t"])
    assert rows(columns, "table_name", "column_name", "ordinal") == rows(one_by_one, "table_name", "column_name", "ordinal")
    got = key_presence(manifest, columns)
    assert rows(got, "eds_equivalent_table", "keys_present", "broken") == [
        ("list_a.narrow", True, False), ("list_b.t", False, False), ("no_such.t", False, True)
    ]
    with pytest.raises(ValueError, match="more than 2"):
        catalog_columns(spark, schemas, limit=2)
    for name in ("list_a", "list_b", "list_c"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_kept_listing_is_read_by_schemas(spark, tmp_path):
    path = str(tmp_path / "columns")
    tables = [("p.gold.a", "id"), ("p.gold.a", "ts"), ("p.silver.b", "id"), ("q.gold.c", "k")]
    write_columns(spark.createDataFrame(tables, "table_name string, column_name string"), path)
    assert sorted(f.name for f in (tmp_path / "columns").glob("table_schema=*")) == [
        "table_schema=p.gold", "table_schema=p.silver", "table_schema=q.gold"
    ]
    assert rows(read_columns(spark, path), "table_name", "column_name") == tables
    gold = spark.createDataFrame([("p.gold",), ("p.gold",), (None,), ("none",)], "table_schema string")
    found = read_columns(spark, path, gold)
    assert rows(found, "table_name", "column_name") == tables[:2]
    assert len(found.inputFiles()) >= 1
    # Other folders are not opened.
    for file in (tmp_path / "columns/table_schema=p.silver").glob("part-*"):
        file.write_bytes(b"broken" * 100)
    assert rows(found, "table_name", "column_name") == tables[:2]
    # A schema that is listed again replaces its own folder only.
    write_columns(spark.createDataFrame([("q.gold.d", "k")], "table_name string, column_name string"), path)
    again = read_columns(spark, path, spark.createDataFrame([("p.gold",), ("q.gold",)], "table_schema string"))
    assert rows(again, "table_name", "column_name") == [*tables[:2], ("q.gold.d", "k")]


def test_kept_listing_is_read_for_any_number_of_schemas(spark, tmp_path):
    """Names without a folder are no matter of the driver; folders beyond the limit are joined."""
    path = str(tmp_path / "columns")
    tables = [(f"p.s{i}.t", c) for i in range(6) for c in ("id", "ts")]
    write_columns(spark.createDataFrame(tables, "table_name string, column_name string"), path)
    odd = spark.range(50).select(F.concat(F.lit("p.s1.x_"), "id", F.lit("/ p.s2")).alias("table_schema"))
    few = odd.union(spark.createDataFrame([("p.s1",), ("p.s4",), ("p.s4",), (None,), ("",)], "table_schema string"))
    found = read_columns(spark, path, few, limit=2)
    assert rows(found, "table_name", "column_name") == [t for t in tables if t[0] in ("p.s1.t", "p.s4.t")]
    # Other folders are not opened.
    for file in (tmp_path / "columns/table_schema=p.s5").glob("part-*"):
        file.write_bytes(b"broken" * 100)
    assert rows(found, "table_name", "column_name") == [t for t in tables if t[0] in ("p.s1.t", "p.s4.t")]
    more = few.union(spark.createDataFrame([("p.s0",)], "table_schema string"))
    write_columns(spark.createDataFrame(tables[10:], "table_name string, column_name string"), path)
    found = read_columns(spark, path, more, limit=2)
    assert found.columns == read_columns(spark, path).columns
    assert rows(found, "table_name", "column_name") == [t for t in tables if t[0] in ("p.s0.t", "p.s1.t", "p.s4.t")]
    assert rows(read_columns(spark, path, odd, limit=2)) == []

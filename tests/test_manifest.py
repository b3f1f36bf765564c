import hashlib
import json
from collections import Counter
from itertools import groupby

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parityline.operators.manifest import (
    assign_batches,
    batch_documents,
    schema_batches,
    skipped_schemas,
    validation_manifest,
)
from parityline.sinks.manifest import (
    read_manifest,
    read_view_keys,
    write_manifest,
    write_manifest_lines,
    write_view_keys,
)

SCHEMA = (
    "eds_schema string, is_table_replaced string, issue_key string, table string, "
    "view_table string, primary_keys array<string>"
)


def ticket(schema, key, keyed=True, replaced="No", table="t", view=None):
    return (schema, replaced, key, table, view, ["id"] if keyed else None)


def expected_batches(data, size=20):
    """Brute force: sort each schema by (keyed first, MD5), number from 1."""
    out = Counter()
    usable = [r for r in data if r[0] is not None and "/" not in r[0]]

    def order(r):
        text = "|".join(x for x in r[2:5] if x is not None)
        return (r[0], r[5] is None, hashlib.md5(text.encode()).hexdigest(), repr(r))

    for _, group in groupby(sorted(usable, key=order), key=lambda r: r[0]):
        for n, r in enumerate(group, 1):
            out[(*r[:5], n // size)] += 1
    return out


def got_batches(df):
    names = ["eds_schema", "is_table_replaced", "issue_key", "table", "view_table", "batch_id"]
    return Counter(tuple(r) for r in df.select(*names).collect())


@pytest.fixture(scope="module")
def data():
    some = [ticket("gold", f"T-{i}", keyed=i % 4 != 0, replaced="No" if i % 3 else "not_updated") for i in range(73)]
    some += [ticket("silver", f"S-{i}", view=f"v{i % 5}" if i % 2 else None) for i in range(150)]
    some += [ticket("bi", "B-1", keyed=False)]
    some += [ticket(None, "N-1"), ticket("silver/ prod", "M-1"), ticket("silver/ prod", "M-2")]
    return some


def test_batches_equal_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    assert got_batches(assign_batches(df)) == expected_batches(data)
    assert got_batches(assign_batches(df, size=7)) == expected_batches(data, 7)
    assert tuple(skipped_schemas(df).first()) == (1, 2)


def test_first_batch_is_one_short(spark, data):
    batched = assign_batches(spark.createDataFrame(data, SCHEMA))
    sizes = rows(schema_batches(batched).where("eds_schema = 'silver'"), "batch_id", "rows")
    assert sizes == [(0, 19)] + [(i, 20) for i in range(1, 7)] + [(7, 11)]
    assert rows(schema_batches(batched).where("eds_schema = 'bi'")) == [("bi", 0, 1, 0)]


def test_copies_keep_their_number(spark):
    """A group of copies makes up most rows; none may be lost or merged."""
    data = [ticket("gold", "T-1")] * 2345 + [ticket("gold", f"T-{i}", keyed=i % 2 == 0) for i in range(2, 40)]
    batched = assign_batches(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert got_batches(batched) == expected_batches(data)


def test_hot_schema_is_numbered_by_many_tasks(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "gold").otherwise(F.concat(F.lit("s"), F.col("id") % 900)).alias("eds_schema"),
        F.lit("No").alias("is_table_replaced"),
        F.col("id").cast("string").alias("issue_key"),
        F.lit(None).cast("string").alias("table"),
        F.lit(None).cast("string").alias("view_table"),
        F.array(F.lit("id")).alias("primary_keys"),
    )
    batched = assign_batches(df)
    sizes = rows(schema_batches(batched).where("eds_schema = 'gold'"), "batch_id", "rows")
    assert sorted(sizes) == [(0, 19)] + [(i, 20) for i in range(1, 500)] + [(500, 1)]
    # One window runs inside a slice of a schema, the other over its slice counts.
    plan = batched._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2
    assert sum("_slice" in w.split("windowspecdefinition(")[1].split("ASC")[0] for w in windows) == 1


def test_documents_keep_nulls_and_order(spark, data):
    manifest = validation_manifest(spark.createDataFrame(data, SCHEMA))
    docs = {(r[0], r[1]): json.loads(r[2]) for r in batch_documents(manifest).collect()}
    assert sum(map(len, docs.values())) == 150 + 54
    assert ("bi", 0) not in docs
    first = docs["gold", 0]
    assert len(first) == 19
    assert [r["is_table_replaced"] for r in first] == sorted(
        (r["is_table_replaced"] for r in first), key=lambda v: v != "No"
    )
    assert first[0]["view_table"] is None and first[0]["batch_id"] == 0


def test_manifest_files(spark, data, tmp_path):
    manifest = validation_manifest(spark.createDataFrame(data, SCHEMA))
    for _ in range(2):  # the second run replaces the first
        write_manifest(manifest, str(tmp_path / "m"))
    files = sorted((tmp_path / "m").rglob("part-*"))
    assert len(files) == schema_batches(manifest).count()
    assert {f.parent.relative_to(tmp_path / "m").as_posix() for f in files} >= {
        "eds_schema=gold/batch_id=0",
        "eds_schema=silver/batch_id=7",
    }
    assert all(isinstance(json.loads(f.read_text()), list) for f in files)
    back = read_manifest(spark, str(tmp_path / "m"), SCHEMA + ", batch_id int")
    assert rows(back, *manifest.columns) == rows(manifest)


def test_one_schema_is_written_again(spark, data, tmp_path):
    """Its batches are replaced, those it has no more are empty, other schemas' files stay."""
    path = str(tmp_path / "m")
    manifest = validation_manifest(spark.createDataFrame(data, SCHEMA))
    write_manifest(manifest, path)
    kept = {f: f.stat().st_mtime_ns for f in (tmp_path / "m/eds_schema=gold").rglob("part-*")}
    fewer = [r for r in data if r[0] == "silver"][:50] + [ticket("new", "X-1")]
    again = validation_manifest(spark.createDataFrame(fewer, SCHEMA))
    write_manifest(again, path)
    assert kept == {f: f.stat().st_mtime_ns for f in (tmp_path / "m/eds_schema=gold").rglob("part-*")}
    back = read_manifest(spark, path, SCHEMA + ", batch_id int")
    gold = rows(manifest.where("eds_schema = 'gold'"), *manifest.columns)
    assert rows(back, *manifest.columns) == sorted(gold + rows(again), key=repr)
    empty = list((tmp_path / "m/eds_schema=silver/batch_id=7").glob("part-*"))
    assert [json.loads(f.read_text()) for f in empty] == [[]]
    write_manifest(again, path, whole=True)
    assert not (tmp_path / "m/eds_schema=gold").exists()
    assert rows(read_manifest(spark, path, SCHEMA + ", batch_id int"), *manifest.columns) == rows(again)


def test_lines_of_one_schema_are_written_again(spark, data, tmp_path):
    path = str(tmp_path / "l")
    manifest = validation_manifest(spark.createDataFrame(data, SCHEMA))
    write_manifest_lines(manifest, path)
    write_manifest_lines(manifest.where("eds_schema = 'silver' and batch_id < 2"), path)
    found = spark.read.json(path).groupBy("eds_schema").count()
    assert rows(found) == [("gold", 54), ("silver", 39)]


def test_manifest_lines(spark, data, tmp_path):
    manifest = validation_manifest(spark.createDataFrame(data, SCHEMA))
    write_manifest_lines(manifest, str(tmp_path / "l"))
    lines = [json.loads(x) for f in (tmp_path / "l/schema=gold").glob("part-*") for x in f.read_text().splitlines()]
    assert len(lines) == 54
    assert {"eds_schema", "batch_id", "view_table"} <= set(lines[0])


def test_view_key_files(spark, tmp_path):
    keys = spark.createDataFrame([("s.a", ["x", "y"]), ("s.b", [])], "view_table string, view_key_cols array<string>")
    write_view_keys(keys, str(tmp_path / "k"))
    assert rows(read_view_keys(spark, str(tmp_path / "k"))) == rows(keys)


def test_batches_do_not_depend_on_the_input_partitioning(spark, data):
    df = spark.createDataFrame(data * 3, SCHEMA)
    one, many = (rows(assign_batches(x)) for x in (df.coalesce(1), df.repartition(7)))
    assert one == many

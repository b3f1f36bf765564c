"""Every registered query against its SQL, and the whole inventory run."""

import json
import math
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as contract
from parityline.plans.bindings import view
from parityline.plans.inventory import run_inventory
from parityline.session import CHECKPOINT_DIR, discard_written, shared_dir, written

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
MORE = contract.training_data.queries() if contract.training_data else {}
QUERIES = {k: q for k, q in contract.queries().items() if k not in MORE and k != "pipeline"}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value.item() if hasattr(value, "item") else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(contract.oracle_sql()) - set(MORE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(contract.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    expected = [tuple(map(plain, r)) for r in want[columns].astype(object).itertuples(index=False)]
    assert rows(got, *columns) == sorted(expected, key=repr)


def test_entry(spark):
    assert contract.entry(spark).columns == ["ratio", "left_rows", "matched_rows"]


def test_whole_run(spark, tmp_path):
    inputs = (
        contract._tickets(spark, SF),
        contract._ingestion_keys(spark, SF),
        contract._view_keys(spark, SF),
    )
    reports = run_inventory(*inputs, str(tmp_path / "out"), "legacy.src_")
    run_inventory(*inputs, str(tmp_path / "lines"), "legacy.src_", lines=True)
    funnel, coverage = reports["funnel"].first(), reports["coverage"].first()
    assert funnel.total == view(spark, SF, "tickets").count()
    assert coverage.total >= funnel.target > 0
    skipped = reports["skipped"].first()
    manifest = [
        r for f in (tmp_path / "out").rglob("part-*") for r in json.loads(f.read_text())
    ]
    keyed = contract._merged(spark, SF).where(
        F.col("primary_keys").isNotNull()
        & F.col("eds_schema").isNotNull()
        & ~F.contains("eds_schema", F.lit("/"))
    )
    assert len(manifest) == keyed.count()
    lines = [
        json.loads(line)
        for f in (tmp_path / "lines").rglob("part-*")
        for line in f.read_text().splitlines()
    ]
    assert sorted(map(str, lines)) == sorted(map(str, manifest))
    assert skipped.mixed_schema > 0
    assert set(manifest[0]) == {
        "edw_table", "eds_equivalent_table", "status", "is_table_replaced", "issue_key",
        "eds_schema", "eds_base_table", "table", "view_table", "primary_keys", "batch_id",
    }


class Settings:
    """A session that only has settings."""

    def __init__(self, **values):
        self.conf, self.values = self, values

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_shared_dir_is_the_clusters():
    named = Settings(**{CHECKPOINT_DIR: "hdfs://shared/checkpoints/"})
    assert shared_dir(named) == "hdfs://shared/checkpoints"
    with pytest.raises(ValueError, match=CHECKPOINT_DIR):
        shared_dir(Settings())


def test_written_frames_can_be_discarded(spark):
    folder = Path(shared_dir(spark).removeprefix("file:"))
    frame = written(spark.range(3).toDF("v"), "kept")
    assert frame.count() == 3 and list(folder.glob("kept-*"))
    discard_written(spark)
    assert not list(folder.glob("kept-*"))


def test_views_leave_the_callers_alone(spark):
    spark.range(1).createOrReplaceTempView("orders")
    assert view(spark, SF, "tickets").count() > 1
    assert spark.table("orders").count() == 1
    spark.catalog.dropTempView("orders")

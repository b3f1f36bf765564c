"""One key holding a third of all rows must not end up in one task."""

import re

import pytest
from pyspark.sql import functions as F

from parityline.operators.keys import attach_keys
from parityline.operators.schema import key_presence

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS if spark.conf.get(k, None) is not None}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k in SETTINGS:
        spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=60_000):
    """Tickets, a third of them about one table."""
    name = F.when(F.col("id") % 3 == 0, "p.s.hot_vw").otherwise(
        F.concat(F.lit("p.s.t"), (F.col("id") % 5000).cast("string"), F.lit("_vw"))
    )
    return spark.range(0, n, 1, 8).select(
        F.concat(F.lit("T-"), F.md5(F.col("id").cast("string"))).alias("issue_key"),
        name.alias("eds_equivalent_table"),
    )


def test_hot_name_is_split_when_keys_are_attached(spark, no_broadcast):
    ingestion = spark.range(5000).select(
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("table"), F.array(F.lit("id")).alias("key_cols")
    )
    views = spark.createDataFrame([("s.hot", ["h"])], "view_table string, view_key_cols array<string>")
    merged = attach_keys(hot(spark), ingestion, views)
    plan = final_plan(merged.select("issue_key", "primary_keys"))
    assert "skew=true" in plan
    assert not re.search("NestedLoop|Cartesian", plan)
    assert merged.count() == 60_000
    assert merged.where("view_table = 's.hot' and primary_keys[0] = 'h'").count() == 20_000


def test_hot_table_is_split_in_the_key_check(spark, no_broadcast):
    name = F.col("eds_equivalent_table")
    manifest = hot(spark).select(
        "issue_key", name, name.alias("edw_table"), name.alias("eds_base_table"),
        F.array(F.lit("id")).alias("primary_keys"),
    )
    columns = manifest.select(name.alias("table_name")).distinct().withColumn("column_name", F.lit("id"))
    checked = key_presence(manifest, columns)
    plan = final_plan(checked.select("issue_key", "keys_present"))
    assert plan.count("skew=true") >= 3
    assert checked.where("keys_present").count() == 60_000

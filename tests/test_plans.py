"""What the plans of the registered queries must and must not contain."""

import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
MORE = contract.training_data.queries() if contract.training_data else {}
QUERIES = {k: q for k, q in contract.queries().items() if k not in MORE and k != "pipeline"}
FROM_YAML = {"ingestion_keys_flatten", "view_models", "pk_from_model_files"}


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan(spark, name):
    text = plan(spark, name)
    for operator in ("NestedLoop", "Cartesian", "CollectLimit"):
        assert operator not in text
    assert ("EvalPython" in text) == (name in FROM_YAML)
    assert "Limit" not in text and "TakeOrdered" not in text


def test_scans_read_only_what_is_needed(spark):
    text = plan(spark, "match_ratio_pk_only")
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert "ReadSchema: struct<o_orderkey:bigint>" in scans[0]
    assert "o_totalprice" not in text
    assert "LessThan(o_orderdate" in scans[1]


def test_comparison_is_one_shuffle_of_keys_and_hashes(spark):
    text = plan(spark, "match_ratio")
    assert "Join" not in text
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Exchange SinglePartition") == 1


@pytest.mark.parametrize("name", ["ticket_target_filter", "view_complexity", "pk_from_description"])
def test_row_rules_do_not_shuffle(spark, name):
    assert "Exchange hashpartitioning" not in plan(spark, name)

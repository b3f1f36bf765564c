import random

import pytest
from conftest import rows

from parityline.operators.keys import attach_keys, join_ingestion_keys, join_view_keys, pk_coverage
from parityline.operators.substring import names_containing, names_ending_with, names_listing

ROW = "issue_key string, eds_equivalent_table string"
INGESTION = "table string, key_cols array<string>"
VIEWS = "view_table string, view_key_cols array<string>"


def test_names_containing_equal_brute_force(spark):
    rng = random.Random(11)

    def word(low, high):
        return "".join(rng.choice("ab.") for _ in range(rng.randint(low, high)))

    names = [word(0, 30) for _ in range(150)] + [None, "", "é€𝄞.ab", "prod.silver.table_one_vw"]
    keys = [word(0, 14) for _ in range(80)] + [None, "", "€𝄞.a", "silver.table_on", "silver.table_one_vw"]
    got = names_containing(
        spark.createDataFrame([(n,) for n in names * 2], "n string").distinct(),
        spark.createDataFrame([(k,) for k in keys], "k string"),
        "n",
        "k",
    )
    want = [(n, k) for n in set(names) for k in keys if n is not None and k is not None and k in n]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_names_ending_with_equal_brute_force(spark):
    rng = random.Random(12)

    def word(high):
        return "".join(rng.choice("a._vw") for _ in range(rng.randint(0, high)))

    names = [word(6) + "." + word(4) + "_vw" for _ in range(200)] + [None, "", "_vw", "._vw", "x.a_vw "]
    keys = [word(5) for _ in range(150)] + [None, "", "a"]
    got = names_ending_with(
        spark.createDataFrame([(n,) for n in names], "n string").distinct(),
        spark.createDataFrame([(k,) for k in keys], "k string"),
        "n",
        "k",
    )
    want = [
        (n, k) for n in set(names) for k in keys
        if n is not None and k is not None and n.endswith("." + k + "_vw")
    ]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_names_listing_whole_names(spark):
    names = ["p.s.a_vw", " p.s.a_vw / q.t.b ", "s.a_vw/p.s.a_vw", "a_vw", "/", "", None, "x.p.s.a"]
    keys = ["s.a_vw", "t.b", "s.a", "p.s", None, ""]
    got = names_listing(
        spark.createDataFrame([(n,) for n in names], "n string").distinct(),
        spark.createDataFrame([(k,) for k in keys], "k string"),
        "n",
        "k",
    )
    assert rows(got) == [
        (" p.s.a_vw / q.t.b ", "s.a_vw"),
        (" p.s.a_vw / q.t.b ", "t.b"),
        ("p.s.a_vw", "s.a_vw"),
        ("s.a_vw/p.s.a_vw", "s.a_vw"),
        ("x.p.s.a", "s.a"),
    ]


def test_no_keys_at_all(spark):
    tickets = spark.createDataFrame([("T-1", "p.s.a_vw"), ("T-2", None)], ROW)
    none = attach_keys(tickets, spark.createDataFrame([], INGESTION), spark.createDataFrame([], VIEWS))
    assert rows(none) == [("T-1", "p.s.a_vw", None, None, None), ("T-2", None, None, None, None)]
    assert tuple(pk_coverage(none).first()) == (2, 0, 2)


@pytest.fixture(scope="module")
def frames(spark):
    tickets = spark.createDataFrame(
        [
            ("T-1", "p.s.orders_vw"),
            ("T-2", "p.s.orders_vw"),
            ("T-3", "p.s.orders_daily_vw"),
            ("T-4", "p.s.empty_vw"),
            ("T-5", "p.s.other_vw/ p.s.orders_vw"),
            ("T-6", None),
        ],
        ROW,
    )
    ingestion = spark.createDataFrame(
        [("orders", ["id"]), ("orders", ["id", "ts"]), ("empty", []), ("NO TABLE", [])], INGESTION
    )
    views = spark.createDataFrame(
        [
            ("s.orders_vw", ["v"]),
            ("s.orders", ["v", "v"]),
            ("s.empty_vw", ["e"]),
        ],
        VIEWS,
    )
    return tickets, ingestion, views


def test_joins_fan_out_like_the_conditions(frames):
    tickets, ingestion, views = frames
    assert [r[0] for r in rows(join_ingestion_keys(tickets, ingestion), "issue_key")] == [
        "T-1", "T-1", "T-2", "T-2", "T-3", "T-4", "T-5", "T-5", "T-6",
    ]
    got = rows(join_view_keys(tickets, views), "issue_key", "view_table")
    assert got == [
        ("T-1", "s.orders"), ("T-1", "s.orders_vw"),
        ("T-2", "s.orders"), ("T-2", "s.orders_vw"),
        ("T-3", "s.orders"), ("T-4", "s.empty_vw"),
        ("T-5", "s.orders"), ("T-5", "s.orders_vw"), ("T-6", None),
    ]
    exact = rows(join_view_keys(tickets, views, exact=True), "issue_key", "view_table")
    assert exact == [
        ("T-1", "s.orders_vw"), ("T-2", "s.orders_vw"), ("T-3", None),
        ("T-4", "s.empty_vw"), ("T-5", "s.orders_vw"), ("T-6", None),
    ]


def test_ingestion_key_wins_even_when_empty(frames):
    merged = attach_keys(*frames)
    assert merged.columns == ["issue_key", "eds_equivalent_table", "table", "view_table", "primary_keys"]
    assert rows(merged.where("issue_key in ('T-3', 'T-4', 'T-6')")) == [
        ("T-3", "p.s.orders_daily_vw", None, "s.orders", ["v", "v"]),
        ("T-4", "p.s.empty_vw", "empty", "s.empty_vw", []),
        ("T-6", None, None, None, None),
    ]
    assert merged.where("issue_key = 'T-1'").count() == 4
    fixed = attach_keys(*frames, empty_is_missing=True, distinct_columns=True)
    assert rows(fixed.where("issue_key in ('T-3', 'T-4')"), "issue_key", "primary_keys") == [
        ("T-3", ["v"]),
        ("T-4", ["e"]),
    ]

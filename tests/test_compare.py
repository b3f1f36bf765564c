import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parityline.operators.compare import hash_rows, match_ratio, row_matches, shared_columns

LEGACY = (
    "id int, region string, tags array<string>, origin struct<code:int, label:string>, "
    "counts map<string,int>, grade int, old_only string"
)
TARGET = LEGACY.replace("grade int, old_only", "grade string, new_only")


@pytest.fixture(scope="module")
def pair(spark):
    def row(i, grade, count):
        return (i, f"r{i}", [f"t{i}", "x"], (i * 10, f"o{i}"), {f"c{i}": count}, grade, f"only{i}")

    legacy = spark.createDataFrame([row(i, i, i) for i in range(1, 6)], LEGACY)
    target = spark.createDataFrame(
        [row(i, str(i), 99 if i == 2 else i) for i in range(2, 7)], TARGET
    )
    return legacy, target


def ratio(*args, **kwargs):
    return match_ratio(*args, **kwargs).first()


def test_shared_columns_need_equal_types(pair):
    assert list(shared_columns(*pair)) == ["id", "region", "tags", "origin", "counts"]


def test_nested_nullability_is_part_of_the_type(spark):
    a = spark.range(1).select(F.array(F.lit("x")).alias("v"))
    b = spark.createDataFrame([(["x"],)], "v array<string>")
    assert list(shared_columns(a, b)) == []


def test_ratio_of_nested_rows_in_both_directions(pair):
    legacy, target = pair
    assert ratio(legacy, target, ["id", "region"]).ratio == 3 / 5
    assert ratio(target, legacy, ["id", "region"]).ratio == 3 / 5


def test_hash_differs_only_where_a_value_does(pair):
    hashed = ["tags", "origin", "counts"]
    left, right = (dict(rows(hash_rows(df, hashed, ["id"]))) for df in pair)
    assert [left[i] == right[i] for i in (2, 3, 4, 5)] == [False, True, True, True]


def test_hashed_and_kept_column_is_text(pair):
    out = hash_rows(pair[0], ["id", "region"], ["id"])
    assert dict(out.dtypes) == {"id": "string", "hash": "int"}
    assert hash_rows(pair[0], [], ["id"]).select("hash").distinct().collect() == [(1,)]


def test_columns_narrow_the_comparison(pair):
    assert ratio(*pair, ["id"], ["id", "tags"]).ratio == 4 / 5
    assert ratio(*pair, ["id"], ["tags"]).ratio == 4 / 5


def test_unknown_columns_are_named(pair):
    with pytest.raises(ValueError, match="grade"):
        match_ratio(*pair, ["id"], ["grade"])
    with pytest.raises(ValueError, match="old_only"):
        match_ratio(*pair, ["old_only"])


def test_empty_left_is_zero(pair):
    got = ratio(pair[0].limit(0), pair[1], ["id"])
    assert tuple(got) == (0.0, 0, 0)


def test_empty_right_is_zero(pair):
    assert tuple(ratio(pair[0], pair[1].limit(0), ["id"])) == (0.0, 5, 0)


def test_null_keys_count_but_never_match(spark):
    df = spark.createDataFrame([(1, 1, "a"), (None, 2, "b"), (3, None, "c")], "k int, j int, v string")
    assert tuple(ratio(df, df, ["k", "j"])) == (1 / 3, 3, 1)
    assert rows(row_matches(df, df, ["k", "j"])) == [(1, 1, 1, 1, True)]


def test_duplicate_keys_multiply_unless_bounded(spark):
    left = spark.createDataFrame([(1, "a")] * 3 + [(2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "a")] * 4 + [(2, "x")], "k int, v string")
    assert tuple(ratio(left, right, ["k"])) == (12 / 4, 4, 12)
    assert tuple(ratio(left, right, ["k"], bounded=True)) == (3 / 4, 4, 3)


def test_equals_plain_join_form(spark):
    rng = random.Random(3)

    def some(n):
        return [
            (rng.choice([None, 1, 2, 3]), rng.choice("ab"), rng.choice(["x", "y", None]))
            for _ in range(n)
        ]

    left = spark.createDataFrame(some(60), "k int, j string, v string")
    right = spark.createDataFrame(some(80), "k int, j string, v string")
    plain = hash_rows(left, ["v"], ["k", "j"]).join(
        hash_rows(right, ["v"], ["k", "j"]), ["k", "j", "hash"]
    )
    assert ratio(left, right, ["k", "j"]).matched_rows == plain.count()


def test_shifted_null_is_seen_only_when_null_safe(spark):
    schema = "k int, a string, b string"
    left = spark.createDataFrame([(1, None, "x")], schema)
    right = spark.createDataFrame([(1, "x", None)], schema)
    assert ratio(left, right, ["k"]).ratio == 1.0
    assert ratio(left, right, ["k"], null_safe=True).ratio == 0.0
    assert ratio(left, left, ["k"], null_safe=True, wide=True).ratio == 1.0


def test_map_order_matters_unless_normalized(spark):
    def row(m, p):
        return spark.sql(f"SELECT 1 AS k, map({m}) AS m, array(named_struct('p', map({p}))) AS n")

    left, right = row("'a', 1, 'b', 2", "'c', 1, 'd', 2"), row("'b', 2, 'a', 1", "'d', 2, 'c', 1")
    assert ratio(left, right, ["k"]).ratio == 0.0
    assert ratio(left, right, ["k"], normalize_maps=True).ratio == 1.0


def test_typed_hash_agrees_on_every_type(pair, spark):
    options = dict(typed=True, null_safe=True, wide=True, normalize_maps=True)
    assert ratio(*pair, ["id", "region"], **options).ratio == 3 / 5
    columns = """id, cast(id AS tinyint) AS a, cast(id AS decimal(20,3)) AS b, id / 3 AS c,
        cast(id / 3 AS float) AS d, id % 2 = 0 AS e, date_add(date'2020-01-01', cast(id AS int)) AS f,
        timestamp_micros(id) AS g, cast(timestamp_micros(id) AS timestamp_ntz) AS h,
        cast(cast(id AS string) AS binary) AS i, make_dt_interval(0, 0, 0, id) AS j,
        array(cast(null AS string), cast(id AS string)) AS k"""
    left = spark.sql(f"SELECT {columns} FROM range(50)")
    assert tuple(ratio(left, left, ["id"], **options)) == (1.0, 50, 50)
    for name in left.columns[1:]:
        shifted = left.withColumn("id", F.col("id") + 1).select("id", name)
        assert ratio(left.select("id", name), shifted, ["id"], **options).ratio == 0.0, name


def test_removed_rows_lower_the_ratio(spark):
    df = spark.range(200).select("id", (F.col("id") * 3).alias("v"))
    assert ratio(df, df, ["id"]).ratio == 1.0
    assert ratio(df, df.where("id >= 50"), ["id"]).ratio == 150 / 200


def test_bucketed_tables_are_not_shuffled(spark):
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    rng = random.Random(4)

    def store(name, n):
        data = [(rng.choice([None, *range(40)]), rng.choice("ab"), rng.choice([1.5, None])) for _ in range(n)]
        df = spark.createDataFrame(data, "k int, j string, v double")
        df.write.mode("overwrite").bucketBy(4, "k").saveAsTable(name)
        return spark.table(name)

    left, right = store("bucketed_left", 300), store("bucketed_right", 200)
    for keys in (["k"], ["k", "j"]):
        for options in ({}, {"bounded": True}):
            want = ratio(left, right, keys, **options)
            assert ratio(left, right, keys, bucketed=True, **options) == want
        assert rows(row_matches(left, right, keys, bucketed=True)) == rows(row_matches(left, right, keys))
    spark.conf.set(setting, "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = match_ratio(left, right, ["k", "j"], bucketed=True)._jdf.queryExecution()
        assert "hashpartitioning" not in plan.executedPlan().toString()
    finally:
        spark.conf.unset(setting)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql("DROP TABLE bucketed_left")
    spark.sql("DROP TABLE bucketed_right")


def test_copies_collapse_and_products_may_leave_bigint(spark):
    """A count of copies is one row of the aggregate, however large."""
    from parityline.operators import compare

    big = 4_000_000_000
    counts = spark.createDataFrame([(big, big), (1, 1)], "left_rows long, right_rows long")
    original = compare._row_counts
    compare._row_counts = lambda *a, **k: counts
    try:
        got = match_ratio(None, None, [], []).first()
    finally:
        compare._row_counts = original
    assert got.matched_rows == big * big + 1
    assert got.ratio == pytest.approx((big * big + 1) / (big + 1))

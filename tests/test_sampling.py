import hashlib
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parityline.operators.sampling import (
    _sketch,
    probed_files,
    row_bytes,
    sample_percent,
    sample_row_budget,
    sample_rows,
    sample_to_size,
)
from parityline.sinks.staging import StagingError, stage_sample


def digest(*values):
    return hashlib.md5("|".join(str(v) for v in values).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 17, 999, 1000, 5000])
def test_exact_number_in_digest_order(spark, n):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    want = sorted(range(1000), key=lambda i: digest(i, i % 7))[:n]
    assert sorted(r[0] for r in sample_rows(df, n).collect()) == sorted(want)
    by_v = sorted(range(1000), key=lambda i: digest(i % 7, i))[:n]
    assert sorted(r[0] for r in sample_rows(df, n, ["v"]).collect()) == sorted(by_v)


def test_a_hot_key_gets_its_share(spark):
    hot = min(range(3000), key=digest)
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    got = Counter(r[0] for r in sample_rows(df, 900, ["k"]).collect())
    assert sum(got.values()) == 900 and 220 <= got[hot] <= 380


def test_copies_are_counted_not_merged(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"))
    got = Counter(r[0] for r in sample_rows(df, 8000).collect())
    assert sum(got.values()) == 8000
    everything = Counter(r[0] for r in sample_rows(df, 9000).collect())
    assert everything == Counter(r[0] for r in df.collect())


def test_only_copies(spark):
    df = spark.range(5000).select(F.lit("x").alias("v"), F.lit(None).cast("string").alias("w"))
    assert [tuple(r) for r in sample_rows(df, 2500).collect()] == [("x", None)] * 2500


def test_empty_table(spark):
    assert sample_rows(spark.range(0), 10).count() == 0


def test_budget(spark):
    df = spark.createDataFrame([("ab", 1), ("cdé", None), (None, 123)], "s string, i int")
    assert [r[0] for r in df.select(row_bytes(["s", "i"])).collect()] == [3, 4, 3]
    got = sample_row_budget(df, ["s", "i"], 1).first()
    assert tuple(got) == (3, 10 / 3, int(1024 * 1024 / (10 / 3)), 0.0)
    assert tuple(sample_row_budget(df.limit(0), ["s"], 1).first()) == (0, None, None, 0.0)
    nothing = spark.createDataFrame([("",), (None,)], "s string")
    assert tuple(sample_row_budget(nothing, ["s"], 1).first()) == (2, 0.0, None, 0.0)


@pytest.fixture
def many_files(spark, tmp_path):
    """Forty files of fifty rows, the rows of a file alike in size, in a folder with an odd name."""
    path = tmp_path / "a b+c%d"
    frame = spark.range(2000).select("id", F.repeat(F.lit("x"), (F.col("id") / 50 % 7 + 10).cast("int")).alias("t"))
    frame.repartitionByRange(40, "id").write.partitionBy().parquet(str(path))
    files = sorted(path.glob("part-*"))
    assert len(files) == 40
    return spark.read.parquet(str(path)), files


def test_probe_opens_few_files(spark, many_files):
    df, files = many_files
    want = sample_row_budget(df, ["id", "t"], 1, probe_files=5).first()
    chosen = {f.rsplit("/", 1)[1] for f in probed_files(df, 100, 5)}
    assert len(chosen) == 5 and want["probed_rows"] == 250
    # The others are not read: they may be broken.
    for file in files:
        if file.name not in chosen:
            file.write_bytes(b"broken" * 100)
    assert sample_row_budget(df, ["id", "t"], 1, probe_files=5).first() == want
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        df.count()


def test_probe_states_its_error(spark, many_files):
    df, _ = many_files
    whole = sample_row_budget(df, ["id", "t"], 1).first()
    assert (whole["probed_rows"], whole["relative_error"]) == (2000, 0.0)
    sizes = [(r.n, r.b) for r in df.where(F.col("_metadata.file_path").isin(probed_files(df, 100, 10)))
             .groupBy("_metadata.file_path").agg(F.count("*").alias("n"), F.sum(row_bytes(["id", "t"])).alias("b")).collect()]
    mean = sum(b for _, b in sizes) / sum(n for n, _ in sizes)
    variance = sum((b - mean * n) ** 2 for n, b in sizes) / 9
    error = ((1 - 10 / 40) * variance * 10) ** 0.5 / sum(b for _, b in sizes)
    found = sample_row_budget(df, ["id", "t"], 1, probe_files=10).first()
    assert found["avg_row_bytes"] == pytest.approx(mean)
    assert found["relative_error"] == pytest.approx(error) and error > 0.001
    assert abs(found["avg_row_bytes"] / whole["avg_row_bytes"] - 1) < 4 * error


def test_probe_takes_more_files_until_it_has_rows(spark, many_files):
    df, _ = many_files
    assert len(probed_files(df, 400, 1)) == 8  # of fifty rows each
    assert probed_files(df.where("id < 0"), 100, 5) is None
    assert probed_files(df.groupBy("t").count(), 100, 5) is None
    assert probed_files(spark.range(10).toDF("_metadata"), 100, 5) is None
    rare = sample_row_budget(df.where("id = 77"), ["id"], 1, probe_files=2).first()
    assert tuple(rare)[:2] == (1, 2.0)


def test_sample_of_many_files_to_size(spark, many_files):
    df, _ = many_files
    budget = sample_row_budget(df, ["id"], 0.001, probe_files=7).first()["row_budget"]
    got = sample_to_size(df, ["id"], 0.001, probe_files=7)
    want = sorted(range(2000), key=digest)[:budget]
    assert sorted(r[0] for r in got.collect()) == sorted(want) and 0 < budget < 2000


def test_sketch_is_small_and_fine_where_samples_end(spark):
    """Slices have a relative width, whatever share of the rows is wanted."""
    df = spark.range(200_000)
    slices = _sketch(df, None).first()["slices"]
    assert len(slices) < 12_000
    at = 0
    for s in slices:
        if 500 <= at < 100_000:
            assert s["_rows"] <= 60 + at / 100
        at += s["_rows"]
    assert at == 200_000
    values = [s["_slice"] for s in slices]
    assert values == sorted(values)


def test_sample_has_no_window_over_all_rows_or_slices(spark):
    plan = sample_rows(spark.range(1000).toDF("v"), 50)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "windowspecdefinition(_slice" in windows[0]


def test_rows_are_filtered_by_one_hash_of_a_row(spark):
    plan = sample_rows(spark.range(1000).toDF("v"), 50)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "md5" in line]
    assert len(filters) == 1 and filters[0].count("md5(") == 1


def test_percent_is_a_sample_node(spark, many_files):
    df, _ = many_files
    part = sample_percent(df, 25, seed=3)
    assert "Sample 0.0, 0.25, false, 3" in part._jdf.queryExecution().optimizedPlan().toString()
    assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString()
    assert rows(part) == rows(sample_percent(df, 25, seed=3)) != rows(sample_percent(df, 25, seed=4))
    assert 350 < part.count() < 650 and set(rows(part)) <= set(rows(df))
    assert sample_percent(df, 0, 1).count() == 0 and sample_percent(df, 100, 1).count() == 2000
    with pytest.raises(ValueError, match="percentage"):
        sample_percent(df, 101, 1)


def test_sample_to_size(spark):
    df = spark.range(500).select(F.lpad(F.col("id").cast("string"), 10, "0").alias("t"), F.lit(1).alias("u"))
    got = sample_to_size(df, ["t"], 1000 / 1024 / 1024)
    assert got.columns == ["t"]
    assert got.count() == 100


def test_staged_sample(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS staged")
    source = spark.range(300).select("id", F.lit("abcdefg").alias("t"))
    known = {"wh.core.items": source}
    stage = dict(known=known, namespace="staged")
    name = stage_sample(spark, "wh.core.items", ["id", "t"], 950 / 1024 / 1024, **stage)
    assert name == "staged.core_items_cw"
    first = spark.table(name).count()
    assert 90 <= first <= 110  # 8 to 10 bytes a row
    assert stage_sample(spark, "wh.core.items", ["t"], 1, **stage) == name
    assert spark.table(name).columns == ["t"]
    assert spark.table(name).count() == 300
    for bad, columns in (("core.items", ["id"]), ("no.such.table", ["id"]), ("wh.core.items", ["gone"])):
        with pytest.raises(StagingError):
            stage_sample(spark, bad, columns, 1, **stage)
    with pytest.raises(StagingError, match="no rows"):
        stage_sample(spark, "a.b.c", ["id"], 1, known={"a.b.c": spark.range(0)}, namespace="staged")
    with pytest.raises(StagingError, match="fit"):
        stage_sample(spark, "wh.core.items", ["t"], 0, **stage)
    with pytest.raises(ValueError, match="either"):
        stage_sample(spark, "wh.core.items", ["t"], **stage)
    assert stage_sample(spark, "wh.core.items", ["id"], percent=100, seed=1, **stage) == name
    assert rows(spark.table(name)) == rows(source.select("id"))
    assert [t.name for t in spark.catalog.listTables("staged") if not t.isTemporary] == ["core_items_cw"]
    spark.sql("DROP DATABASE staged CASCADE")


def test_a_failed_stage_leaves_the_earlier_one(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS safe")
    good = spark.range(100).withColumn("t", F.lit("abc"))
    broken = good.withColumn("t", F.when(F.col("id") == 77, F.raise_error(F.lit("a lost block"))).otherwise("z"))
    name = stage_sample(spark, "a.b.c", ["id", "t"], 1, known={"a.b.c": good}, namespace="safe")
    before = rows(spark.table(name))
    with pytest.raises(StagingError, match="a lost block"):
        stage_sample(spark, "a.b.c", ["id", "t"], percent=100, known={"a.b.c": broken}, namespace="safe")
    assert rows(spark.table(name)) == before
    # The new table is complete, but cannot take the name: the old one gets it back.
    run, renames = spark.sql, []

    def fail_second(text, *args, **kwargs):
        if "RENAME" in text:
            renames.append(text)
            if len(renames) == 2:
                raise RuntimeError("the catalog is gone")
        return run(text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: fail_second(text, *a, **k))
    with pytest.raises(StagingError, match="the catalog is gone"):
        stage_sample(spark, "a.b.c", ["id"], 1, known={"a.b.c": good}, namespace="safe")
    monkeypatch.undo()
    assert len(renames) == 3
    assert rows(spark.table(name)) == before
    assert [t.name for t in spark.catalog.listTables("safe") if not t.isTemporary] == ["b_c_cw"]
    spark.sql("DROP DATABASE safe CASCADE")


def test_staged_sample_is_of_the_whole_table(spark, tmp_path):
    """A table in id order over many files: every range is sampled, the same at each run."""
    spark.sql("CREATE DATABASE IF NOT EXISTS spread")
    frame = spark.range(5000).withColumn("t", F.lit("x" * 96))
    frame.repartitionByRange(50, "id").write.parquet(str(tmp_path / "t"))
    stage = dict(known={"a.b.c": spark.read.parquet(str(tmp_path / "t"))}, namespace="spread")
    runs = []
    for _ in range(2):
        name = stage_sample(spark, "a.b.c", ["id", "t"], 0.04, keys=["id"], probe_files=20, **stage)
        runs.append(sorted(r.id for r in spark.table(name).select("id").collect()))
    spark.sql("DROP DATABASE spread CASCADE")
    assert runs[0] == runs[1] and 380 <= len(runs[0]) <= 440
    assert len({i // 100 for i in runs[0]}) >= 45


def test_no_single_task_gets_the_sample(spark):
    plan = sample_rows(spark.range(10_000).toDF("v"), 5000)._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" not in plan
    assert rows(spark.range(3).toDF("v")) == [(0,), (1,), (2,)]


def test_sample_does_not_depend_on_the_input_partitioning(spark):
    df = spark.range(3000).select((F.col("id") % 1100).alias("v"))
    assert rows(sample_rows(df.coalesce(1), 777)) == rows(sample_rows(df.repartition(9), 777))

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parityline.operators.manifest import batch_documents, validation_manifest
from parityline.sinks.folders import mounted, partitions, read_texts, write_texts
from parityline.sinks.manifest import read_manifest, write_manifest

KEYS = ("eds_schema", "batch_id")
ODD = ["a b", "a:b%", "x=y", "[q]{r}^", "t\tn\n", "é", "'q\"", "*?#\\", "_under", ".dot", "", None]


def tree(folder):
    """Folders of the data files with their bytes, sorted."""
    files = (f for f in folder.rglob("part-*") if not f.name.endswith(".crc"))
    return sorted((f.parent.relative_to(folder).as_posix(), f.read_bytes()) for f in files)


def test_folders_are_those_of_sparks_writer(spark, tmp_path):
    data = [(s, n, f'[{{"é": "{n}"}}]\nend') for s in ODD for n in (0, 12)]
    texts = spark.createDataFrame(data, "eds_schema string, batch_id int, document string").repartition(3)
    texts.write.partitionBy(*KEYS).text(str(tmp_path / "spark"))
    for whole in (True, False, True):
        write_texts(texts, str(tmp_path / "mine"), KEYS, "document", whole=whole)
        assert tree(tmp_path / "mine") == tree(tmp_path / "spark")
    # Nothing but the schemas' folders and the mark of success is left.
    assert all("=" in f.name or f.name == "_SUCCESS" for f in (tmp_path / "mine").iterdir())
    of_spark = spark.read.text(str(tmp_path / "mine"), wholetext=True)
    assert rows(read_texts(spark, str(tmp_path / "mine"))) == rows(of_spark, "value")
    found = rows(partitions(texts, str(tmp_path / "mine"), *KEYS))
    assert found == sorted(((s, n) for s in ODD if s for n in (0, 12)), key=repr)


def test_files_at_any_depth_are_read(spark, tmp_path):
    for name in ("a.txt", "x/b.txt", "x/y/c.txt", "x/y/z/d.txt", "_no.txt", ".no", "x/_no/e.txt", "k=1/_k=2/f.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name[-5:])
    assert rows(read_texts(spark, str(tmp_path))) == [(f"{c}.txt",) for c in "abcdf"]


def test_a_failed_write_leaves_the_files(spark, tmp_path):
    path = tmp_path / "m"
    texts = spark.range(40).selectExpr("'s' as eds_schema", "cast(id as int) as batch_id", "'old' as document")
    write_texts(texts, str(path), KEYS, "document", whole=True)
    before = tree(path)
    broken = texts.withColumn("document", F.expr("if(batch_id = 33, raise_error('broken'), 'new')"))
    for whole in (True, False):
        with pytest.raises(Exception, match="broken"):
            write_texts(broken, str(path), KEYS, "document", whole=whole)
        assert tree(path) == before
        assert sorted(f.name for f in path.iterdir()) == ["_SUCCESS", "eds_schema=s"]


def test_an_empty_manifest_replaces_all(spark, tmp_path):
    texts = spark.range(3).selectExpr("'s' as eds_schema", "cast(id as int) as batch_id", "'[]' as document")
    write_texts(texts, str(tmp_path / "m"), KEYS, "document", whole=True)
    write_texts(texts.limit(0), str(tmp_path / "m"), KEYS, "document", whole=False)
    assert len(tree(tmp_path / "m")) == 3
    write_texts(texts.limit(0), str(tmp_path / "m"), KEYS, "document", whole=True)
    assert [f.name for f in (tmp_path / "m").iterdir()] == ["_SUCCESS"]
    assert rows(read_texts(spark, str(tmp_path / "m"))) == []


def test_mounted_places(spark, tmp_path):
    assert mounted(spark, str(tmp_path)) == str(tmp_path)
    assert mounted(spark, f"file://{tmp_path}/a b%20c") == f"{tmp_path}/a b%20c"


def test_manifest_files_take_no_task_each(spark, tmp_path):
    """Files are written, listed and read by tasks for many of them."""
    rows_ = spark.range(6000).select(
        F.concat(F.lit("s"), F.col("id") % 2).alias("eds_schema"),
        F.lit("No").alias("is_table_replaced"),
        F.col("id").cast("string").alias("issue_key"),
        F.lit(None).cast("string").alias("table"),
        F.lit(None).cast("string").alias("view_table"),
        F.array(F.lit("id")).alias("primary_keys"),
    )
    manifest = validation_manifest(rows_)
    batches = batch_documents(manifest).count()
    assert batches == 302
    context, path = spark.sparkContext, str(tmp_path / "m")
    context.setJobGroup("manifest files", "")
    write_manifest(manifest, path, whole=True)
    write_manifest(manifest.where("eds_schema = 's1'"), path)
    kind = ", ".join(f"`{c}` {t}" for c, t in manifest.dtypes)
    back = rows(read_manifest(spark, path, kind), *manifest.columns)
    context.setLocalProperty("spark.jobGroup.id", None)
    assert back == rows(manifest)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("manifest files") for s in tracker.getJobInfo(j).stageIds]
    most = max(s.numTasks for s in stages if s is not None)
    assert most < batches / 4

"""The shared folder for written intermediates."""

from pathlib import Path

import pytest

from parityline import session


class Conf:
    def __init__(self, **values):
        self.values = {k.replace("_", "."): v for k, v in values.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


class Fake:
    def __init__(self, **values):
        self.conf = Conf(**values)


def test_the_folder_that_the_cluster_names():
    assert session.shared_dir(Fake(spark_checkpoint_dir="hdfs://x/y/", spark_master="yarn")) == "hdfs://x/y"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x", ""])
def test_a_cluster_without_one_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake(spark_master=master, spark_app_id="a"))


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_a_local_session_gets_one_of_its_own(master):
    one = Fake(spark_master=master, spark_app_id=f"app-{master}")
    assert session.shared_dir(one) == session.shared_dir(one)
    assert Path(session.shared_dir(one).removeprefix("file://")).is_dir()


def test_what_is_written_is_removed(spark):
    session.discard_written(spark)
    frames = [session.written(spark.range(9), "some") for _ in range(3)]
    other = session.shared_path(spark, "other")
    spark.range(3).write.parquet(other)
    folders = [Path(p.removeprefix("file://")) for p in session._WRITTEN]
    assert len(folders) == 4 and all(f.is_dir() for f in folders)
    assert sorted(r[0] for r in frames[2].collect()) == list(range(9))
    session.discard_written(spark)
    assert not any(f.exists() for f in folders)


def test_a_client_without_a_jvm_removes_by_arrow(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "c").write_text("x")
    session._WRITTEN[:] = [f"file://{tmp_path}/a", f"file://{tmp_path}/none"]
    session.discard_written(Fake())
    assert not (tmp_path / "a").exists() and not session._WRITTEN

"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_WRITTEN: list[str] = []
_OWN: dict[str, str] = {}


def local_session(app: str, cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in its settings.

    Where none is named, a local session, whose executors are its driver, gets one of its
    own; on a cluster that is an error.
    """
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if path:
        return path.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    app = spark.conf.get("spark.app.id")
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="parityline-")
    return _OWN[app]


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which ``discard_written`` removes."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several actions need the same frame. Unlike a cache, the files
    outlive any executor, and the lineage ends here. ``discard_written`` removes them.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard_written(spark: SparkSession) -> None:
    """Remove what was written to new shared paths in this process, once no frame needs it."""
    while _WRITTEN:
        _remove(spark, _WRITTEN.pop())


def _remove(spark: SparkSession, path: str) -> None:
    """Remove a folder by Hadoop's file systems, or where the client has none, by Arrow's."""
    try:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
    except AttributeError:
        store, place = fs.FileSystem.from_uri(path)
        if store.get_file_info(place).type == fs.FileType.Directory:
            store.delete_dir(place)
        return
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

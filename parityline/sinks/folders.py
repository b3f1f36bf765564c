"""Many small files in partition folders of a mounted file system.

Hadoop's local file system starts processes for each file and folder that it makes, and a
folder's listing is a task of Spark's. Where a path is in a file system that all executors
have mounted, the functions here do the same inside the tasks of a Spark job.

Tasks write to a folder that readers pass over, under names that no other attempt has, and
report them. Once all are written, a second job puts the reported files into their places;
it may do so more than once.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from parityline.sources.documents import literal_path

_FILES = 500  # of a task, while there are not more than _TASKS
_TASKS = 10_000
_EMPTY = "__HIVE_DEFAULT_PARTITION__"
# What Spark escapes in the names of partition folders.
_SPECIAL = re.compile(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]")


def mounted(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder in a mounted file system; None if it is in another store."""
    try:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
    except AttributeError:  # a client without Hadoop's file systems
        return None
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri()
    return found.getPath() if found.getScheme() == "file" else None


def _tasks(listed: DataFrame) -> int:
    """How many tasks the listed files are worth; their names' bytes say too little."""
    return min(1 + listed.count() // _FILES, _TASKS)


def _shown(name: str) -> bool:
    """Whether Spark would read a file or folder of that name."""
    return not (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"))


def folder_name(column: str, value: bytes | None) -> str:
    """The name of a partition's folder, as Spark writes it."""
    text = (value or b"").decode(errors="replace")
    return f"{column}={_SPECIAL.sub(lambda c: f'%{ord(c[0]):02X}', text) or _EMPTY}"


def write_texts(texts: DataFrame, place: str, columns: tuple[str, ...], text: str, *, whole: bool) -> None:
    """A file for each row, in the folder of its ``columns``.

    The folders written to are replaced and others stay; with ``whole``, none stay.
    """
    staged = f"{place}/_staged-{uuid.uuid4().hex}"

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = f"{staged}/{uuid.uuid4().hex}"
        os.makedirs(mine)
        for batch in batches:
            files, folders = [], []
            for value, *keys in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files.append(f"{mine}/part-{uuid.uuid4()}.txt")
                folders.append("/".join(map(folder_name, columns, keys)))
                with open(files[-1], "wb") as out:
                    out.write((value or b"") + b"\n")
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(folders, pa.string())], ["file", "folder"])

    def move(rows: Iterable[Row]) -> None:
        for folder, files in rows:
            target = f"{place}/{folder}"
            os.makedirs(target, exist_ok=True)
            for other in set(os.listdir(target)).difference(map(os.path.basename, files)):
                _remove(f"{target}/{other}")
            for file in files:
                put_at = f"{target}/{os.path.basename(file)}"
                try:
                    os.replace(file, put_at)
                except FileNotFoundError:  # another attempt has moved it
                    if not os.path.exists(put_at):
                        raise

    listed = f"file://{staged}/list"
    try:
        rows = texts.select(*[F.col(c).cast("string").cast("binary") for c in (text, *columns)])
        rows.mapInArrow(put, "file string, folder string").write.parquet(listed)
        if whole:
            for other in set(os.listdir(place)).difference([os.path.basename(staged)]):
                _remove(f"{place}/{other}")
        found = texts.sparkSession.read.schema("file string, folder string").parquet(literal_path(listed))
        found = found.repartition(_tasks(found), "folder")
        found.groupBy("folder").agg(F.collect_list("file")).foreachPartition(move)
        open(f"{place}/_SUCCESS", "w").close()
    finally:
        shutil.rmtree(staged, ignore_errors=True)


def _remove(path: str) -> None:
    if os.path.isdir(path) and not os.path.islink(path):
        shutil.rmtree(path, ignore_errors=True)
    else:
        try:
            os.remove(path)
        except FileNotFoundError:
            pass


def partitions(outer: DataFrame, place: str, column: str, inner: str) -> DataFrame:
    """(column, inner): the numbered folders that lie inside those of ``column``'s values."""

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                try:
                    names = os.listdir(f"{place}/{folder_name(column, value)}")
                except FileNotFoundError:
                    continue
                values = [n.removeprefix(f"{inner}=") for n in names if n.startswith(f"{inner}=")]
                for start in range(0, len(values), 10_000):
                    some = pa.array(values[start : start + 10_000], pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([value] * len(some), pa.binary()), some], [column, inner])

    asked = outer.select(F.col(column).cast("binary").alias(column)).where(F.length(column) > 0).distinct()
    listed = asked.mapInArrow(found, f"`{column}` binary, `{inner}` string")
    return listed.select(F.col(column).cast("string").alias(column), F.expr(f"try_cast(`{inner}` as int)").alias(inner))


def read_texts(spark: SparkSession, place: str) -> DataFrame:
    """(value): the whole text of each file below a folder."""

    def inside(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                paths = [path]
                if os.path.isdir(path):
                    paths = [f"{path}/{n}" for n in os.listdir(path) if _shown(n)]
                for start in range(0, len(paths), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(paths[start : start + 10_000], pa.string())], ["path"])

    def files(path: str) -> Iterator[str]:
        if os.path.isdir(path):
            for name in filter(_shown, os.listdir(path)):
                yield from files(f"{path}/{name}")
        else:
            yield path

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for file in files(path):
                    with open(file, "rb") as source:
                        held.append(source.read())
                    size += len(held[-1])
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])

    top = [(f"{place}/{n}",) for n in sorted(os.listdir(place)) if _shown(n)]
    listed = spark.createDataFrame(top, "path string").mapInArrow(inside, "path string")
    found = listed.repartition(_tasks(listed), "path").mapInArrow(read, "value binary")
    return found.select(F.col("value").cast("string").alias("value"))

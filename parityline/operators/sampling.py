"""Size-bounded samples.

A sample of an exact size has three steps, each of a bounded cost: a probe of a few files
tells how many rows fit, a sketch of the rows' order tells up to where it goes, and one
filtered read fetches the rows. The sketch merges, so no rows are shuffled for it.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parityline.functions.hashing import digest
from parityline.operators.ranges import expand_ranges

#: Rows that a probe should have at least, and files that it starts with.
PROBE_ROWS, PROBE_FILES = 100, 64
#: Digits of an order's value that the sketch keeps after the leading zeros. The error of
#: a threshold is relative to it: one part in 256 of the rows up to it, or less.
SIGNIFICANT = 3
_MIB = 1024 * 1024


def row_bytes(columns: list[str]) -> Column:
    """Bytes of a row's values written as text."""
    total: Column = F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
    return total


def _file_of(df: DataFrame) -> Column | None:
    """The file of each row, or None if the rows are not those of files."""
    try:
        path = df.metadataColumn("_metadata")["file_path"]
        df.select(path).schema  # resolves it now
        return path
    except AnalysisException:
        return None


def probed_files(df: DataFrame, rows: int = PROBE_ROWS, files: int = PROBE_FILES) -> list[str] | None:
    """Files of ``df`` that are enough for a probe, or None for all of it.

    They are the first of a hash order of their paths, so the choice is the same at every
    run. Where they hold too few rows their number is doubled, which takes a short job.
    """
    path = _file_of(df)
    listed = [re.sub("^file:/+", "file:/", f) for f in df.inputFiles()] if path is not None else []
    listed.sort(key=lambda f: (hashlib.md5(f.encode()).hexdigest(), f))
    while 0 < files < len(listed):
        if df.where(path.isin(listed[:files])).limit(rows).count() >= rows:
            return listed[:files]
        files *= 2
    return None


def sample_row_budget(
    df: DataFrame,
    columns: list[str],
    size_mb: float,
    probe_rows: int = PROBE_ROWS,
    probe_files: int = PROBE_FILES,
) -> DataFrame:
    """How many rows fit into ``size_mb``, judged by the rows of a few files, as one row.

    A table of up to ``probe_files`` files, or one that is not read from files, is weighed
    whole. Of a larger one no other files are opened; ``relative_error`` is then the
    standard error of the rows' average size, as files are drawn and not rows, as a share
    of it. The budget is null for an empty table or rows without any bytes.
    """
    rows = df.select(*[F.col(f"`{c}`") for c in columns])
    chosen = probed_files(rows, probe_rows, probe_files)
    size = row_bytes(columns).cast("long")
    if chosen is None:
        files = rows.agg(F.count("*").alias("r"), F.coalesce(F.sum(size), F.lit(0)).alias("b"))
        left_out = 0.0
    else:
        path = _file_of(rows)
        files = rows.where(path.isin(chosen)).groupBy(path.alias("f"))
        files = files.agg(F.count("*").alias("r"), F.sum(size).alias("b"))
        left_out = 1.0 - len(chosen) / len(df.inputFiles())
    r, b, k = F.col("r").cast("double"), F.col("b").cast("double"), F.count("*")
    average = F.sum(b) / F.nullif(F.sum(r), F.lit(0.0))
    # Deviations of the files' bytes from what their rows would have on average.
    squares = F.sum(b * b) - 2 * average * F.sum(b * r) + average * average * F.sum(r * r)
    spread = F.sqrt(F.lit(left_out) * F.greatest(squares, F.lit(0.0)) * k / (k - 1))
    error = F.when(F.lit(left_out == 0.0), 0.0).when(k > 1, spread / F.sum(b))
    return files.agg(
        F.sum("r").alias("probed_rows"),
        average.alias("avg_row_bytes"),
        F.floor(F.lit(float(size_mb * _MIB)) / F.nullif(average, F.lit(0.0))).alias("row_budget"),
        error.alias("relative_error"),
    )


def _ordered(df: DataFrame, keys: list[str] | None) -> DataFrame:
    """``df`` with its MD5 order, over ``keys`` and then all other columns.

    All columns take part, so rows that share a key are spread like any others.
    """
    first = keys or []
    ordered = [*first, *(c for c in df.columns if c not in first)]
    return df.withColumn("_digest", digest(*[F.col(f"`{c}`") for c in ordered]))


def _slice() -> Column:
    """The slice of a value of the order: its leading zeros and the digits after them.

    So slices are fine where values are small, compare as texts like the values, and are
    few: a digit more in the number of rows adds as many slices as the digit before. No
    slice begins with another.
    """
    zeros = F.length("_digest") - F.length(F.ltrim("_digest", F.lit("0")))
    return F.left("_digest", zeros + SIGNIFICANT)


def _sketch(df: DataFrame, keys: list[str] | None) -> DataFrame:
    """Rows of each slice, as one row ``slices`` in order: tasks sum up their own first."""
    counted = _ordered(df, keys).groupBy(_slice().alias("_slice")).agg(F.count("*").alias("_rows"))
    held = F.collect_list(F.struct("_slice", "_rows"))
    return counted.agg(F.array_sort(held).alias("slices"))


def _threshold(sketch: DataFrame, n: int | Column) -> Column:
    """(last, before): the slice in which the first ``n`` rows end, and the rows before it."""
    n = F.lit(n).cast("long") if isinstance(n, int) else n.cast("long")
    state = "named_struct('last', cast(null as string), 'before', 0L, 'upto', 0L)"
    step = """if(a.upto < coalesce(n, 0L),
        named_struct('last', x._slice, 'before', a.upto, 'upto', a.upto + x._rows), a)"""
    found = F.expr(f"aggregate(slices, {state}, (a, x) -> {step})")
    return sketch.select("slices", n.alias("n")).select(found.alias("found")).scalar()


def sample_rows(df: DataFrame, n: int | Column, keys: list[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), spread evenly and repeatable.

    Rows are taken in the order of an MD5 over ``keys`` and all other columns. A limit
    would send ``n`` rows of every partition through one task; here a sketch of the order
    tells which slices are in, only the rows of those, about ``n``, are shuffled, and only
    the last slice, a few thousandths of them, is cut inside. Equal rows are counted, not
    listed, until the end. ``n`` may be a scalar subquery such as the row budget.
    """
    found = _threshold(_sketch(df, keys), n)
    last, before = found["last"], found["before"]
    n = F.lit(n) if isinstance(n, int) else n
    columns = [F.col(f"`{c}`") for c in df.columns]
    # Up to the last slice, told by as many digits as it has.
    packed = (
        _ordered(df, keys)
        .where(F.left("_digest", F.length(last)) <= last)
        .groupBy("_digest", *columns)
        .agg(F.count("*").alias("_copies"))
        .withColumn("_slice", _slice())
    )
    in_slice = (
        Window.partitionBy("_slice")
        .orderBy("_digest", *columns)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    room = n - before - (F.sum("_copies").over(in_slice) - F.col("_copies"))
    taken = packed.withColumn(
        "_taken",
        F.when(F.col("_slice") < last, F.col("_copies")).otherwise(F.least(F.col("_copies"), room)),
    ).where(F.col("_taken") > 0)
    return expand_ranges(taken, F.lit(1).cast("bigint"), F.col("_taken"), "_copy", by=["_digest"]).select(
        *columns
    )


def sample_to_size(
    df: DataFrame,
    columns: list[str],
    size_mb: float,
    *,
    probe_rows: int = PROBE_ROWS,
    probe_files: int = PROBE_FILES,
    keys: list[str] | None = None,
) -> DataFrame:
    """A sample of the given columns that fits the size, by the row budget."""
    rows = df.select(*[F.col(f"`{c}`") for c in columns])
    budget = sample_row_budget(rows, columns, size_mb, probe_rows, probe_files)
    return sample_rows(rows, budget.select("row_budget").scalar(), keys)


def sample_percent(df: DataFrame, percent: float, seed: int) -> DataFrame:
    """Each row with a chance of ``percent`` in 100: Spark's own sampling in one pass.

    Nothing is hashed or shuffled, but the number of rows varies around the share, and
    they are the same again only while the seed and the table's files and splits are.
    """
    if not 0 <= percent <= 100:
        raise ValueError("a percentage lies between 0 and 100")
    return df.sample(withReplacement=False, fraction=percent / 100, seed=seed)

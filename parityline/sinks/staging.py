"""Staged samples of legacy tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from parityline.functions.names import STAGING_NAMESPACE, STAGING_SUFFIX, staging_table
from parityline.operators.sampling import (
    PROBE_FILES,
    PROBE_ROWS,
    sample_percent,
    sample_row_budget,
    sample_rows,
)
from parityline.sources.catalog import SESSION_CATALOG, quoted, table_columns


class StagingError(Exception):
    """A sample could not be staged."""


def replace_table(rows: DataFrame, target: str) -> None:
    """Put ``rows`` in the place of a table, which stays as it is if anything fails.

    Other catalogs replace a table in one step. The session catalog cannot, so there the
    rows are written to a table beside it, and the two change names when that is complete.
    Readers between the two renames find no table; one that was open reads on.
    """
    spark = rows.sparkSession
    parts = target.split(".")
    if len(parts) == 3 and parts[0] != SESSION_CATALOG:
        rows.writeTo(quoted(target)).createOrReplace()
        return
    made = f"{target}__{uuid.uuid4().hex[:12]}"
    old = f"{made}_old"
    try:
        rows.write.saveAsTable(quoted(made))
        replaced = spark.catalog.tableExists(quoted(target))
        if replaced:
            spark.sql(f"ALTER TABLE {quoted(target)} RENAME TO {quoted(old)}")
        try:
            spark.sql(f"ALTER TABLE {quoted(made)} RENAME TO {quoted(target)}")
        except Exception:
            if replaced:
                spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {quoted(target)}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(made)}")
        raise
    if replaced:
        spark.sql(f"DROP TABLE {quoted(old)}")


def stage_sample(
    spark: SparkSession,
    name: str,
    columns: list[str],
    size_mb: float | None = None,
    *,
    percent: float | None = None,
    seed: int = 0,
    keys: list[str] | None = None,
    probe_rows: int = PROBE_ROWS,
    probe_files: int = PROBE_FILES,
    known: Mapping[str, DataFrame] | None = None,
    namespace: str = STAGING_NAMESPACE,
    suffix: str = STAGING_SUFFIX,
) -> str:
    """Replace the staging table of ``name`` by a sample and return its name.

    With ``size_mb`` the sample is that of ``sample_to_size``: spread over the whole table,
    whatever its files, and the same at every run. What its size allows is found first, so
    that a table without rows, or without room, replaces nothing. With ``percent`` it is
    that of ``sample_percent``. The earlier stage stays until the new one is complete.
    """
    if (size_mb is None) == (percent is None):
        raise ValueError("give either a size or a percentage")
    try:
        target = staging_table(name, namespace, suffix)
        source = table_columns(spark, name, columns, known)
        if percent is not None:
            sample = sample_percent(source, percent, seed)
        else:
            found = sample_row_budget(source, columns, size_mb, probe_rows, probe_files).first()
            if not found["probed_rows"]:
                raise StagingError(f"{name} has no rows")
            if not found["row_budget"] or found["row_budget"] <= 0:
                raise StagingError(f"no rows of {name} fit into {size_mb} MiB")
            sample = sample_rows(source, found["row_budget"], keys)
        replace_table(sample, target)
    except StagingError:
        raise
    except Exception as error:
        raise StagingError(f"cannot stage {name}: {error}") from error
    return target

"""The whole inventory run, from tickets to validation manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.functions.names import base_name, source_name
from parityline.operators.keys import attach_keys, pk_coverage
from parityline.operators.manifest import skipped_schemas, validation_manifest
from parityline.operators.tickets import target_tickets, ticket_funnel
from parityline.session import written
from parityline.sinks.manifest import write_manifest, write_manifest_lines


def named_targets(tickets: DataFrame, source_prefix: str) -> DataFrame:
    """Tickets to process, with full legacy and base table names."""
    return target_tickets(tickets).withColumns(
        {
            "edw_table": source_name(F.col("edw_table"), source_prefix),
            "eds_base_table": base_name(F.col("eds_equivalent_table")),
        }
    )


def run_inventory(
    tickets: DataFrame,
    ingestion_keys: DataFrame,
    view_keys: DataFrame,
    output: str,
    source_prefix: str,
    *,
    lines: bool = False,
    schemas: list[str] | None = None,
) -> dict[str, DataFrame]:
    """Write the manifests and return the one-row reports.

    The merged frame feeds several reports and the manifests, so it is written
    once to the shared folder, until ``discard_written``; nothing is joined twice. ``lines`` is for large
    inventories, where one file per batch would be too many. With ``schemas`` only their
    manifests are written, and those of other schemas stay.
    """
    merged = written(
        attach_keys(named_targets(tickets, source_prefix), ingestion_keys, view_keys),
        "merged",
    )
    manifest = validation_manifest(merged)
    if schemas is not None:
        manifest = manifest.where(F.col("eds_schema").isin(schemas))
    (write_manifest_lines if lines else write_manifest)(manifest, output, whole=schemas is None)
    return {
        "funnel": ticket_funnel(tickets),
        "coverage": pk_coverage(merged),
        "skipped": skipped_schemas(merged),
    }

"""Rules that derive one table name from another."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layer names and what replaces them, applied in this order.
LAYER_REPLACEMENTS = (
    ("silver", "silver_base"),
    ("gold", "gold_base"),
    ("bronze", "bronze_base"),
)
# Suffix of a published view, and the parts of a staging name.
VIEW_SUFFIX = "_vw"
STAGING_NAMESPACE = "dev.general"
STAGING_SUFFIX = "_cw"


def schema_part(name: Column) -> Column:
    """Second dot-separated part, or null when there are fewer than two."""
    return F.get(F.split(name, r"\."), F.lit(1))


def source_name(name: Column, prefix: str) -> Column:
    """Prefix a legacy table name with its catalog; null stays null."""
    return F.concat(F.lit(prefix), name)


def base_name(name: Column, tidy: bool = False) -> Column:
    """Name of the base table behind a published view.

    By default layer names are replaced wherever they occur, so ``gold_base``
    becomes ``gold_base_base``, and only a ``_vw`` at the very end is removed.
    With ``tidy`` every name in a ``/``-separated cell is trimmed and handled on
    its own, a layer counts only as a whole schema part, and its ``_vw`` goes.
    """
    if not tidy:
        for layer, base in LAYER_REPLACEMENTS:
            name = F.replace(name, F.lit(layer), F.lit(base))
        return F.regexp_replace(name, VIEW_SUFFIX + "$", "")
    layers = "|".join(layer for layer, _ in LAYER_REPLACEMENTS)

    def one(part: Column) -> Column:
        based = F.regexp_replace(F.trim(part), rf"\.({layers})\.", ".$1_base.")
        return F.regexp_replace(based, VIEW_SUFFIX + "$", "")

    return F.array_join(F.transform(F.split(name, "/"), one), "/")


def staging_name(
    name: Column, namespace: str = STAGING_NAMESPACE, suffix: str = STAGING_SUFFIX
) -> Column:
    """``catalog.schema.table`` as a staging table; null unless three parts."""
    parts = F.split(name, r"\.")
    return F.when(
        F.size(parts) == 3,
        F.concat(
            F.lit(namespace + "."), F.get(parts, F.lit(1)), F.lit("_"), F.get(parts, F.lit(2)),
            F.lit(suffix),
        ),
    )


def staging_table(
    name: str, namespace: str = STAGING_NAMESPACE, suffix: str = STAGING_SUFFIX
) -> str:
    """``staging_name`` for one name held by the caller; raises if malformed."""
    parts = (name or "").split(".")
    if len(parts) != 3:
        raise ValueError(f"expected catalog.schema.table, got {name!r}")
    return f"{namespace}.{parts[1]}_{parts[2]}{suffix}"

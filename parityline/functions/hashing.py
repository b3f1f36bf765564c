"""Row fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    MapType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_PLAIN = (
    NumericType, StringType, BooleanType, DateType, TimestampType, TimestampNTZType, BinaryType,
)


def _has_map(dtype: DataType) -> bool:
    if isinstance(dtype, MapType):
        return True
    if isinstance(dtype, ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return False


def sorted_maps(col: Column, dtype: DataType) -> Column:
    """``col`` with every map, at any depth, as an array sorted by its key."""
    if not _has_map(dtype):
        return col
    if isinstance(dtype, MapType):
        entries = F.array_sort(
            F.map_entries(col),
            lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0),
        )
        return F.transform(
            entries,
            lambda e: F.struct(
                e["key"].alias("key"), sorted_maps(e["value"], dtype.valueType).alias("value")
            ),
        )
    if isinstance(dtype, ArrayType):
        return F.transform(col, lambda x: sorted_maps(x, dtype.elementType))
    fields = [sorted_maps(col[f.name], f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(col.isNotNull(), F.struct(*fields))


def row_hash(
    schema: StructType,
    columns: list[str],
    *,
    null_safe: bool = False,
    wide: bool = False,
    normalize_maps: bool = False,
    typed: bool = False,
) -> Column:
    """Hash of ``columns`` cast to string; the constant 1 when there are none.

    The default is 32-bit Murmur3, which skips nulls. ``null_safe`` hashes each
    null flag too, ``wide`` uses 64 bits, and ``normalize_maps`` ignores the
    order of map entries. ``typed`` hashes plain values as they are: writing out
    floating-point numbers is most of the work, and SQL equality does not need
    it (it makes 0.0 and -0.0 equal). Nested values stay text.
    """
    if not columns:
        return F.lit(1)
    inputs = []
    for name in columns:
        col = F.col(f"`{name}`")
        if normalize_maps:
            col = sorted_maps(col, schema[name].dataType)
        if not (typed and isinstance(schema[name].dataType, _PLAIN)):
            col = col.cast("string")
        inputs += [col.isNull(), col] if null_safe else [col]
    return (F.xxhash64 if wide else F.hash)(*inputs)


def digest(*columns: Column) -> Column:
    """MD5 over the given columns as text: a repeatable, evenly spread order.

    Its leading hex digits cut any number of rows into equal ranges that follow
    the same order, without sampling the data first.
    """
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in columns]))

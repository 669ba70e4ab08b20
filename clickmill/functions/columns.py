"""Column expressions shared by the operators; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rate_column(name: str) -> str:
    """Name of the column that holds the value rates of category ``name``."""
    return f"{name}_rate"


def text_value(df: DataFrame, name: str) -> Column:
    """Text of a column such that two values have equal text exactly when they are equal.

    Needed to put columns of different types below each other.
    """
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # -0.0 and 0.0 are one value.
        return (column + F.lit(0.0)).cast("string")
    if isinstance(kind, T.TimestampType):
        # Local times repeat when clocks are set back, instants do not.
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        raise TypeError(f"column {name!r} of type {kind.simpleString()} has no plain text form")
    return column.cast("string")


def value_rate(count: Column, rows: Column | int) -> Column:
    """Share of all rows, nulls included; 0.0 for a missing or zero count."""
    return F.coalesce(F.try_divide(count.cast("double"), F.lit(rows)), F.lit(0.0))


def equal_width_bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based bin of ``value``: half-open bins, the last one closed, null stays null.

    A constant column has width 0 and puts every row in bin 0.
    """
    width = (hi - lo).cast("double") / F.lit(float(bins))
    position = F.floor((value - lo) / F.nullif(width, F.lit(0.0)))
    found = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    return F.when(value.isNotNull(), found)


def md5_uniform(key: Column) -> Column:
    """Number in [0, 1) that depends on the text of ``key`` alone.

    The same on any cluster, partitioning and engine.
    """
    head = F.substring(F.md5(key), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(4294967296.0)

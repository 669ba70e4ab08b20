"""Column names, roles and types of the click log."""

from __future__ import annotations

from pyspark.sql import types as T

LABEL = "label"
INT_COLS = [f"I{n}" for n in range(1, 14)]
CAT_COLS = [f"C{n}" for n in range(1, 27)]

# Categories that are encoded when the caller names none.
ENCODED_CAT_COLS = ["C20", "C17"]

CLICK_SCHEMA = T.StructType(
    [T.StructField(LABEL, T.IntegerType())]
    + [T.StructField(name, T.LongType()) for name in INT_COLS]
    + [T.StructField(name, T.StringType()) for name in CAT_COLS]
)


def role_of_position(position: int) -> str:
    """Role of the column at a 1-based position: label, integer or categorical."""
    if not 1 <= position <= len(CLICK_SCHEMA):
        raise ValueError(f"position {position} is outside 1..{len(CLICK_SCHEMA)}")
    if position == 1:
        return "label"
    return "integer" if position <= 1 + len(INT_COLS) else "categorical"

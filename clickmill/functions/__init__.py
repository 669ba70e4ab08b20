from clickmill.functions.columns import (
    equal_width_bin,
    md5_uniform,
    rate_column,
    text_value,
    value_rate,
)

__all__ = [
    "equal_width_bin",
    "md5_uniform",
    "rate_column",
    "text_value",
    "value_rate",
]

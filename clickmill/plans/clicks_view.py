"""A click log derived row by row from the ``lineitem`` table.

The same select runs in Spark and in ANSI SQL engines, but for the spelling of ``u``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from clickmill.schema import CAT_COLS, INT_COLS, LABEL
from clickmill.session import spread

KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]

_ROW_TEXT = (
    "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', "
    "cast(l_partkey as string){salt})"
)
_UNIFORM = {
    "spark": "cast(conv(substr(md5({text}), 1, 8), 16, 10) as bigint) / 4294967296.0D",
    "duckdb": "cast('0x' || substr(md5({text}), 1, 8) as bigint) / 4294967296.0::double",
}


def uniform_sql(dialect: str, salt: str = "") -> str:
    """Number in [0, 1) that depends on the row's keys and the salt."""
    text = _ROW_TEXT.format(salt=f", '{salt}'" if salt else "")
    return _UNIFORM[dialect].format(text=text)


_INTEGERS = {
    "I1": "cast(nullif(l_linenumber, 3) as bigint)",
    "I2": "cast(floor(l_quantity) as bigint) - 4",
    "I3": "cast(floor(case when l_partkey % 4 = 0 then null else l_extendedprice end) as bigint)",
    "I4": "nullif(l_partkey % 10, 0)",
    "I5": "cast(floor(l_discount * 100) as bigint)",
    "I6": "cast(floor(case when l_suppkey % 5 = 0 then null else l_tax * 100 end) as bigint)",
    "I7": "l_orderkey % 1000",
    "I8": "l_suppkey % 100",
    "I9": "cast(year(l_shipdate) as bigint) - 1990",
    "I10": "cast(nullif(month(l_shipdate), 12) as bigint)",
    "I11": "cast(day(l_shipdate) as bigint)",
    "I12": "case when l_orderkey % 4 = 0 then l_partkey % 1808 end",
    "I13": "cast(floor(l_extendedprice * l_extendedprice / 100000) as bigint)",
}

# Hexadecimal text of a number below 2^32, spread over up to eight digits.
_CODE = "hex(({number}) * 40503 % 4294967296)"

# Number behind each category and the condition under which the category is missing.
_NUMBERS = {
    "C1": ("l_suppkey % 1400", None),
    "C2": ("l_partkey % 550", None),
    "C3": ("(l_orderkey * 7 + l_linenumber) % 4294967296", "l_linenumber = 5"),
    "C4": ("(l_orderkey * 11 + l_partkey) % 4294967296", "l_linenumber = 5"),
    "C5": ("l_orderkey % 300", None),
    "C6": ("l_suppkey % 20", "l_orderkey % 8 = 0"),
    "C7": ("l_partkey % 12000", None),
    "C8": ("l_suppkey % 600", None),
    "C10": ("l_orderkey % 90000", None),
    "C11": ("l_partkey % 5000", None),
    "C12": ("(l_orderkey * 13 + l_suppkey) % 4294967296", "l_linenumber = 5"),
    "C13": ("l_suppkey % 3000", None),
    "C14": ("l_orderkey % 26", None),
    "C15": ("l_partkey % 14000", None),
    "C16": ("l_orderkey % 4294967296", "l_linenumber = 5"),
    "C18": ("l_partkey % 4600", None),
    "C19": ("l_partkey % 2000", "l_orderkey % 2 = 0"),
    "C21": ("l_partkey % 4294967296", "l_linenumber = 5"),
    "C22": ("l_suppkey % 18", "l_partkey % 4 <> 0"),
    "C23": ("l_orderkey % 15", None),
    "C24": ("l_orderkey % 280000", "l_linenumber = 5"),
    "C25": ("l_suppkey % 95", "l_orderkey % 2 = 0"),
    "C26": ("l_partkey % 140000", "l_orderkey % 2 = 0"),
}
_TEXTS = {
    "C9": "substr(md5(cast(l_partkey as string)), 1, 8)",
    "C17": "case when l_suppkey % 7 = 0 then null "
    "else substr(md5(cast(l_suppkey as string)), 1, 8) end",
    "C20": "nullif(l_returnflag, 'N')",
}


def _category(name: str) -> str:
    if name in _TEXTS:
        return _TEXTS[name]
    number, missing = _NUMBERS[name]
    code = _CODE.format(number=number)
    return f"case when {missing} then null else {code} end" if missing else code


def clicks_columns(dialect: str) -> dict[str, str]:
    """SQL expression of every column of the view: keys, label, I1..I13, C1..C26."""
    chance = f"0.5 * l_quantity / 50 + 0.5 * ({uniform_sql(dialect)})"
    return {
        **{key: key for key in KEYS},
        LABEL: f"cast(case when {chance} > 0.65 then 1 else 0 end as int)",
        **{name: _INTEGERS[name] for name in INT_COLS},
        **{name: _category(name) for name in CAT_COLS},
    }


def clicks_select(dialect: str) -> list[str]:
    return [f"{text} as {name}" for name, text in clicks_columns(dialect).items()]


def clicks_sql() -> str:
    """The view as a ``with`` clause for DuckDB."""
    return f"with clicks as (select {', '.join(clicks_select('duckdb'))} from lineitem)"


# Rows of the log that one task of a dealt-out table gets at most, about. All 26 categories
# of so many rows are counted in a quarter of a GB.
ROWS_PER_TASK = 500_000


def read_spread(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """A table, dealt out to all cores if it is a single file, which may be a single task.

    Large ones are dealt out to more tasks than there are cores, so that no task grows with
    the table. Rows are counted from the footer of the file.
    """
    rows = spark.read.parquet(path)
    if len(rows.inputFiles()) != 1:
        return rows
    tasks = math.ceil(rows.count() / ROWS_PER_TASK)
    return spread(rows, max(tasks, spark.sparkContext.defaultParallelism), *keys)


def clicks_with_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_spread(spark, f"{sf_dir}/lineitem.parquet", *KEYS)
    return rows.selectExpr(*clicks_select("spark"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view with exactly the columns of ``CLICK_SCHEMA``."""
    return clicks_with_keys(spark, sf_dir).select(LABEL, *INT_COLS, *CAT_COLS)

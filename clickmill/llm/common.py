"""What several operators share: folds, written intermediate tables, sums of arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.text import Texts, chunks
from clickmill.session import write_table

# A set of rows is sent to every executor only below this size; beyond it, rows are shuffled.
BROADCAST_BYTES = 32 << 20

ARROW_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_ROWS = 1000

# Words of a text, as SQL functions see them.
WORD = r"[^\x20\x09-\x0D]+"


def prepare_session(spark: SparkSession) -> None:
    """What the registered queries and the pipeline ask of their session.

    Batches between executors and Python workers hold fewer rows than Spark's default: rows
    are whole documents, and a batch is held several times over. Python workers that share
    this machine's files import the package from here; a cluster without them gets it with
    the job (``--py-files``).
    """
    # 0 and less mean no limit.
    if not 0 < int(spark.conf.get(ARROW_ROWS_KEY)) <= ARROW_ROWS:
        spark.conf.set(ARROW_ROWS_KEY, ARROW_ROWS)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores before it until no column of ``taken`` has it."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


def store(df: DataFrame, name: str) -> DataFrame:
    """Write once below the shared folder and scan the written table from then on."""
    return write_table(df, name)


def fold(column: str, n: int) -> Column:
    """Fold 0 to n - 1 of a row by the CRC-32 of a column's text; null counts as empty."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(n)).cast("int")


def bounded_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df``, marked to be sent to every executor if its counted rows are small enough."""
    if df.count() * row_bytes <= BROADCAST_BYTES:
        return F.broadcast(df)
    return df


def array_column(rows: np.ndarray) -> pa.Array:
    """A matrix as a list column, one list per row."""
    rows = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def list_column(lists: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrays of different lengths as a list column."""
    offsets = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    values = np.concatenate(lists) if lists else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


def sum_arrays(rows: DataFrame, key: str, values: str) -> dict[int, np.ndarray]:
    """Element-wise sum of equally long arrays by key, for few keys and short arrays."""
    parts = rows.select(key, F.posexplode(values).alias("at", "value"))
    sums = parts.groupBy(key, "at").agg(F.sum("value").alias("value")).collect()
    found: dict[int, dict[int, float]] = {}
    for k, at, value in sums:
        found.setdefault(k, {})[at] = value
    return {k: np.array([v[i] for i in range(len(v))]) for k, v in found.items()}


def filter_texts(
    docs: DataFrame, keep: Callable[[Texts], np.ndarray], text: str = "text"
) -> DataFrame:
    """Rows whose text passes ``keep``, decided batch by batch; all columns are returned."""
    at = docs.columns.index(text)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch.column(at)):
                piece = batch.slice(rows.start, rows.stop - rows.start)
                yield piece.filter(pa.array(keep(texts)))

    return docs.mapInArrow(compute, docs.schema)

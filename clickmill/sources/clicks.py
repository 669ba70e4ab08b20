"""Tab-separated click logs: one record per line, no header, no quoting."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.schema import CLICK_SCHEMA
from clickmill.session import configured, spread

SEPARATOR = "\t"


def read_lines(
    spark: SparkSession, path: str | list[str], tasks: int | None = None
) -> DataFrame:
    """Raw lines as one ``value`` column; compressed files and folders read alike.

    ``tasks`` deals the lines out, for files that cannot be split.
    """
    return spread(spark.read.text(path), tasks)


def _typed(text: Column, field: T.StructField, ansi: bool) -> Column:
    """Field text as its type; malformed text fails the job in any session mode."""
    kind = field.dataType
    if isinstance(kind, T.StringType):
        return text
    if ansi:
        return text.cast(kind)
    message = F.concat(F.lit(f"malformed {field.name}: "), text)
    parsed = F.coalesce(text.try_cast(kind), F.raise_error(message).cast(kind))
    return F.when(text.isNotNull(), parsed)


def parse_lines(
    lines: DataFrame,
    schema: T.StructType = CLICK_SCHEMA,
    column: str = "value",
    validate: bool = False,
) -> DataFrame:
    """Typed rows from a column of lines.

    An empty field is null; blanks around an integer are accepted. A line with another
    number of fields and a malformed integer fail any job that reads the column they
    spoil; columns that a job does not read are not looked at. With ``validate`` every job
    looks at every field of every line, also one that only counts rows. ``validate_log``
    counts broken lines without failing.
    """
    width = len(schema)
    fields = F.split(F.col(column), SEPARATOR, -1)
    wrong = F.format_string(f"expected {width} fields, found %d: %s", F.size(fields), F.col(column))
    ansi = lines.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"
    if validate:
        broken = F.concat(F.lit("malformed line: "), F.col(column))
        # A filter computes an expression wherever it is named: as the variable of a
        # lambda the fields are split once a line, not once a test.
        sound = F.exists(
            F.array(fields), lambda own: (F.size(own) == width) & ~_malformed(own, schema)
        )
        refused = F.when(F.size(fields) == width, F.raise_error(broken).cast("boolean"))
        refused = refused.otherwise(F.raise_error(wrong).cast("boolean"))
        lines = lines.where(F.when(sound, F.lit(True)).otherwise(refused))
    # Fields are a column of their own first, which the tests below read: a line is split once.
    lines = lines.select(F.col(column), fields.alias("fields"))
    fits = F.size("fields") == width
    checked = F.when(fits, F.col("fields")).otherwise(F.raise_error(wrong))
    # Empty text turns null once for the whole array: the same test on every field
    # grows the generated method beyond what the JIT compiles (4x slower).
    cleaned = F.transform(checked, lambda text: F.nullif(text, F.lit("")))
    return lines.select(cleaned.alias("fields")).select(
        *[
            _typed(F.col("fields")[position], field, ansi).alias(field.name)
            for position, field in enumerate(schema)
        ]
    )


def _malformed(fields: Column, schema: T.StructType) -> Column:
    """Whether a field that is to be a number is none."""
    bad = F.lit(False)
    for position, field in enumerate(schema):
        if not isinstance(field.dataType, T.StringType):
            text = F.nullif(F.get(fields, F.lit(position)), F.lit(""))
            bad = bad | (text.isNotNull() & text.try_cast(field.dataType).isNull())
    return bad


def validate_log(
    lines: DataFrame, schema: T.StructType = CLICK_SCHEMA, column: str = "value"
) -> DataFrame:
    """One row ``(n_lines, wrong_width, malformed)`` over all lines.

    ``malformed`` counts lines of the right width with a number that cannot be read.
    """
    fields = F.split(F.col(column), SEPARATOR, -1)
    fits = F.size(fields) == len(schema)
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(~fits).alias("wrong_width"),
        F.count_if(fits & _malformed(fields, schema)).alias("malformed"),
    )


@dataclass
class Ingested:
    """Rows and rejected lines of a log, both written, and how many of each there were."""

    rows: DataFrame
    rejects: DataFrame
    n_lines: int
    n_rejects: int


def mark_rejects(
    lines: DataFrame, schema: T.StructType = CLICK_SCHEMA, column: str = "value"
) -> DataFrame:
    """Typed rows with ``line`` and ``reason``, which are null for lines that can be read.

    A rejected line keeps its text and says why: its number of fields, or the first field
    that is to be a number and is none.
    """
    width = len(schema)
    fields = F.transform(
        F.split(F.col(column), SEPARATOR, -1), lambda text: F.nullif(text, F.lit(""))
    )
    parsed = lines.select(F.col(column).alias("line"), fields.alias("fields"))

    def text(position: int) -> Column:
        return F.get("fields", F.lit(position))

    wrong = F.concat(F.lit(f"expected {width} fields, found "), F.size("fields").cast("string"))
    reasons = [F.when(F.size("fields") != width, wrong)]
    for position, field in enumerate(schema):
        if not isinstance(field.dataType, T.StringType):
            unread = text(position).isNotNull() & text(position).try_cast(field.dataType).isNull()
            message = F.concat(F.lit(f"malformed {field.name}: "), text(position))
            reasons.append(F.when(unread, message))
    marked = parsed.select("line", "fields", F.coalesce(*reasons).alias("reason"))
    rejected = F.col("reason").isNotNull()
    return marked.select(
        *[
            F.when(~rejected, text(position).try_cast(field.dataType)).alias(field.name)
            for position, field in enumerate(schema)
        ],
        F.when(rejected, F.col("line")).alias("line"),
        "reason",
    )


def ingest_log(
    lines: DataFrame,
    path: str,
    schema: T.StructType = CLICK_SCHEMA,
    column: str = "value",
    mode: str = "errorifexists",
) -> Ingested:
    """Parse a log once into a table of rows and a table of rejected lines below ``path``.

    One job reads, parses and writes both: no line fails it, and none is read twice. The
    counts are read from the footers of the written files. (An ``Observation`` of the
    writing job would count too, but leaves the session with a part that cannot be
    serialized, after which Spark's model training fails in it.)
    """
    kind = F.when(F.col("reason").isNull(), "rows").otherwise("rejects")
    marked = mark_rejects(lines, schema, column).withColumn("kind", kind)
    settings = {
        # A task holds both files open; sorting its rows by kind first would spill them all.
        "spark.sql.maxConcurrentOutputFileWriters": "2",
        # No method that is too long for the JIT.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    with configured(lines.sparkSession, settings):
        marked.write.mode(mode).partitionBy("kind").parquet(path)
    written = lines.sparkSession.read.schema(marked.schema).parquet(path)
    found = dict(written.groupBy("kind").agg(F.count(F.lit(1))).collect())
    n_rejects = found.get("rejects", 0)
    return Ingested(
        written.where("kind = 'rows'").select(*schema.names),
        written.where("kind = 'rejects'").select("line", "reason"),
        found.get("rows", 0) + n_rejects,
        n_rejects,
    )


def read_clicks(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = CLICK_SCHEMA,
    validate: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Click log as a DataFrame with a fixed schema; see ``parse_lines``."""
    return parse_lines(read_lines(spark, path, tasks), schema, validate=validate)


def to_lines(df: DataFrame) -> DataFrame:
    """Inverse of ``parse_lines``: one ``value`` column, null as an empty field.

    A value that holds a tab or line break has no place in the format and fails the job.
    """
    texts: list[Column] = []
    for is_text, run in groupby(df.schema, lambda field: isinstance(field.dataType, T.StringType)):
        columns = [F.col(field.name) for field in run]
        if is_text:
            texts += [F.coalesce(column, F.lit("")) for column in columns]
        else:
            # Numbers go as one array: a projection with a lambda is compiled in small
            # methods, otherwise all columns make one that is too long for the JIT.
            numbers = F.array(*[column.cast("string") for column in columns])
            texts.append(F.transform(numbers, lambda text: F.coalesce(text, F.lit(""))))
    tabs = F.length("value") - F.length(F.replace("value", F.lit(SEPARATOR), F.lit("")))
    breaks = F.contains("value", F.lit("\n")) | F.contains("value", F.lit("\r"))
    valid = (tabs == len(df.columns) - 1) & ~breaks
    wrong = F.concat(F.lit("tab or line break inside a field: "), F.col("value"))
    return df.select(F.concat_ws(SEPARATOR, *texts).alias("value")).select(
        F.when(valid, F.col("value")).otherwise(F.raise_error(wrong)).alias("value")
    )


def write_lines(
    lines: DataFrame,
    path: str,
    partition_by: str | None = None,
    compression: str = "gzip",
    mode: str = "errorifexists",
) -> None:
    """Write lines as text; with ``partition_by`` one pass fills one folder per value."""
    writer = lines.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.text(path)


def write_clicks(
    df: DataFrame, path: str, compression: str = "gzip", mode: str = "errorifexists"
) -> None:
    """Write rows as a tab-separated click log."""
    write_lines(to_lines(df), path, compression=compression, mode=mode)

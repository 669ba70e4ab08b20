"""Session set-up and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "clickmill", **conf: str) -> SparkSession:
    """Session with runtime re-planning on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def has_shared_folder(spark: SparkSession) -> bool:
    """Whether the session names a folder that driver and executors share."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return bool(configured or spark.sparkContext.getCheckpointDir())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    For files that are written and read back. A temporary folder stands in only in local
    mode, where driver and executors share one disk; intermediate results do not use it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="clickmill-")
    return _local_folders[context.applicationId]


_local_folders: dict[str, str] = {}


@contextmanager
def configured(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Hold settings of the session for the jobs of a block."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def files_per_task(spark: SparkSession, files: int) -> Iterator[None]:
    """Scans that run in the block read up to so many files a task, whatever their size.

    Fewer where the files would not fill all cores.
    """
    file_weight = 1 << 40
    settings = {
        "spark.sql.files.openCostInBytes": str(file_weight),
        "spark.sql.files.maxPartitionBytes": str(files * file_weight),
    }
    with configured(spark, settings):
        yield


def spread(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """Deal the rows of a scan out to ``tasks`` tasks; ``None`` leaves it as it is.

    For inputs that are one task however large they are, as a gzip file or a parquet file
    with one row group. Rows are dealt in turn, which sorts them first to be repeatable, or
    by ``keys`` that name each row. Results that depend on the partitioning, as random
    splits do, depend on ``tasks``, not on the size of the cluster.
    """
    return df.repartition(tasks, *keys) if tasks else df


_scopes: list[list[str | DataFrame]] = []


@contextmanager
def intermediate_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, the tables that ``materialize`` made in it.

    Results that read such tables must be written or collected within the block.
    """
    made: list[str | DataFrame] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for table in made:
            if isinstance(table, DataFrame):
                table.unpersist()
            else:
                path = spark._jvm.org.apache.hadoop.fs.Path(table)
                path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(
                    path, True
                )


def write_parts(df: DataFrame, name: str, part: str, parts: int, rows_per_file: int) -> DataFrame:
    """``materialize`` in a folder for each value of ``part``, so that a scan of some values
    reads no others.

    Tasks write their values side by side, ``parts`` of them, without sorting or shuffling
    rows, in files of at most ``rows_per_file`` rows.
    """
    spark = df.sparkSession
    if not has_shared_folder(spark):
        return materialize(df, name)
    settings = {
        "spark.sql.maxConcurrentOutputFileWriters": str(parts + 1),
        "spark.sql.files.maxRecordsPerFile": str(rows_per_file),
    }
    path = f"{shared_folder(spark)}/clickmill/{name}-{uuid.uuid4().hex}"
    with configured(spark, settings):
        df.write.partitionBy(part).parquet(path)
    _remember(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def _remember(table: str | DataFrame, outlives: bool = False) -> None:
    scopes = _scopes[:-1] if outlives else _scopes
    if scopes:
        scopes[-1].append(table)


def write_table(
    df: DataFrame, name: str, partition_by: str | None = None, outlives: bool = False
) -> DataFrame:
    """Write ``df`` once below the shared folder and return a scan of the written table.

    The table survives lost executors and gives later steps column pruning,
    pushed filters and real sizes, which a cached plan would not. A table that ``outlives``
    the innermost block of ``intermediate_tables`` goes with the block around it, if any.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/clickmill/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        # Rows of one value meet in few tasks, so that they fill few files.
        writer = df.hint("rebalance", partition_by).write.partitionBy(partition_by)
    writer.parquet(path)
    _remember(path, outlives)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Compute ``df`` once for several readers.

    Written as a table where the session has a shared folder. Without one the rows are
    cached in the executors: a lost executor costs computing its part again, but no file
    lies where only one machine sees it.
    """
    spark = df.sparkSession
    if has_shared_folder(spark):
        return write_table(df, name, partition_by)
    kept = df.persist()
    _remember(kept)
    return kept

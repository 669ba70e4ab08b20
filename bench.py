"""Times headline queries and prints one JSON line.

Every query runs once to warm up and then ``BENCH_RUNS`` times (3, fewer if slow), of which
the median counts. Fused queries are timed beside the form that asks one job per column, as
``<name>_per_column``; the metric adds up the fused queries only.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickmill.operators import split  # noqa: E402
from clickmill.plans import registry  # noqa: E402
from clickmill.plans.clicks_view import clicks  # noqa: E402
from clickmill.schema import CAT_COLS, INT_COLS  # noqa: E402
from clickmill.session import intermediate_tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
MOST_SECONDS = 30.0

HEADLINES = [
    "row_count",
    "numeric_stats",
    "numeric_means",
    "int_histograms",
    "label_histogram",
    "category_counts",
    "top_categories_clicks",
    "top_categories_summaries",
    "distinct_counts",
    "hash_split",
    "split_exact",
    "ingest_rows",
    "split_files_roundtrip",
    "split_lines_write",
    "freq_encode_transform",
    "freq_encode_transform_large",
    "impute_truncate",
    "features_train",
    "roc_curve",
    "roc_auc",
    "roc_auc_difference",
    "cv_encode",
    "lr_predictions",
    "rf_predictions",
    "model_roc_auc",
]


def stats_per_column(spark: SparkSession) -> None:
    rows = clicks(spark, SF_DIR)
    for name in INT_COLS:
        for moment in (F.avg, F.stddev, F.skewness, F.kurtosis):
            rows.select(moment(name)).collect()


def means_per_column(spark: SparkSession) -> None:
    rows = clicks(spark, SF_DIR)
    for name in INT_COLS:
        rows.select(F.avg(name)).collect()


def counts_per_column(spark: SparkSession) -> None:
    rows = clicks(spark, SF_DIR)
    for name in CAT_COLS:
        run(rows.groupBy(name).count())


def histograms_per_column(spark: SparkSession) -> None:
    rows = clicks(spark, SF_DIR)
    for name in INT_COLS:
        lo, hi = rows.select(F.min(name), F.max(name)).first()
        width = (hi - lo) / 10
        run(rows.groupBy(F.least(F.floor((F.col(name) - lo) / width), F.lit(9))).count())


def top_per_column(spark: SparkSession) -> None:
    rows = clicks(spark, SF_DIR)
    for name in CAT_COLS:
        rows.groupBy(name).count().orderBy(F.desc("count")).limit(10).collect()


def split_per_part(spark: SparkSession) -> None:
    """Four saves, each of which draws and scans again."""
    lines = registry._row_lines(spark, SF_DIR)
    weights = list(split.ALL_WEIGHTS.values())
    for part in lines.randomSplit(weights, seed=0):
        run(part)


PER_COLUMN = {
    "int_histograms_per_column": histograms_per_column,
    "top_categories_clicks_per_column": top_per_column,
    "split_lines_write_per_part": split_per_part,
    "numeric_stats_per_column": stats_per_column,
    "numeric_means_per_column": means_per_column,
    "category_counts_per_column": counts_per_column,
}


def run(df) -> None:
    """Compute every row and column without sending them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def timed(spark: SparkSession, action) -> float:
    """Median seconds of some runs after one that does not count.

    Slow actions get fewer runs, one at least, so that the whole bench ends in time.
    """
    seconds: list[float] = []
    while len(seconds) <= RUNS and (len(seconds) < 2 or sum(seconds) < MOST_SECONDS):
        with intermediate_tables(spark):
            start = time.perf_counter()
            action()
            seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("clickmill-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clickmill-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = registry.queries()
    fused = {name: timed(spark, lambda: run(known[name](spark, SF_DIR))) for name in HEADLINES}
    single = {name: timed(spark, lambda: action(spark)) for name, action in PER_COLUMN.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(fused.values()), 3),
                "unit": "sec",
                "queries": {**fused, **single},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

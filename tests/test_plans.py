import os
import random

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point
from clickmill import session
from clickmill.operators.split import write_splits
from clickmill.plans import clicks_view, workflow
from clickmill.schema import CAT_COLS, INT_COLS
from clickmill.session import intermediate_tables, materialize, shared_folder
from clickmill.sources import read_lines

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def plain(rows, columns):
    def text(value):
        if value is None or (not isinstance(value, str) and pd.isna(value)):
            return "NULL"
        return repr(float(value)) if not isinstance(value, str) else value

    return sorted(tuple(text(row[name]) for name in columns) for row in rows)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    result = entry_point.queries()[name](spark, sf_dir)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    expected = [dict(zip(columns, row)) for row in cursor.fetchall()]
    assert plain([row.asDict() for row in result.collect()], columns) == plain(expected, columns)


def test_registered_sql_has_queries():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert len(entry_point.queries()) > 45


def test_models_find_the_signal(spark, sf_dir):
    rows = entry_point.entry(spark).collect()
    assert [row["model"] for row in rows] == ["LogisticRegression", "RandomForestOfRegressionTrees"]
    for row in rows:
        assert row["auc"] > 0.7 and 0.5 <= row["hard_auc"] <= 1.0 and row["rows"] > 2000


def log_line(rng):
    clicked = rng.random() < 0.25
    integers = [str(rng.randrange(50) + 40 * clicked) if rng.random() < 0.9 else "" for _ in INT_COLS]
    texts = [rng.choice(["", "68fd1e64", f"{rng.randrange(40):08x}"]) for _ in CAT_COLS]
    return "\t".join([str(int(clicked)), *integers, *texts])


def test_log_to_evaluation(spark, tmp_path):
    """Raw text log, split files, training and evaluation in two modes."""
    rng = random.Random(6)
    (tmp_path / "train.txt").write_text("".join(log_line(rng) + "\n" for _ in range(4000)))
    root = str(tmp_path)
    write_splits(read_lines(spark, f"{root}/train.txt"), f"{root}/split")
    run = workflow.run_mode(spark, root, "test")
    assert set(run.models) == {"lr", "rf"}
    for evaluation in run.evaluations.values():
        assert evaluation.summary.first()["dataset"] == "test_3m"
        assert evaluation.summary.first()["auc"] > 0.9
    production = workflow.run_mode(spark, root, "production")
    assert set(production.models) == {"rf"}
    assert production.evaluations["rf"].name == "RandomForestOfRegressionTrees-test"
    assert production.evaluations["rf"].summary.first()["rows"] > 2900
    with pytest.raises(ValueError):
        workflow.run_mode(spark, root, "other")


def test_kept_scores_are_computed_once_for_all_readers(spark):
    rng = random.Random(8)
    rows = [(i % 2, rng.randrange(20) + 5 * (i % 2), rng.choice("ab")) for i in range(400)]
    df = spark.createDataFrame(rows, "label int, I1 long, C1 string")
    run = workflow.run(df, df, ("rf",), ["I1"], ["C1"], scores_kept=True)
    kept = run.scores["rf"]
    assert all("/scores-" in path for path in kept.inputFiles()) and kept.inputFiles()
    again = run.predictions["rf"].select(*kept.columns)
    assert sorted(kept.collect()) == sorted(again.collect())
    said = run.evaluations["rf"].summary.first()
    assert (said["rows"], said["positives"]) == (400, 200)
    assert said["auc"] > 0.5


def test_intermediate_tables_go_to_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == configured
    table = materialize(spark.range(3), "three")
    assert all(configured in path for path in table.inputFiles())


def test_intermediate_tables_are_deleted_at_the_end_of_their_block(spark):
    with intermediate_tables(spark):
        table = materialize(spark.range(3), "three")
        files = [path.removeprefix("file://") for path in table.inputFiles()]
        assert files and all(os.path.exists(path) for path in files)
    assert not any(os.path.exists(path) for path in files)
    kept = materialize(spark.range(3), "three")
    assert kept.count() == 3


def test_without_a_shared_folder_rows_are_cached(spark, monkeypatch):
    monkeypatch.setattr(session, "has_shared_folder", lambda _: False)
    with intermediate_tables(spark):
        table = materialize(spark.range(3), "three")
        assert table.is_cached and table.inputFiles() == []
        assert entry_point.queries()["roc_auc"](spark, "/root/testdata/sf0.001").count() == 1
    assert not table.is_cached


def test_a_large_file_is_dealt_out_by_its_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows.parquet")
    spark.range(1000).coalesce(1).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert clicks_view.read_spread(spark, path, "id").rdd.getNumPartitions() == cores
    monkeypatch.setattr(clicks_view, "ROWS_PER_TASK", 50)
    dealt = clicks_view.read_spread(spark, path, "id")
    assert dealt.rdd.getNumPartitions() == 20 and dealt.distinct().count() == 1000

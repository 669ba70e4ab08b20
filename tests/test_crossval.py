import random
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickmill.operators import crossval, encode, model
from clickmill.operators.model import train_lr

FOLDS = 4


def rows(rng, n=400):
    return [
        (i, int(rng.random() < 0.3 + 0.4 * (i % 2)), rng.choice([None, i % 2 * 5, rng.randrange(9)]),
         rng.choice(["hot", None, f"v{rng.randrange(40)}"]), rng.choice("ab"))
        for i in range(n)
    ]


@pytest.fixture
def folded(spark):
    df = spark.createDataFrame(rows(random.Random(1)), "id int, label int, I1 int, C1 string, C2 string")
    return crossval.with_folds(df, FOLDS, F.col("id").cast("string")).cache()


def test_rates_are_those_of_the_other_folds(folded):
    counts = crossval.fold_counts(folded, ["C1", "C2"], FOLDS)
    sizes = crossval.fold_sizes(folded, FOLDS)
    said = [r.asDict() for r in folded.collect()]
    assert sizes == [sum(r["fold"] == f for r in said) for f in range(FOLDS)]
    for row in crossval.held_out_rates(counts, sizes).collect():
        for fold in range(FOLDS):
            others = [r[row["column"]] for r in said if r["fold"] != fold]
            assert row["rates"][fold] == pytest.approx(Counter(others)[row["value"]] / len(others))


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_features_equal_an_encoding_fitted_on_the_other_folds(folded, options):
    encoding = crossval.fit_folds(folded, FOLDS, ["I1"], ["C1", "C2"])
    encoded = encoding.encode(folded, **options).cache()
    for fold in range(FOLDS):
        fitted = encode.fit_features(folded.where(F.col("fold") != fold), ["I1"], ["C1", "C2"])
        want = fitted.transform(folded).select("id", vector_to_array("features").alias("f"))
        got = encoded.select("id", vector_to_array(encoding.features(fold)).alias("f"))
        want = {r["id"]: r["f"] for r in want.collect()}
        got = {r["id"]: r["f"] for r in got.collect()}
        assert got.keys() == want.keys()
        for key in want:
            assert got[key] == pytest.approx(want[key]), (fold, key)


def test_every_row_is_scored_once_by_the_other_folds(folded):
    df = folded.drop("fold")
    scored = crossval.cross_validate(
        df, FOLDS, train_lr, ["I1"], ["C1"], key=F.col("id").cast("string")
    )
    assert scored.columns == [*df.columns, "fold", "score"]
    found = {r["id"]: r for r in scored.collect()}
    assert len(found) == df.count() == scored.count()
    areas = crossval.fold_areas(scored, FOLDS).collect()
    assert sum(r["rows"] for r in areas) == len(found)
    fold = 2
    fitted = encode.fit_features(folded.where(F.col("fold") != fold), ["I1"], ["C1"])
    model = train_lr(encode.to_features(fitted, folded.where(F.col("fold") != fold)))
    from clickmill.operators.model import score

    own = score(model, fitted.transform(folded.where(F.col("fold") == fold)))
    for row in own.select("id", "score").collect():
        assert found[row["id"]]["fold"] == fold
        assert found[row["id"]]["score"] == pytest.approx(row["score"], abs=1e-6)


def test_equal_rows_share_a_fold(spark):
    df = spark.range(50).select((F.col("id") % 7).alias("id")).withColumn("x", F.lit(None))
    folds = crossval.with_folds(df, 3).groupBy("id").agg(F.countDistinct("fold").alias("n"))
    assert {r["n"] for r in folds.collect()} == {1}


def test_folds_without_rows_or_values(spark):
    df = spark.createDataFrame([(1, None, "a", 0), (2, 3, None, 0)], "id int, I1 int, C1 string, fold int")
    encoding = crossval.fit_folds(df, 2, ["I1"], ["C1"])
    assert encoding.sizes == [2, 0]
    # Without fold 0 nothing is left: no means, rates 0, features constant.
    assert encoding.numbers["I1"].means == [None, 3.0]
    assert encoding.rate_bounds["C1"][0] == (0.0, 0.0)
    got = encoding.encode(df).select(vector_to_array(encoding.features(1)).alias("f")).collect()
    assert len(got) == 2


def test_training_rows_come_in_bounded_tasks_and_only_scores_are_written_again(spark, monkeypatch):
    monkeypatch.setattr(model, "TRAINING_ROWS_PER_TASK", 50)
    monkeypatch.setattr(crossval, "ROWS_PER_FILE", 10, raising=False)
    monkeypatch.setattr(crossval, "FILES_PER_TASK", 5, raising=False)
    df = spark.createDataFrame(rows(random.Random(2), 1000), "id int, label int, I1 int, C1 string, C2 string")
    largest, shuffled = [], []

    def train(features):
        sizes = features.groupBy(F.spark_partition_id()).count().collect()
        largest.append(max(r["count"] for r in sizes))
        shuffled.append(model._dealt(features) is not features)
        return train_lr(features)

    scored = crossval.cross_validate(
        df, FOLDS, train, ["I1"], ["C1", "C2"], key=F.col("id").cast("string")
    )
    assert scored.count() == 1000
    assert max(largest) <= 50 and not any(shuffled)


def test_rows_without_a_key_are_in_no_fold(spark):
    df = spark.createDataFrame(rows(random.Random(3)), "id int, label int, I1 int, C1 string, C2 string")
    key = F.when(F.col("id") % 10 != 0, F.col("id").cast("string"))
    scored = crossval.cross_validate(df, FOLDS, train_lr, ["I1"], ["C1"], key=key)
    assert sorted(r["id"] for r in scored.collect()) == [i for i in range(400) if i % 10]

"""Feature encoding: frequency rates of categories, mean imputation, min-max scaling."""

from __future__ import annotations

import decimal
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.functions import rate_column, value_rate
from clickmill.operators import lookup
from clickmill.operators.profile import _groups, category_counts
from clickmill.schema import ENCODED_CAT_COLS, INT_COLS, LABEL
from clickmill.session import materialize

RAW_FEATURES = "raw_features"
FEATURES = "features"


def feature_columns(
    int_columns: Sequence[str] = INT_COLS, cat_columns: Sequence[str] = ENCODED_CAT_COLS
) -> list[str]:
    """Feature order: integers, then category rates in the caller's order."""
    return [*int_columns, *[rate_column(name) for name in cat_columns]]


# --- frequency encoding ---------------------------------------------------------------


class _EncoderParams(HasInputCols):
    broadcastBytes = Param(
        Params._dummy(),
        "broadcastBytes",
        "largest estimated size of all rates together that are sent to every executor",
        typeConverter=TypeConverters.toInt,
    )
    hotShare = Param(
        Params._dummy(),
        "hotShare",
        "values with at least this share of the rows are looked up without a shuffle",
        typeConverter=TypeConverters.toFloat,
    )

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(broadcastBytes=64 * 1024 * 1024, hotShare=0.001)


class FrequencyEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns how often every value of the input columns occurs, null included."""

    @keyword_only
    def __init__(self, *, inputCols=None, broadcastBytes=None, hotShare=None):
        super().__init__()
        given = {key: value for key, value in self._input_kwargs.items() if value is not None}
        self._set(**given)

    def _fit(self, dataset: DataFrame) -> FrequencyEncoderModel:
        columns = self.getInputCols()
        counts = materialize(category_counts(dataset, columns), "category-counts", "column")
        sizes = _sizes(counts)
        model = FrequencyEncoderModel(counts, sizes)
        return self._copyValues(model)


def _sizes(counts: DataFrame) -> dict[str, dict[str, int]]:
    """Per column: rows seen, distinct values, text bytes of all and of the longest, and the
    smallest and largest count. One row per column reaches the driver.
    """
    rows = counts.groupBy("column").agg(
        F.sum("count").alias("rows"),
        F.count(F.lit(1)).alias("values"),
        F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.octet_length("value")), F.lit(0)).alias("longest"),
        F.min("count").alias("rarest"),
        F.max("count").alias("commonest"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0)).alias("nulls"),
    )
    return {row["column"]: row.asDict() for row in rows.collect()}


class FrequencyEncoderModel(Model, _EncoderParams, MLReadable, MLWritable):
    """Adds ``<column>_rate`` for every input column; a value not seen in fit gets 0.0."""

    ENTRY_BYTES = lookup.ENTRY_BYTES
    # Most that the hot values of all columns may take on an executor.
    HOT_BYTES = lookup.HOT_BYTES

    def __init__(self, counts: DataFrame | None = None, sizes: dict | None = None):
        super().__init__()
        self.counts = counts
        self.sizes = sizes or {}

    @property
    def rates(self) -> DataFrame:
        """``(column, value, count, rate)``."""
        rows = max((size["rows"] for size in self.sizes.values()), default=0)
        return self.counts.withColumn("rate", value_rate(F.col("count"), rows))

    def rate_bounds(self) -> dict[str, tuple[float, float]]:
        """Smallest and largest rate that a row seen in fit can get, per column."""
        return {
            name: (size["rarest"] / size["rows"], size["commonest"] / size["rows"])
            for name, size in self.sizes.items()
        }

    def broadcast_columns(self) -> list[str]:
        """Columns whose whole rate tables are sent to every executor.

        The smallest first, as long as all of them together stay below the limit.
        """
        sizes = {name: self._table_bytes(name) for name in self.getInputCols()}
        return lookup.fitting(sizes, self.getOrDefault(self.broadcastBytes))

    def _table_bytes(self, column: str) -> int:
        size = self.sizes.get(column, {"values": 0, "bytes": 0})
        return size["bytes"] + self.ENTRY_BYTES * size["values"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        whole = self.broadcast_columns()
        split = [name for name in self.getInputCols() if name not in whole]
        targets = [rate_column(name) for name in self.getInputCols()]
        columns = [name for name in dataset.columns if name not in targets]
        unseen = F.lit(0.0)
        for name in whole:
            rates = self.rates.where(F.col("column") == name)
            dataset = lookup.broadcast_lookup(
                dataset, name, rates, "rate", rate_column(name), unseen
            )
        if split:
            dataset = lookup.split_lookup(
                dataset,
                split,
                self.rates,
                "rate",
                rate_column,
                unseen,
                {name: F.lit(self._of_null(name)) for name in split},
                self._hot_values(dataset, split),
            )
        return dataset.select(*[dataset[name] for name in columns], *targets)

    def _of_null(self, name: str) -> float:
        size = self.sizes.get(name, {"rows": 0})
        return size.get("nulls", 0) / size["rows"] if size["rows"] else 0.0

    def _hot_values(self, dataset: DataFrame, names: Sequence[str]) -> DataFrame:
        share = self.getOrDefault(self.hotShare)
        return lookup.hot_values(dataset, names, share, self.HOT_BYTES, self.ENTRY_BYTES)

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader(cls)


class _EncoderWriter(MLWriter):
    def __init__(self, model: FrequencyEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(
            self.model, path, self.sparkSession, extraMetadata={"sizes": self.model.sizes}
        )
        counts = self.model.counts.hint("rebalance", "column")
        counts.write.partitionBy("column").parquet(f"{path}/counts")


class _EncoderReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> FrequencyEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        schema = "value string, count bigint, column string"
        counts = self.sparkSession.read.schema(schema).parquet(f"{path}/counts")
        model = self.cls(counts.select("column", "value", "count"), metadata["sizes"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


# --- mean imputation ------------------------------------------------------------------


class _ImputerParams(HasInputCols):
    strategy = Param(
        Params._dummy(),
        "strategy",
        "truncate: integer columns get the mean cut to an integer; round: the mean rounded "
        "half away from zero; exact: columns become double and get the mean itself",
        typeConverter=TypeConverters.toString,
    )

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(strategy="truncate")

    def _check_strategy(self) -> str:
        strategy = self.getOrDefault(self.strategy)
        if strategy not in ("truncate", "round", "exact"):
            raise ValueError(f"unknown imputation strategy {strategy!r}")
        return strategy


class MeanImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the means that replace nulls."""

    @keyword_only
    def __init__(self, *, inputCols=None, strategy=None):
        super().__init__()
        given = {key: value for key, value in self._input_kwargs.items() if value is not None}
        self._set(**given)

    def _fit(self, dataset: DataFrame) -> MeanImputerModel:
        self._check_strategy()
        means = {}
        for group in _groups(self.getInputCols(), 45):
            means.update(dataset.agg(*[F.avg(name).alias(name) for name in group]).first().asDict())
        return self._copyValues(_imputer_model(means))


def _imputer_model(means: dict[str, float | None]) -> MeanImputerModel:
    empty = [name for name, mean in means.items() if mean is None]
    if empty:
        raise ValueError(f"no mean for columns without values: {', '.join(empty)}")
    return MeanImputerModel(means)


class MeanImputerModel(Model, _ImputerParams, MLReadable, MLWritable):
    """Replaces nulls of the input columns."""

    def __init__(self, means: dict[str, float] | None = None):
        super().__init__()
        self.means = means or {}

    def fill_value(self, name: str, kind: T.DataType) -> int | float:
        """What a null of column ``name`` with type ``kind`` becomes."""
        strategy = self._check_strategy()
        mean = self.means[name]
        if strategy == "exact":
            return mean
        if strategy == "round":
            mean = float(decimal.Decimal(repr(mean)).quantize(decimal.Decimal(1), "ROUND_HALF_UP"))
        return int(mean) if isinstance(kind, T.IntegralType) else mean

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getInputCols()
        if self._check_strategy() == "exact":
            dataset = dataset.withColumns({name: F.col(name).cast("double") for name in names})
        return dataset.fillna(
            {name: self.fill_value(name, dataset.schema[name].dataType) for name in names}
        )

    def write(self) -> MLWriter:
        return _ImputerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ImputerReader(cls)


class _ImputerWriter(MLWriter):
    def __init__(self, model: MeanImputerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(
            self.model, path, self.sparkSession, extraMetadata={"means": self.model.means}
        )


class _ImputerReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> MeanImputerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(metadata["means"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


# --- the whole encoding ---------------------------------------------------------------


def _assembler(int_columns: Sequence[str], cat_columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(
        inputCols=feature_columns(int_columns, cat_columns), outputCol=RAW_FEATURES
    )


def _scaler() -> MinMaxScaler:
    return MinMaxScaler(inputCol=RAW_FEATURES, outputCol=FEATURES)


def feature_pipeline(
    int_columns: Sequence[str] = INT_COLS,
    cat_columns: Sequence[str] = ENCODED_CAT_COLS,
    impute: str = "truncate",
) -> Pipeline:
    """The encoding as an unfitted pipeline, for use inside other pipelines."""
    stages = []
    if int_columns:
        stages.append(MeanImputer(inputCols=list(int_columns), strategy=impute))
    if cat_columns:
        stages.append(FrequencyEncoder(inputCols=list(cat_columns)))
    return Pipeline(stages=[*stages, _assembler(int_columns, cat_columns), _scaler()])


def fit_features(
    train: DataFrame,
    int_columns: Sequence[str] = INT_COLS,
    cat_columns: Sequence[str] = ENCODED_CAT_COLS,
    impute: str = "truncate",
) -> PipelineModel:
    """Fit the encoding in two passes: one over the integers, one over the categories.

    The same model as ``feature_pipeline(...).fit(train)``, which also encodes all rows to
    find the bounds of the scaler. They follow from the two passes: an integer feature
    ranges over its values and its imputed mean, a rate feature over the learned rates.
    """
    stats = {}
    for group in _groups(int_columns, 19):
        row = train.agg(
            F.count(F.lit(1)).alias("rows"),
            *[
                F.struct(
                    F.avg(name).alias("mean"),
                    F.min(name).alias("lo"),
                    F.max(name).alias("hi"),
                    F.count(name).alias("values"),
                ).alias(name)
                for name in group
            ],
        ).first()
        for name in group:
            stats[name] = {**row[name].asDict(), "has_null": row[name]["values"] < row["rows"]}

    stages, low, high = [], [], []
    if int_columns:
        imputer = _imputer_model({name: stat["mean"] for name, stat in stats.items()})
        imputer._set(inputCols=list(int_columns), strategy=impute)
        stages.append(imputer)
        for name in int_columns:
            reached = [stats[name]["lo"], stats[name]["hi"]]
            if stats[name]["has_null"]:
                reached.append(imputer.fill_value(name, train.schema[name].dataType))
            low.append(float(min(reached)))
            high.append(float(max(reached)))
    if cat_columns:
        encoder = FrequencyEncoder(inputCols=list(cat_columns)).fit(train)
        stages.append(encoder)
        rate_bounds = encoder.rate_bounds()
        low += [rate_bounds[name][0] for name in cat_columns]
        high += [rate_bounds[name][1] for name in cat_columns]
    corners = train.sparkSession.createDataFrame(
        [(Vectors.dense(low),), (Vectors.dense(high),)], [RAW_FEATURES]
    )
    scaler = _scaler().fit(corners)
    return PipelineModel([*stages, _assembler(int_columns, cat_columns), scaler])


def to_features(model: PipelineModel, df: DataFrame, label: str = LABEL) -> DataFrame:
    """``(label DOUBLE, features)`` of any dataset under a fitted encoding."""
    encoded = model.transform(df)
    return encoded.select(F.col(label).cast("double").alias(LABEL), FEATURES)

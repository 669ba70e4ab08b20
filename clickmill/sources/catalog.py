"""Named click-log datasets below one root folder."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from clickmill.sources.clicks import read_clicks

SPLIT_FOLDER = "split"
SPLIT_COLUMN = "part"


def split_path(root: str, name: str) -> str:
    """Folder that a split written by ``operators.split.write_splits`` lies in."""
    return f"{root}/{SPLIT_FOLDER}/{SPLIT_COLUMN}={name}"


# File names of splits that were written as one text dataset each.
TEXT_SPLITS = {
    "train_5m": "split/train_5m.txt",
    "validation_2m": "split/validation_2m.txt",
    "test_3m": "split/test_3m.txt",
    "test": "split/test.txt",
}


def dataset_paths(root: str, files: Mapping[str, str] | None = None) -> dict[str, str]:
    """Paths of the source log, its four splits and the small debug log.

    ``files`` names datasets that lie elsewhere below the root, as ``TEXT_SPLITS`` does.
    """
    # Names of the datasets and of the two files.
    paths = {"train": f"{root}/train.txt", "debug": f"{root}/small-train.txt"}
    for name in ("train_5m", "validation_2m", "test_3m", "test"):
        paths[name] = split_path(root, name)
    return paths | {name: f"{root}/{file}" for name, file in (files or {}).items()}


def read_dataset(
    spark: SparkSession,
    root: str,
    name: str,
    files: Mapping[str, str] | None = None,
    validate: bool = False,
) -> DataFrame:
    paths = dataset_paths(root, files)
    if name not in paths:
        raise ValueError(f"unknown dataset {name!r}; known: {', '.join(sorted(paths))}")
    return read_clicks(spark, paths[name], validate=validate)

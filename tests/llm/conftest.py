import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from llm_helpers import AWKWARD  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture
def awkward(spark):
    """Nulls, empty, short, odd, very long and repeated texts, with an extra column."""
    rows = [(i, t, "x", i % 3 or None) for i, t in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, "doc_id long, text string, probability string, label int")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


@pytest.fixture
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def sample_labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")

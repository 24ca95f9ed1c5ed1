"""The awkward documents, labels and the given tables."""

from __future__ import annotations

import os
import sys

import pytest
from awkward import COLUMNS, EDGES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.01"
@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (6, 1, 0), (None, 0, 1), (8, 0, None)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def given(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")

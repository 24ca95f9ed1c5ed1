"""One local session for all tests."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerweave.session import tune  # noqa: E402
from ledgerweave.sources.spec import Spec  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def salted():
    return Spec(dt.date(2025, 1, 1))


@pytest.fixture(scope="session")
def cyclic():
    return Spec(dt.date(2025, 1, 1), style="cyclic")


@pytest.fixture(scope="session")
def physical_plan():
    def plan(df) -> str:
        printed = io.StringIO()
        with contextlib.redirect_stdout(printed):
            df.explain()
        return printed.getvalue()

    return plan

"""Session settings the jobs are written for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # HotSpot leaves methods above 8000 bytes interpreted.  A 36-column projection fused
    # into one method is far above it; past this limit Spark emits many small methods
    # instead, and the ledger is generated about eight times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    # Chains end by themselves; by default a recursive query fails beyond 100 steps or a
    # million rows.
    "spark.sql.cteRecursionLevelLimit": "-1",
    "spark.sql.cteRecursionRowLimit": "-1",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def tuned_for(spark: SparkSession) -> Iterator[SparkSession]:
    """The session with the settings for as long as a job runs, then as it was."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    try:
        yield tune(spark)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)

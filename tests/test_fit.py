"""Goodness of fit: right declarations pass, wrong ones don't, statistics equal plain ones."""

from __future__ import annotations

import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from ledgerweave.operators import fit


def test_chi_square_equals_a_plain_sum(spark):
    values = ["a"] * 50 + ["b"] * 31 + ["c"] * 19
    df = spark.createDataFrame([(v,) for v in values], "v string")
    row = fit.weight_fit(df, F.col("v"), {"a": 5, "b": 3, "c": 2, "never": 0}).first()
    plain = sum((values.count(v) - 10 * w) ** 2 / (10 * w) for v, w in zip("abc", (5, 3, 2)))
    assert math.isclose(row["chi_square"], plain, rel_tol=1e-12)
    assert (row["row_cnt"], row["undeclared_cnt"], row["degrees"], row["fits"]) == (100, 0, 2, True)
    assert not fit.weight_fit(df, F.col("v"), {"a": 1, "b": 1, "c": 10}).first()["fits"]


def test_undeclared_and_null_values_reject(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    row = fit.weight_fit(df, F.col("v"), {"a": 1}).first()
    assert (row["undeclared_cnt"], row["chi_square"], row["fits"]) == (2, 0.0, False)
    none = fit.weight_fit(df.limit(0), F.col("v"), {"a": 1, "b": 1}).first()
    assert (none["row_cnt"], none["chi_square"], none["fits"]) == (0, 0.0, True)
    with pytest.raises(ValueError):
        fit.weight_fit(df, F.col("v"), {"a": 0})


@pytest.mark.parametrize(("degrees", "quantile"), [(1, 10.828), (2, 13.816), (12, 32.909), (13, 34.528), (14, 36.123)])
def test_critical_values_equal_the_tabled_ones(degrees, quantile):
    assert math.isclose(fit.chi_square_critical(degrees), quantile, abs_tol=5e-4)


def amounts(spark, n, mu, sigma, low, high, seed=1):
    rng = random.Random(seed)
    rows = [(min(max(math.exp(rng.gauss(mu, sigma)), low), high),) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "x double")


def distance(df, mu, sigma, low, high):
    return fit.log_normal_fit(df, F.col("x"), F.lit("all"), {"all": (mu, sigma, low, high)}).first()


def test_distance_equals_one_from_sorted_values(spark):
    mu, sigma, low, high = 3.0, 0.8, 5.0, 60.0
    rows, df = amounts(spark, 4000, mu, sigma, low, high)
    row = distance(df, mu, sigma, low, high)
    gaps = []
    for k in range(-fit.LIMIT * fit.CELLS, fit.LIMIT * fit.CELLS + 1):
        edge = math.exp(mu + sigma * k / fit.CELLS)
        if low < edge < high:
            below = sum(x < edge for (x,) in rows) / len(rows)
            gaps.append(abs(below - NormalDist().cdf(k / fit.CELLS)))
    assert math.isclose(row["distance"], max(gaps), abs_tol=1e-12)
    assert (row["row_cnt"], row["outside_cnt"], row["fits"]) == (4000, 0, True)


@pytest.mark.parametrize("wrong", [(3.3, 0.8, 5.0, 60.0), (3.0, 1.1, 5.0, 60.0), (3.0, 0.8, 6.0, 60.0)])
def test_wrong_parameters_and_bounds_reject(spark, wrong):
    _, df = amounts(spark, 4000, 3.0, 0.8, 5.0, 60.0)
    assert not distance(df, *wrong)["fits"]


def test_awkward_amounts_count_as_outside(spark):
    df = spark.createDataFrame([(None,), (0.0,), (-20.0,), (1e300,), (float("nan"),)], "x double")
    row = distance(df, 3.0, 0.8, 5.0, 60.0)
    assert (row["row_cnt"], row["outside_cnt"], row["fits"]) == (5, 4, False)
    declared = {"a": (3.0, 0.8, 5.0, 60.0)}
    assert fit.log_normal_fit(df.limit(0), F.col("x"), F.lit("a"), declared).count() == 0
    other = fit.log_normal_fit(df, F.col("x"), F.lit("b"), declared).first()
    assert (other["grp"], other["outside_cnt"], other["fits"]) == ("b", 5, False)
    assert fit.log_normal_fit(df, F.col("x"), F.lit(None).cast("string"), declared).count() == 0

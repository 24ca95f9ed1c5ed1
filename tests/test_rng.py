"""Seeded draws: replayable, independent of partitioning, with the stated distributions."""

from __future__ import annotations

import datetime as dt
import math
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerweave.functions.rng import RowRandom, from_units, log_normal_params, salt_key, to_units

N = 20_000


def replay(id: int, salt: str, seed: int) -> float:
    start = xxhash.xxh64_intdigest(struct.pack("<q", salt_key(salt, seed)), seed=42)
    return (xxhash.xxh64_intdigest(struct.pack("<q", id), seed=start) >> 12) / 2**52


@pytest.mark.parametrize("salt,seed", [("a", 42), ("company_id", 42), ("a", 7)])
def test_uniform_is_the_public_hash(spark, salt, seed):
    ids = [0, 1, 2, 41, 10**6, 25 * 10**9, -3]
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint")
    drawn = rows.select("id", RowRandom("id", seed).uniform(salt).alias("u")).collect()
    assert {r.id: r.u for r in drawn} == {i: replay(i, salt, seed) for i in ids}


def test_same_rows_from_any_partitioning(spark):
    random = RowRandom("id")
    expected = None
    for partitions in (1, 4, 16):
        rows = spark.range(0, 1_000, 1, partitions).select(
            "id", random.uniform("x").alias("u"), random.date("d", "2020-01-01", "2021-01-01")
        )
        found = sorted(rows.collect())
        expected = expected or found
        assert found == expected


def test_salts_and_seeds_give_independent_streams(spark):
    rows = spark.range(N).select(
        RowRandom("id").uniform("a").alias("a"),
        RowRandom("id").uniform("b").alias("b"),
        RowRandom("id", 1).uniform("a").alias("c"),
    )
    pairs = rows.agg(F.corr("a", "b"), F.corr("a", "c"), F.avg("a"), F.min("a"), F.max("a")).first()
    assert abs(pairs[0]) < 0.03 and abs(pairs[1]) < 0.03
    assert abs(pairs[2] - 0.5) < 0.01 and 0 <= pairs[3] and pairs[4] < 1


def test_log_normal_has_the_arithmetic_moments(spark):
    amount = RowRandom("id").log_normal("amount", 500_000, 1_000_000)
    units = from_units(to_units(amount))
    got = spark.range(200_000).agg(
        F.avg(amount), F.median(amount), F.count_if(units.isNull()), F.min(units)
    )
    mean, median, nulls, low = got.first()
    mu, _ = log_normal_params(500_000, 1_000_000)
    assert abs(mean / 500_000 - 1) < 0.03
    assert abs(median / math.exp(mu) - 1) < 0.03
    assert nulls == 0 and low > 0


def test_weighted_pick_follows_weights(spark):
    picked = RowRandom("id").weighted("w", ["a", "b", "c"], [70, 20, 10])
    shares = {
        r[0]: r[1] / N for r in spark.range(N).groupBy(picked.alias("v")).count().collect()
    }
    assert shares["a"] == pytest.approx(0.7, abs=0.02)
    assert shares["c"] == pytest.approx(0.1, abs=0.02)


def test_weights_must_match_values():
    with pytest.raises(ValueError):
        RowRandom("id").weighted("w", ["a", "b"], [1])


def test_units_round_half_up_and_stay_exact(spark):
    rows = spark.createDataFrame([(0.000005,), (1.000004,), (57_500_000.0,), (0.0,)], "x double")
    got = [str(r[0]) for r in rows.select(from_units(to_units(F.col("x")))).collect()]
    assert got == ["0.00001", "1.00000", "57500000.00000", "0.00000"]


def test_audit_dates(spark):
    random = RowRandom("id")
    created, updated = random.audit_dates("t", "2018-01-01", "2024-12-31", 0.3)
    rows = spark.range(N).select(created.alias("c"), updated.alias("u"))
    same, low, high = rows.agg(
        F.avg((F.col("c") == F.col("u")).cast("int")), F.min("c"), F.max("u")
    ).first()
    assert same == pytest.approx(0.7, abs=0.02)
    assert low >= dt.date(2018, 1, 1) and high < dt.date(2024, 12, 31)


def test_sign_share(spark):
    share = spark.range(N).agg(
        F.avg((RowRandom("id").sign("s", 0.12) < 0).cast("int"))
    ).first()[0]
    assert share == pytest.approx(0.12, abs=0.01)


def test_weights_may_have_any_total(spark):
    random = RowRandom("id")
    rows = spark.range(N).select(
        random.weighted("w", ["a", "b"], [700, 300]).alias("big"),
        random.weighted("w", ["a", "b"], [70, 30]).alias("small"),
    )
    share, same = rows.agg(
        F.avg((F.col("big") == "a").cast("int")), F.avg((F.col("big") == F.col("small")).cast("int"))
    ).first()
    assert share == pytest.approx(0.7, abs=0.02) and same > 0.99
    with pytest.raises(ValueError):
        random.weighted("w", ["a"], [700, 300])


def test_updates_never_precede_their_creation(spark):
    created, updated = RowRandom("id").audit_dates("t", "2018-01-01", "2024-12-31", 0.3)
    rows = spark.range(N).select(created.alias("c"), updated.alias("u"))
    assert rows.where("u < c").count() == 0

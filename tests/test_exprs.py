"""Picks, codes, levels and account numbers against plain Python."""

from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerweave.functions import keys, pools
from ledgerweave.functions.exprs import (
    MAX_LITERAL_POOL,
    case,
    cyclic_pick,
    literal_array,
    nested_level_sizes,
    shrinking_level_sizes,
    zero_pad,
)
from ledgerweave.sources.generate import Volumes, generate


@given(st.integers(1, 10**9), st.integers(1, 40), st.integers(1, 12))
def test_nested_sizes_divide_and_grow(n, levels, step):
    sizes = nested_level_sizes(n, levels, step)
    assert len(sizes) == levels
    for coarse, fine in zip(sizes, sizes[1:]):
        assert fine % coarse == 0
    assert sizes[-1] <= max(1, n // step)


def test_shrinking_sizes_follow_the_template():
    sizes = shrinking_level_sizes(1_500, 30, 10)
    assert (sizes[0], sizes[-1]) == (150, 5)
    assert shrinking_level_sizes(600, 7, 5, plus=1) == [600 // (5 * k) + 1 for k in range(1, 8)]


def test_zero_pad_never_shortens(spark):
    rows = spark.createDataFrame([(7,), (1234567,), (123456789,)], "n bigint")
    got = [r[0] for r in rows.select(zero_pad(F.col("n"), 7)).collect()]
    assert got == ["0000007", "1234567", "123456789"]


def test_cyclic_pick_wraps_and_takes_negatives(spark):
    rows = spark.createDataFrame([(i,) for i in (-1, 0, 1, 4, 5)], "n bigint")
    got = [r[0] for r in rows.select(cyclic_pick(["a", "b's", "c", "d"], F.col("n"))).collect()]
    assert got == ["d", "a", "b's", "a", "b's"]


def test_literal_pool_is_bounded():
    with pytest.raises(ValueError):
        literal_array(range(MAX_LITERAL_POOL + 1))
    with pytest.raises(ValueError):
        literal_array([])


def test_case_without_branches_is_the_default(spark):
    assert spark.range(1).select(case([], F.lit("x"))).first()[0] == "x"


def threshold_account(i: int) -> tuple[str, int]:
    total, seen = sum(c.weight for c in pools.ACCOUNT_CLASSES), 0
    ratio = i * 61 % total / total
    for c in pools.ACCOUNT_CLASSES:
        seen += c.weight
        if ratio < seen / total:
            return c.name, c.start + i % (c.end - c.start)
    last = pools.ACCOUNT_CLASSES[-1]
    return last.name, last.start + i % (last.end - last.start)


@pytest.mark.parametrize("n", [7, 1_000, 8_000])
def test_threshold_pick_matches_python(spark, n):
    index = keys.account_class_index(F.col("id"))
    rows = spark.range(1, n + 1).select(
        "id",
        keys.of_class(index, [c.name for c in pools.ACCOUNT_CLASSES]).alias("name"),
        keys.account_number(F.col("id"), index).alias("nbr"),
    )
    found = {r.id: (r.name, r.nbr) for r in rows.collect()}
    assert found == {i: threshold_account(i) for i in range(1, n + 1)}
    assert len({nbr for _, nbr in found.values()}) == n


@pytest.mark.parametrize("n", [90_000, 2_500_000])
def test_account_numbers_stay_distinct_and_in_their_class(spark, n):
    index = keys.account_class_index(F.col("id"))
    rows = spark.range(1, n + 1, 1, 4).select(
        keys.of_class(index, [c.start for c in pools.ACCOUNT_CLASSES]).alias("start"),
        keys.account_number(F.col("id"), index).alias("nbr"),
    )
    assert rows.select("nbr").distinct().count() == n
    leading = "substr(right(cast(nbr as string), 7), 1, 1) <> substr(cast(start as string), 1, 1)"
    assert rows.where(leading).count() == 0


def test_accounts_keep_their_numbers_whatever_their_count(spark, salted):
    def numbers(n):
        accounts = generate(spark, "gl_account_dim", Volumes(rows={"gl_account_dim": n}), salted)
        first = accounts.where("gl_accnt_id <= 8000")
        return {r[0]: r[1] for r in first.select("gl_accnt_id", "gl_account_nbr").collect()}

    first = numbers(8_000)
    assert len(first) == len(set(first.values())) == 8_000
    for n in (8_001, 16_000, 10_000_000):
        assert numbers(n) == first


def test_classes_share_the_accounts_by_weight(spark):
    index = keys.account_class_index(F.col("id"))
    counts = spark.range(1, 1_001).groupBy(index.alias("i")).count().orderBy("i").collect()
    assert [r["count"] for r in counts] == [10 * c.weight for c in pools.ACCOUNT_CLASSES]
    # Even a few accounts spread over the classes.
    assert spark.range(1, 21).select(index.alias("i")).distinct().count() >= 7


def test_listed_codes_then_synthetic_ones(spark):
    rows = spark.createDataFrame([(1,), (20,), (21,), (105,)], "id bigint")
    got = [tuple(r) for r in rows.select(
        keys.document_type_cd(F.col("id")), keys.version_nbr(F.col("id"))
    ).collect()]
    assert got == [("SA", "010"), ("IC", "V020"), ("Z21", "V021"), ("Z105", "V105")]

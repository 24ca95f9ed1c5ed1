"""The aggregate, measure views and their reconciliation."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ledgerweave.operators import agg
from ledgerweave.plans.queries import in_dollars
from ledgerweave.sources.generate import Volumes, generate
from ledgerweave.sources.tables import read_table, save_table, scratch_path

SIZES = Volumes(
    ledger_rows=20_000, rows={"profit_center": 5, "company_code": 3, "division_text": 2}
)


@pytest.fixture(scope="module")
def ledger(spark, salted):
    return generate(spark, "general_ledger_fact", SIZES, salted)


@pytest.fixture(scope="module")
def accounts(spark, salted):
    return generate(spark, "gl_account_dim", SIZES, salted)


def test_aggregate_keeps_the_totals(ledger, accounts):
    aggregate = agg.ledger_aggregate(ledger, accounts)
    totals = [F.sum(a).alias(a) for a in agg.AMOUNTS]
    assert aggregate.agg(*totals).first() == ledger.agg(*totals).first()
    assert aggregate.agg(F.sum("row_cnt")).first()[0] == SIZES.ledger_rows
    assert aggregate.select("account_class").distinct().count() == 9
    assert aggregate.groupBy(*agg.GRAIN).count().where("count > 1").count() == 0


def test_one_shuffle_and_a_broadcast_join(ledger, accounts, physical_plan):
    plan = physical_plan(agg.ledger_aggregate(ledger, accounts))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_rolling_up_equals_summing_directly(ledger, accounts):
    aggregate = agg.ledger_aggregate(ledger, accounts)
    by = ["fiscal_year_period_nbr", "account_class"]
    direct = agg.with_account_class(ledger, accounts).groupBy(*by).agg(*agg.measure_sums())
    assert tuple(agg.reconcile(agg.roll_up(aggregate, by), direct).first())[2:] == (0, 0)


def test_description_keeps_every_row(spark, salted, ledger, accounts):
    aggregate = agg.ledger_aggregate(ledger, accounts)
    described = agg.describe(
        aggregate,
        *(
            generate(spark, t, SIZES, salted)
            for t in (
                "calendar_fiscal_period_v",
                "company_code",
                "profit_center",
                "division_text",
                "version_forecast_mapping",
            )
        ),
    )
    assert described.count() == aggregate.count()
    assert described.where("geography_nm is null or version_group_nm is null").count() == 0
    assert described.where("fiscal_year_nbr <> fiscal_year_period_nbr div 100").count() == 0


def test_reconcile_counts_differences_and_repeats(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, s string")
    right = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "x int, s string")
    assert tuple(agg.reconcile(left, right).first()) == (3, 3, 1, 1)
    assert tuple(agg.reconcile(left, left).first()) == (3, 3, 0, 0)
    assert tuple(agg.reconcile(left.where("false"), right).first()) == (0, 3, 0, 3)


def test_measure_view_reads_only_what_it_names(spark, ledger, physical_plan):
    path = scratch_path(spark, "ledger")
    save_table(ledger, path)
    view = agg.MeasureView(
        read_table(spark, path),
        {"year": "fiscal_year_period_nbr div 100"},
        {"amt": "sum(company_currency_amt)", "n": "count(*)"},
    )
    query = view.query(["year"], ["amt"], where="company_id = 2")
    plan = physical_plan(query)
    schema = next(p for p in plan.split("ReadSchema: ")[1:]).splitlines()[0]
    assert "sales_qty" not in schema and "product_id" not in schema
    assert "EqualTo(company_id,2)" in plan
    expected = ledger.where("company_id = 2").agg(F.sum("company_currency_amt")).first()[0]
    assert sum(r.amt for r in query.collect()) == expected


def test_measure_view_as_sql_view(spark, ledger):
    view = agg.MeasureView(ledger, {"company": "company_cd"}, {"n": "count(*)"})
    view.create_view("by_company", ["company"], ["n"])
    assert spark.sql("select sum(n) from by_company").first()[0] == SIZES.ledger_rows


def test_unknown_measure_is_an_error(ledger):
    view = agg.MeasureView(ledger, {"company": "company_cd"}, {"n": "count(*)"})
    with pytest.raises(KeyError):
        view.query(["company"], ["nope"])


def test_conversion_holds_sums_of_any_realistic_size(spark, salted):
    rates = generate(spark, "finance_foreign_currency_exchange_rate", Volumes(), salted)
    summed = spark.createDataFrame(
        [("EUR", 2024, 1, Decimal("12345678901234567.12345")), ("JPY", 2024, 1, Decimal("-1e16"))],
        "from_currency_cd string, fiscal_year int, row_cnt bigint, amt decimal(38,5)",
    )
    got = {r.from_currency_cd: r.usd_amt for r in in_dollars(summed, rates).collect()}
    assert got["EUR"] == (Decimal("12345678901234567.12345") * Decimal("1.08695652")).quantize(
        Decimal("0.0001"), ROUND_HALF_UP
    )
    assert got["JPY"] == Decimal("-1e16") * Decimal("0.00668896")

"""Facts: plan shape, determinism and the invariants between columns."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerweave.functions import pools
from ledgerweave.operators import checks
from ledgerweave.plans.queries import LEDGER_RULES
from ledgerweave.sources.facts import Periods, general_ledger_fact, income_statement_fact
from ledgerweave.sources.generate import Volumes, generate, generate_clustered
from ledgerweave.sources.schema import DERIVATIONS, FACTS, RELATIONS

SIZES = Volumes(
    ledger_rows=20_000,
    rows={
        "finance_product_dim_v": 500,
        "finance_customer_dim_v": 400,
        "CIS_fact": 5_000,
        "consolidated_balance_sheet_fact": 5_000,
    },
)


@pytest.fixture(scope="module")
def ledger(spark, salted):
    return generate(spark, "general_ledger_fact", SIZES, salted)


@pytest.mark.parametrize("table", FACTS)
def test_facts_plan_without_a_shuffle_or_join(spark, salted, table, physical_plan):
    plan = physical_plan(generate(spark, table, SIZES, salted))
    assert "Exchange" not in plan and "Join" not in plan


def test_same_rows_from_any_partitioning(spark, salted):
    found = [
        general_ledger_fact(spark.range(0, 2_000, 1, p), salted).orderBy("general_ledger_fact_id")
        for p in (1, 4, 16)
    ]
    first, *others = [df.collect() for df in found]
    assert all(rows == first for rows in others)


def test_every_relation_resolves(spark, salted, ledger):
    relations = [*RELATIONS, *DERIVATIONS]
    names = {t for r in relations for t in (r.child, r.parent)}
    tables = {t: generate(spark, t, SIZES, salted) for t in names}
    # The statement holds the account number as a number and its parent as text.
    number = F.col("gl_account_id").cast("string")
    tables["CIS_fact"] = tables["CIS_fact"].withColumn("gl_account_id", number)
    report = checks.orphan_report(tables, relations).collect()
    assert len(report) == len(relations)
    assert all(r.orphan_keys == 0 and r.child_keys > 0 for r in report)


def test_rules_hold(ledger):
    assert [r for r in checks.rule_violations(ledger, LEDGER_RULES).collect() if r.violations] == []


def test_codes_are_the_parents(spark, salted, ledger):
    for parent, key, codes in (
        ("company_code", "company_id", {"company_cd": "company_cd", "company_currency_cd": "currency_cd"}),
        ("functional_area", "functional_area_id", {"Functional_Area_cd": "functional_area_cd"}),
        (
            "accounting_document_type",
            "accounting_document_type_id",
            {"accounting_document_type_cd": "accounting_document_type_cd"},
        ),
        ("profit_center", "profit_center_id", {"profit_center_nbr": "profit_center_nbr"}),
    ):
        parents = generate(spark, parent, SIZES, salted).select(
            key, *(F.col(theirs).alias(f"parent_{ours}") for ours, theirs in codes.items())
        )
        joined = ledger.join(parents, key)
        wrong = [F.col(c) != F.col(f"parent_{c}") for c in codes]
        assert joined.count() == SIZES.ledger_rows
        for condition in wrong:
            assert joined.where(condition).count() == 0


def test_amounts_keep_their_class_bounds_and_sign_share(ledger):
    row = checks.amount_distribution(ledger, "transaction_currency_amt").first()
    assert float(row.negative_share) == pytest.approx(0.12, abs=0.01)
    assert row.is_right_skewed
    revenue = ledger.where("gl_account_nbr between '1000000' and '1999999'")
    low, mean = revenue.agg(
        F.min(F.abs("transaction_currency_amt")), F.avg(F.abs("transaction_currency_amt"))
    ).first()
    assert low >= 10_000 and float(mean) == pytest.approx(500_000, rel=0.1)


def test_keys_are_independent(ledger):
    pairs = ledger.select("company_id", "version_forecast_mapping_id").distinct().count()
    assert pairs > 1_900  # of 2000; locked keys would give 400


def test_currencies_cover_the_pool(ledger):
    assert ledger.select("transaction_currency_cd").distinct().count() == len(pools.CURRENCIES)


def test_cyclic_keys_follow_the_row_id(spark, cyclic):
    rows = generate(spark, "general_ledger_fact", SIZES, cyclic)
    wrong = rows.where(
        "product_id <> general_ledger_fact_id % 500 + 1 or company_id <> general_ledger_fact_id % 80 + 1"
        " or fiscal_year_period_nbr <> (2019 + general_ledger_fact_id % 91 div 13) * 100"
        " + general_ledger_fact_id % 91 % 13 + 1"
    )
    assert wrong.count() == 0


def test_weighted_periods_follow_the_weights(spark, salted):
    sized = replace(SIZES, ledger_rows=50_000, periods="weighted")
    rows = generate(spark, "general_ledger_fact", sized, salted)
    share = rows.agg(F.avg((F.col("fiscal_year_period_nbr") % 100 == 13).cast("int"))).first()[0]
    assert share == pytest.approx(0.05, abs=0.005)


def test_unknown_period_deals_are_refused():
    with pytest.raises(ValueError, match="unknown way"):
        Periods("blocked")


def test_statement_year_and_version_group_agree(spark, salted):
    groups = dict(pools.VERSIONS)
    for table in ("CIS_fact", "consolidated_balance_sheet_fact"):
        df = generate(spark, table, SIZES, salted)
        assert df.where("fiscal_yr <> fiscal_year_period_nbr div 100").count() == 0
        assert df.where("sign(transaction_currency_amt) <> sign(group_currency_amt)").count() == 0
        pairs = df.select("version_nbr", "version_group_nm").distinct().collect()
        assert {r[0]: r[1] for r in pairs} == groups


def test_sign_adjustment_is_optional(spark, salted):
    copied = income_statement_fact(spark.range(1_000), salted)
    assert copied.where("sign_adjusted_qty <> qty").count() == 0
    adjusted = income_statement_fact(spark.range(1_000), salted, adjust_by_account=True)
    credit = "(gl_account_id between 1000000 and 1999999 or gl_account_id between 3000000 and 3099999"
    credit += " or gl_account_id between 6000000 and 6499999)"
    expected = f"if({credit}, 1, -1) * transaction_currency_amt"
    wrong = adjusted.where(f"sign_adjusted_transaction_currency_amt <> {expected}")
    assert wrong.count() == 0 and adjusted.where(f"not {credit}").count() > 0


def test_clustered_generation_gives_the_same_rows_and_shuffles_few_columns(
    spark, salted, ledger, physical_plan
):
    clustered = generate_clustered(spark, "general_ledger_fact", SIZES, salted, rows_per_file=2_000)
    assert clustered.exceptAll(ledger).count() == 0 and clustered.count() == ledger.count()
    exchange = next(
        line for line in physical_plan(clustered).splitlines() if "Exchange rangepartitioning" in line
    )
    assert "sales_qty" not in exchange
    assert physical_plan(clustered).count("Exchange") == 1

"""Every generated table: schema, keys, and the values the rules give."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerweave.operators import checks
from ledgerweave.sources.generate import Volumes, generate
from ledgerweave.sources.schema import DIMENSIONS, FACTS, TABLES, project, row_key, schema

SMALL = Volumes(
    ledger_rows=3_000,
    rows={
        "finance_product_dim_v": 2_000,
        "finance_customer_dim_v": 1_000,
        "cost_center_dim_v": 500,
        "CIS_fact": 600,
        "consolidated_balance_sheet_fact": 300,
    },
)


def rows_of(spark, spec, table, **sizes):
    df = generate(spark, table, Volumes(rows=sizes), spec)
    return df.orderBy(df.columns[0]).collect()


def test_there_are_31_tables_and_1011_columns():
    assert len(TABLES) == 31 and len(DIMENSIONS) == 28 and len(FACTS) == 3
    assert sum(len(schema(t)) for t in TABLES) == 1011


@pytest.mark.parametrize("table", TABLES)
@pytest.mark.parametrize("style", ["salted", "cyclic"])
def test_schema_and_key(spark, request, table, style):
    df = generate(spark, table, SMALL, request.getfixturevalue(style))
    declared = [(f.name, f.dataType) for f in schema(table)]
    assert [(f.name, f.dataType) for f in df.schema] == declared
    key = row_key(table)
    summary = checks.key_uniqueness({table: (df, [key])}).first()
    expected = 15 if table == "atscale_geo_security" else SMALL.of(table)
    assert (summary.row_cnt, summary.duplicate_keys) == (expected, 0)
    assert checks.null_counts(df, table, [key]).first().null_cnt == 0


def test_project_rejects_missing_and_unknown_columns(spark):
    with pytest.raises(ValueError, match="role"):
        project(spark.range(1), "atscale_geo_security", {"region": "x"})
    with pytest.raises(ValueError, match="nope"):
        project(spark.range(1), "atscale_geo_security", {"region": 1, "role": 2, "nope": 3})


def test_lookup_tables(spark, salted):
    types = rows_of(spark, salted, "accounting_document_type")
    assert tuple(types[8]) == (9, "RE", "Invoice – Gross", "Y", "EN", "RE - Invoice Gross")
    assert types[20][1:3] == ("Z21", "Custom Document Type 21")
    versions = rows_of(spark, salted, "version_forecast_mapping")
    assert [(v[1], v[2]) for v in versions[:8]] == [
        ("010", "Actual"), ("100", "Budget"), ("110", "Budget"), ("120", "Forecast"),
        ("130", "Forecast"), ("200", "Plan"), ("300", "Plan"), ("V008", "Other"),
    ]
    areas = rows_of(spark, salted, "functional_area")
    assert [areas[i][3] for i in (0, 14, 15, 149)] == [
        "Demand Creation", "Digital", "Demand Creation 2", "Digital 10",
    ]
    roles = {r[0]: r[1] for r in rows_of(spark, salted, "atscale_geo_security")}
    assert roles["Middle East Africa"] == "ROLE_MIDDLE_EAST_AFRICA"


def test_companies_cycle_through_names_and_currencies(spark, salted):
    companies = rows_of(spark, salted, "company_code")
    assert companies[2][1:4] == ("1003", "Nike Japan KK", "JPY")
    assert companies[17][1:4] == ("1018", "Nike Japan KK 18", "JPY")


def test_exchange_rates(spark, salted):
    rates = rows_of(spark, salted, "finance_foreign_currency_exchange_rate")
    assert len(rates) == 90
    by = {(r[1], r[2], r[6]): r[4] for r in rates}
    assert by["USD", "M", "USD"] == by["EUR", "B", "EUR"] == 1
    assert by["JPY", "P", "EUR"] == Decimal("0.00615385")
    assert by["USD", "M", "EUR"] == Decimal("0.92")
    assert by["KRW", "M", "USD"] == Decimal("0.00074627")
    assert [r[0] for r in rates] == list(range(1, 91))
    assert rates[7][1:4] == ("EUR", "M", "Average Rate") and rates[7][6] == "EUR"


def test_dimension_rules(spark, salted):
    center = rows_of(spark, salted, "profit_center")[19]
    assert center.profit_center_nbr == "0000020"
    assert center.profit_center_nm == "Greater China Wholesale PC-20"
    assert (center.segment_id, center.geography_nm) == ("SEG021", "North America")
    assert center.active_ind == "N" and center.geography_sort == 21
    cost = rows_of(spark, salted, "cost_center_dim_v", cost_center_dim_v=15)[14]
    assert cost.cost_center_nbr == "CC000015" and cost.company_cd == "1016"
    assert cost.profit_center_nbr == "0000016" and cost.functional_area_cd == "FA0016"
    assert cost.revenue_posting_allowed_ind == cost.quantity_required_ind == "X"
    assert cost.street_address_txt == "100 Commerce Way, Shanghai"
    store = rows_of(spark, salted, "retail_global_store_profile_v")
    by_id = {r.pos_id: r for r in store}
    assert [by_id[i].store_status_cd for i in (15, 20, 60, 7)] == [
        "CLOSED", "TEMP_CLOSED", "CLOSED", "OPEN",
    ]
    assert all(500 <= r.nike_selling_space_size_quantity < 10_500 for r in store)
    assert all(
        r.store_total_space_size == pytest.approx(1.3 * r.nike_selling_space_size_quantity, 1e-6)
        for r in store
    )


def test_cyclic_style_takes_weighted_picks_by_position(spark, cyclic):
    products = {
        r.product_id: r
        for r in rows_of(spark, cyclic, "finance_product_dim_v", finance_product_dim_v=100)
    }
    assert [products[i].brand_nm for i in (69, 70, 89, 90, 100)] == [
        "Nike", "Jordan", "Jordan", "Converse", "Nike",
    ]
    assert products[70].product_cd == "Jo-00000070"
    accounts = {r.gl_accnt_id: r.gl_account_nbr for r in rows_of(spark, cyclic, "gl_account_dim")}
    assert [accounts[i] for i in (9, 1, 4, 5, 8)] == [
        "7000009", "1000001", "4400004", "4500005", "8000008",
    ]
    hierarchy = rows_of(spark, cyclic, "segment_cost_center_hierarchy_dim_v")[149]
    assert hierarchy.cost_center_level_1_cd == "L01_1"
    assert hierarchy.cost_center_level_30_nm == "Level 30 Node 1"


def test_salted_brand_and_gender_are_not_locked(spark, salted):
    df = generate(spark, "finance_product_dim_v", SMALL, salted)
    assert df.select("brand_nm", "gender_desc").distinct().count() == 12


@pytest.mark.parametrize(
    "table,stem,levels",
    [
        ("segment_cost_center_hierarchy_dim_v", "cost_center_level_", 30),
        ("DisChannel_profit_center_hierarchy", "profit_center_level_", 9),
        ("consolidation_functional_area_hierarchy", "consolidation_functional_area_", 7),
        ("consolidation_segment_hierarchy_dim", "consolidation_segment_", 10),
        ("gl_account_hierarchy", "gl_account_level_", 30),
    ],
)
def test_each_node_has_one_parent(spark, salted, cyclic, table, stem, levels):
    nested = checks.node_parents(generate(spark, table, SMALL, salted), stem, levels).collect()
    assert len(nested) == levels - 1 and all(r.split_nodes == 0 for r in nested)
    shrunk = checks.node_parents(generate(spark, table, SMALL, cyclic), stem, levels).collect()
    assert any(r.split_nodes > 0 for r in shrunk)


def test_account_hierarchy_numbers_exist_in_the_dimension(spark, salted):
    hierarchy = generate(spark, "gl_account_hierarchy", SMALL, salted)
    accounts = generate(spark, "gl_account_dim", SMALL, salted)
    assert checks.orphan_keys(hierarchy, "gl_account_nbr", accounts, "gl_account_nbr").count() == 0


def test_account_label_fits_its_number(spark, salted):
    accounts = generate(spark, "gl_account_dim", SMALL, salted)
    wrong = accounts.where(
        "(gl_account_short_desc like 'COGS%') <> (gl_account_nbr between '2000000' and '2999999')"
    )
    assert wrong.count() == 0


def test_unknown_table_is_an_error(spark, salted):
    with pytest.raises(ValueError, match="unknown table"):
        generate(spark, "nope", SMALL, salted)


def test_division_view_is_its_parents_projection(spark, salted):
    parent = generate(spark, "division_text", SMALL, salted)
    view = generate(spark, "division_text_dim_v", SMALL, salted)
    assert view.exceptAll(parent.select(view.columns)).count() == 0
    assert view.where(F.col("division_nbr") == "07").first().division_nm == "Footwear Division 07"


def test_finite_tables_refuse_more_rows_than_they_list():
    assert Volumes().of("atscale_geo_security") == 15
    assert Volumes().of("finance_foreign_currency_exchange_rate") == 90
    with pytest.raises(ValueError, match="90 rows at most"):
        Volumes(rows={"finance_foreign_currency_exchange_rate": 300})

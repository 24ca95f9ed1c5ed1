"""DuckDB SQL for the registered queries, written apart from the Spark expressions.

Only the fixed values and row sources are shared with the queries.  The helpers below are
text macros: DuckDB has no 64-bit xxHash, so ``u`` spells it out on 128-bit integers.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Sequence

import xxhash

from ledgerweave.functions import pools
from ledgerweave.plans.queries import DIMENSION_ROWS, DRIVER_KEYS, DRIVER_RELATIONS
from ledgerweave.sources.schema import RELATIONS, TABLES, schema

# The constants of 64-bit xxHash.
_P1 = 0x9E3779B185EBCA87
_P2 = 0xC2B2AE3D27D4EB4F
_P3 = 0x165667B19E3779F9
_P4 = 0x85EBCA77C2B2AE63
_P5 = 0x27D4EB2F165667C5
_ALL = (1 << 64) - 1

LOADED = "DATE '2025-01-01'"


def _mul(a: str, b: int) -> str:
    return f"(({a} * {b}::UHUGEINT) & {_ALL}::UHUGEINT)"


def _rotl(a: str, r: int) -> str:
    return f"((({a} << {r}) & {_ALL}::UHUGEINT) | ({a} >> {64 - r}))"


def _let(value: str, body: str) -> str:
    return f"list_transform([{value}], lambda h: {body})[1]"


def u(salt: str, id: str = "id", seed: int = 42) -> str:
    """A double in [0, 1): the upper 52 bits of the row id's hash under the salt."""
    key = (seed << 32) + zlib.crc32(salt.encode())
    start = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
    h = _mul(f"({id})::UHUGEINT", _P2)
    h = _let(h, f"xor({(start + _P5 + 8) & _ALL}::UHUGEINT, {_mul(_rotl('h', 31), _P1)})")
    h = _let(h, f"({_mul(_rotl('h', 27), _P1)} + {_P4}::UHUGEINT) & {_ALL}::UHUGEINT")
    h = _let(h, _mul("xor(h, h >> 33)", _P2))
    h = _let(h, _mul("xor(h, h >> 29)", _P3))
    return f"(({_let(h, 'xor(h, h >> 32)')} >> 12)::DOUBLE / 4503599627370496e0)"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def nth(values: Sequence, position: str) -> str:
    """The value at a position from 0; null outside the list."""
    items = ", ".join(q(v) if isinstance(v, str) else f"{v!r}" for v in values)
    return f"([{items}])[({position})::INTEGER + 1]"


def cyc(values: Sequence, position: str) -> str:
    return nth(values, f"({position}) % {len(values)}")


def weighted(salt: str, values: Sequence[str], weights: Sequence[int], id: str = "id") -> str:
    total, seen, branches = sum(weights), 0, []
    for value, weight in zip(values, weights):
        seen += weight
        branches.append(f"WHEN x < {seen} THEN {q(value)}")
    picked = f"CASE {' '.join(branches)} END"
    return f"list_transform([floor({u(salt, id)} * {total})], lambda x: {picked})[1]"


def pad(number: str, width: int) -> str:
    n = f"({number})::BIGINT"
    wide = f"{n} >= {10**width}"
    return f"(CASE WHEN {wide} THEN {n}::VARCHAR ELSE lpad({n}::VARCHAR, {width}, '0') END)"


def between(salt: str, low: float, high: float, id: str = "id") -> str:
    return f"({float(low)!r}e0 + {u(salt, id)} * {float(high) - float(low)!r}e0)"


def units(amount: str) -> str:
    return f"floor(({amount}) * 100000e0 + 0.5e0)"


def dec(whole_units: str, kind: str = "DECIMAL(28,5)") -> str:
    return f"(({whole_units})::BIGINT::DECIMAL(22,0) * 0.00001::DECIMAL(6,5))::{kind}"


def normal(salt: str, id: str = "id") -> str:
    radius, angle = u(f"{salt}/radius", id), u(f"{salt}/angle", id)
    return f"(sqrt(-2e0 * ln(1e0 - {radius})) * cos(6.283185307179586e0 * {angle}))"


def sign(salt: str, id: str = "id") -> str:
    return f"(CASE WHEN {u(salt, id)} < 0.12e0 THEN -1 ELSE 1 END)"


def log_normal(mean: float, std_dev: float, z: str) -> str:
    variance = f"ln(1e0 + ({std_dev}e0 / {mean}e0) * ({std_dev}e0 / {mean}e0))"
    return f"exp(ln({mean}e0) - {variance} / 2 + sqrt({variance}) * {z})"


def key(salt: str, n: str | int, id: str = "id") -> str:
    return f"(floor({u(salt, id)} * ({n}))::BIGINT + 1)"


def every(k: int, hit: str, miss: str, id: str = "id") -> str:
    return f"(CASE WHEN {id} % {k} = 0 THEN {hit} ELSE {miss} END)"


# -- formulas of a dense id --------------------------------------------------------------

_SHARES = ("0.2e0", "0.45e0", "0.5e0", "0.65e0", "0.75e0", "0.85e0", "0.9e0", "0.95e0")
_STARTS = (1000000, 2000000, 3000000, 4000000, 4500000, 5000000, 6000000, 6500000, 7000000)
_SPANS = (999999, 999999, 99999, 499999, 499999, 499999, 499999, 499999, 499999)
_AMOUNT_KINDS = (
    "revenue", "cogs", "revenue", "opex", "opex", "opex", "revenue", "opex", "opex",
)
_LABELS = (
    "Revenue", "COGS", "Gross Profit", "Selling", "Admin", "R&D", "Other Income",
    "Other Expense", "Tax",
)


def account_class(id: str) -> str:
    """0..8 by the place in a round of 100 accounts, taken in steps of 61."""
    ratio = f"(({id}) * 61 % 100)::DOUBLE / 100e0"
    branches = " ".join(f"WHEN {ratio} < {share} THEN {i}" for i, share in enumerate(_SHARES))
    return f"(CASE {branches} ELSE 8 END)"


def account_nbr(id: str, position: str) -> str:
    span = nth(_SPANS, position)
    return f"({nth(_STARTS, position)} + ({id}) % {span} + ({id}) // {span} * 10000000)::BIGINT"


def listed(values: Sequence[str], id: str, beyond: str) -> str:
    return f"(CASE WHEN {id} <= {len(values)} THEN {nth(values, f'{id} - 1')} ELSE {beyond} END)"


def document_cd(id: str) -> str:
    return listed([c for c, _ in pools.DOCUMENT_TYPES], id, f"'Z' || {pad(id, 2)}")


def version_nbr(id: str) -> str:
    return listed([v for v, _ in pools.VERSIONS], id, f"'V' || {pad(id, 3)}")


def version_group(id: str) -> str:
    return listed([g for _, g in pools.VERSIONS], id, "'Other'")


def company_currency(id: str) -> str:
    return cyc([c for _, c in pools.COMPANIES], f"{id} - 1")


# -- dates -------------------------------------------------------------------------------


def fiscal_year(date: str) -> str:
    return f"(CASE WHEN month({date}) < 6 THEN year({date}) - 1 ELSE year({date}) END)"


def fiscal_period(date: str) -> str:
    return f"((month({date}) + 6) % 12 + 1)"


PERIOD_OF_ORDER = f"({fiscal_year('o_orderdate')} * 100 + {fiscal_period('o_orderdate')})::INTEGER"
FIRST_YEAR = f"(SELECT min({fiscal_year('o_orderdate')}) FROM orders)"
LAST_YEAR = f"(SELECT max({fiscal_year('o_orderdate')}) FROM orders)"


def table_sql(table: str, source: str, columns: dict[str, str]) -> str:
    """A select of a declared table's columns, unmentioned ones null, in declared types."""
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE"}
    names |= {"float": "FLOAT"}
    items = []
    for field in schema(table):
        kind = field.dataType.simpleString()
        kind = names.get(kind, kind)
        items.append(f"({columns.pop(field.name, 'NULL')})::{kind} AS \"{field.name}\"")
    if columns:
        raise ValueError(f"{table} has no columns {sorted(columns)}")
    return f"SELECT {', '.join(items)} FROM {source}"


CALENDAR = f"""
WITH p AS (
  SELECT y AS fy, {FIRST_YEAR} AS fy0, p,
         (make_date(y, 6, 1) + to_months((p - 1)::INTEGER))::DATE AS d,
         CASE WHEN p <= 3 THEN 1 WHEN p <= 6 THEN 2 WHEN p <= 9 THEN 3 ELSE 4 END AS qn,
         CASE WHEN p <= 6 THEN 'SS' ELSE 'FW' END AS s
  FROM (SELECT unnest(range({FIRST_YEAR}, {LAST_YEAR} + 1)) AS y), range(1, 14) t(p)
)
""" + table_sql(
    "calendar_fiscal_period_v",
    "p",
    {
        "fiscal_year_period_nbr": "fy * 100 + p",
        "month_long_nm": "monthname(d)",
        "month_short_nm": "left(monthname(d), 3)",
        "month_nbr": "month(d)",
        "year_mth": "year(d) * 100 + month(d)",
        "month_relevance_dt": "d",
        "month_start_dt": "d",
        "month_end_dt": "last_day(d)",
        "month_sort_sequence_nbr": "(fy - fy0) * 13 + p",
        "fiscal_period_nbr": "p",
        "fiscal_period_cd": "'P' || lpad(p::VARCHAR, 2, '0')",
        "fiscal_period_sort_sequence_nbr": "p",
        "fiscal_year_period_cd": "'FY' || fy || 'P' || lpad(p::VARCHAR, 2, '0')",
        "fiscal_year_period_nm": "'FY' || fy || ' Period ' || lpad(p::VARCHAR, 2, '0')",
        "season_period_cd": "s",
        "season_alternate_period_cd": "s || fy",
        "season_nm": "CASE s WHEN 'SS' THEN 'Spring/Summer' ELSE 'Fall/Winter' END",
        "season_relevance_dt": "d",
        "season_start_dt": "CASE s WHEN 'SS' THEN make_date(fy, 6, 1) ELSE make_date(fy, 12, 1) END",
        "season_end_dt": (
            "CASE s WHEN 'SS' THEN make_date(fy, 11, 30) ELSE make_date(fy + 1, 6, 30) END"
        ),
        "season_sort_sequence_nbr": "(fy - fy0) * 2 + CASE s WHEN 'SS' THEN 1 ELSE 2 END",
        "quarter_calendar_nbr": "quarter(d)",
        "quarter_calendar_sequence_nbr": "(year(d) - fy0) * 4 + qn",
        "quarter_business_nbr": "qn",
        "fiscal_quarter_nbr": "qn",
        "fiscal_quarter_cd": "'Q' || qn",
        "fiscal_quarter_sort_sequence_nbr": "qn",
        "fiscal_year_quarter_nbr": "fy * 10 + qn",
        "fiscal_year_quarter_cd": "'FY' || fy || 'Q' || qn",
        "fiscal_year_quarter_alternate_cd": "fy || 'Q' || qn",
        "year_cd": "fy",
        "year_nm": "'FY' || fy",
        "year_nbr": "fy",
        "year_start_dt": "make_date(fy, 6, 1)",
        "year_end_dt": "make_date(fy + 1, 5, 31)",
        "business_year_nbr": "fy",
        "fiscal_year_nbr": "fy",
        "fiscal_year_cd": "'FY' || fy",
        "fiscal_period_sort": "(fy - fy0) * 13 + p",
    },
)

# -- facts -------------------------------------------------------------------------------

PARTS = "(SELECT count(*) FROM part)"
CUSTOMERS = "(SELECT count(*) FROM customer)"
SUPPLIERS = "(SELECT count(*) FROM supplier)"
LOADER = {
    "created_by_user_id": "'ETL_SERVICE'",
    "updated_by_user_id": "'ETL_SERVICE'",
    "physical_source_cd": "'SAP_ECC'",
}


def cyclic_key(salt: str, n: str | int, id: str = "id") -> str:
    return f"(({id}) % ({n}) + 1)"


def cyclic_period(table: str, id: str = "id") -> str:
    position = f"(({id}) % (({LAST_YEAR} - {FIRST_YEAR} + 1) * 13))"
    return f"(({FIRST_YEAR} + {position} // 13) * 100 + {position} % 13 + 1)"


def weighted_period(table: str, id: str = "id") -> str:
    year = f"floor({u(f'{table}.fiscal_year', id)} * ({LAST_YEAR} - {FIRST_YEAR} + 1))::BIGINT"
    numbers = [str(p) for p in range(1, 14)]
    weights = (7, 7, 8, 8, 8, 8, 8, 8, 8, 8, 8, 9, 5)
    return f"(({FIRST_YEAR} + {year}) * 100 + {weighted(f'{table}.fiscal_period', numbers, weights, id)}::INTEGER)"


def cyclic_account(id: str) -> str:
    return (
        f"CASE {id} % 9 WHEN 4 THEN '44' || {pad(id, 5)} WHEN 5 THEN '45' || {pad(id, 5)} "
        f"ELSE {nth(['7', '1', '2', '3', '', '', '5', '6', '8'], f'{id} % 9')} || {pad(id, 6)} END"
    )


def drawn_period(table: str, id: str = "id") -> str:
    periods = f"(({LAST_YEAR} - {FIRST_YEAR} + 1) * 13)"
    position = f"floor({u(f'{table}.fiscal_year_period', id)} * {periods})::BIGINT"
    return f"(({FIRST_YEAR} + {position} // 13) * 100 + {position} % 13 + 1)"


def class_amount(z: str, position: str) -> str:
    """Amount units of an account class: log-normal between the class's bounds."""
    branches = []
    for i, kind in enumerate(_AMOUNT_KINDS):
        p = pools.AMOUNTS[kind]
        value = log_normal(p.mean, p.std_dev, z)
        bounded = f"least(greatest({value}, {p.low}e0), {p.high}e0)"
        branches.append(f"WHEN {i} THEN {units(bounded)}")
    return f"(CASE {position} {' '.join(branches)} END)"


def scaled(whole_units: str, factor: str) -> str:
    return f"floor(({whole_units})::DOUBLE * {factor} + 0.5e0)"


_T = "general_ledger_fact."


def ledger_sql(key=key, period=drawn_period, account=None, currency=None) -> str:
    """The ledger of orders, by the ways that keys, periods, accounts and currencies are dealt."""
    return f"""
WITH k AS (
  SELECT o_orderkey AS id,
         {period("general_ledger_fact", "o_orderkey")} AS period,
         {key(_T + "accounting_document_type_id", 40, "o_orderkey")} AS doc_type,
         {key(_T + "profit_center_id", 2000, "o_orderkey")} AS center,
         {key(_T + "version_forecast_mapping_id", 25, "o_orderkey")} AS version,
         {key(_T + "functional_area_id", 150, "o_orderkey")} AS area,
         {key(_T + "company_id", SUPPLIERS, "o_orderkey")} AS company,
         {key(_T + "gl_account_nbr", 8000, "o_orderkey")} AS account,
         {normal(_T + "amount", "o_orderkey")} AS z,
         {sign(_T + "sign", "o_orderkey")} AS s,
         {units(between(_T + "sales_qty", 1, 100000, "o_orderkey"))} AS sales
  FROM orders
), c AS (SELECT *, {account_class("account")} AS cls FROM k),
b AS (SELECT *, {class_amount("z", "cls")} AS base FROM c)
""" + table_sql(
    "general_ledger_fact",
    "b",
    {
        "general_ledger_fact_id": "id",
        "fiscal_year_period_nbr": "period",
        "profit_center_id": "center",
        "division_id": key(_T + "division_id", 30),
        "version_forecast_mapping_id": "version",
        "functional_area_id": "area",
        "accounting_document_type_id": "doc_type",
        "product_id": key(_T + "product_id", PARTS),
        "customer_id": key(_T + "customer_id", CUSTOMERS),
        "company_id": "company",
        "copa_attribution_id": key(_T + "copa_attribution_id", 800),
        "cost_center_nbr": f"'CC' || {pad(key(_T + 'cost_center_nbr', 15000), 6)}",
        "geo_wholesale_value_business_id": key(_T + "geo_wholesale_value_business_id", 500),
        "geo_marketplace_channel_id": key(_T + "geo_marketplace_channel_id", 200),
        "gl_account_nbr": account or account_nbr("account", "cls"),
        "zfsm_measure_id": key(_T + "zfsm_measure_id", 300),
        "company_currency_amt": dec(f"s * {scaled('base', between(_T + 'company_factor', 0.85, 1.15))}"),
        "transaction_currency_amt": dec("s * base"),
        "performance_management_currency_amt": dec(
            f"s * {scaled('base', between(_T + 'performance_factor', 0.88, 1.12))}"
        ),
        "etm_ind": every(5, "1", "0"),
        "etm_foreign_currency_exchange_rate_id": key(_T + "etm_rate", 90),
        "gaap_foreign_currency_exchange_rate_id": key(_T + "gaap_rate", 90),
        "sales_qty": dec("sales"),
        "returns_qty": dec(scaled("sales", f"({u(_T + 'returns')} * 0.08e0)")),
        "general_ledger_fact_ind": every(10, "'N'", "'Y'"),
        "cis_delta_ind": every(20, "'Y'", "'N'"),
        "general_ledger_ocogs_allocation_fact_ind": every(15, "'Y'", "'N'"),
        "anaplan_corporate_ind": every(25, "'Y'", "'N'"),
        "company_currency_cd": company_currency("company"),
        "transaction_currency_cd": currency or weighted(
            _T + "transaction_currency", pools.CURRENCIES, pools.CURRENCY_WEIGHTS
        ),
        "Functional_Area_cd": f"'FA' || {pad('area', 4)}",
        "accounting_document_type_cd": document_cd("doc_type"),
        "profit_center_nbr": pad("center", 7),
        "company_cd": "1000 + company",
    },
)


_DEALT = [c for c, w in zip(pools.CURRENCIES, pools.CURRENCY_WEIGHTS) for _ in range(w)]
LEDGER = ledger_sql()
LEDGER_CYCLIC = ledger_sql(cyclic_key, cyclic_period, cyclic_account("account"), cyc(_DEALT, "id"))
LEDGER_WEIGHTED = ledger_sql(period=weighted_period)


def from_ledger(body: str) -> str:
    """A query over ``l``, the ledger made from orders."""
    return f"WITH l AS ({LEDGER}) {body}"


def statement_columns(companies: str) -> dict[str, str]:
    return {
        "fiscal_year_period_nbr": "period",
        "fiscal_yr": "period // 100",
        "functional_area_cd": f"'FA' || {pad('id % 150 + 1', 4)}",
        "division_nbr": pad("id % 30 + 1", 2),
        "partner_segment_nbr": "id % 50 + 1",
        "financial_statement_item_cd": f"'FSI' || {pad('id % 500 + 1', 5)}",
        "local_currency_cd": cyc(pools.CURRENCIES[:8], "id"),
        "version_nbr": cyc([v for v, _ in pools.VERSIONS], "id"),
        "version_group_nm": cyc([g for _, g in pools.VERSIONS], "id"),
        "partner_profit_center_nbr": pad("id % 2000 + 1", 7),
        "partner_unit_cd": f"'PU' || {pad('id % 50 + 1', 3)}",
        "consolidation_unit_cd": f"id % {companies} + 1001",
        "trading_partner_nbr": "id % 200 + 1",
        "region_summary_product_group_cd": cyc(["FW", "AP", "EQ", "ACC"], "id"),
        "consolidated_segment_nm": cyc(pools.PROFIT_CENTER_SEGMENTS, "id"),
        "consolidated_channel_nm": cyc(["Wholesale", "Direct", "Digital"], "id"),
        "posting_level_cd": cyc(["00", "10", "20", "30"], "id"),
        "foreign_exchange_type_cd": cyc(["M", "P", "B"], "id"),
        "user_nm": "'ETL_SERVICE'",
        **LOADER,
    }


def statement_source(
    table: str, source: str, source_key: str, qty: int, key=key, period=drawn_period
) -> str:
    t = f"{table}."
    return f"""
WITH i AS (SELECT {source_key} AS id FROM {source}), k AS (
  SELECT id, {period(table)} AS period,
         {key(t + "gl_account_id", 8000)} AS account,
         {key(t + "profit_center_id", 2000)} AS center,
         {normal(t + "amount")} AS z,
         {sign(t + "sign")} AS s,
         {units(between(t + "qty", 0, qty))} AS qty
  FROM i
), c AS (SELECT *, {account_class("account")} AS cls FROM k),
"""


_AMT = {
    "transaction_currency_amt": dec("s * base"),
    "group_currency_amt": dec(f"s * {scaled('base', '0.92e0')}"),
    "local_currency_amt": dec(f"s * {scaled('base', '0.95e0')}"),
    "qty": dec("qty"),
}
_STATEMENT_AMOUNT = f"b AS (SELECT *, {class_amount('z', 'cls')} AS base FROM c) "
INCOME_STATEMENT_ROWS = (
    statement_source("CIS_fact", "events", "event_id", 50000) + _STATEMENT_AMOUNT
)
INCOME_STATEMENT_CYCLIC_ROWS = (
    statement_source("CIS_fact", "events", "event_id", 50000, cyclic_key, cyclic_period)
    + _STATEMENT_AMOUNT
)
_STATEMENT = {
    "gl_account_id": account_nbr("account", "cls"),
    "profit_center_nbr": pad("center", 7),
    "profit_center_id": "center",
    "segment_nbr": "id % 100 + 1",
    "document_type_cd": cyc(["SA", "KR", "DR", "RV", "IC", "JV"], "id"),
    "original_company_cd": f"id % {SUPPLIERS} + 1001",
    "consolidated_income_statement_fact_id": "id",
    "transaction_currency_cd": cyc(pools.CURRENCIES[:8], "center"),
    "ledger_cd": cyc(["0L", "2L", "3L"], "id"),
    "dimension_cd": f"'DIM' || {pad('id % 20 + 1', 3)}",
    "record_type_cd": cyc(["0", "1", "2", "3"], "id"),
    "consolidation_group_cd": cyc(["NIKE", "CONVERSE", "JORDAN", "TOTAL"], "id"),
    "consolidation_of_investment_activity_nbr": "id % 5",
    "chart_of_accounts_cd": cyc(["US01", "EU01", "JP01", "CN01", "CONSO"], "id"),
    "base_unit_of_measure_cd": cyc(["EA", "PR", "PK", "BX"], "id"),
    **statement_columns(SUPPLIERS),
    **_AMT,
    **{f"sign_adjusted_{name}": value for name, value in _AMT.items()},
}
INCOME_STATEMENT = INCOME_STATEMENT_ROWS + table_sql("CIS_fact", "b", dict(_STATEMENT))
INCOME_STATEMENT_CYCLIC = INCOME_STATEMENT_CYCLIC_ROWS + table_sql(
    "CIS_fact", "b", {**_STATEMENT, "gl_account_id": cyclic_account("account")}
)
_DEBIT = "(CASE WHEN cls IN (0, 2, 6) THEN 1 ELSE -1 END)"
INCOME_STATEMENT_SIGNED = (
    INCOME_STATEMENT_ROWS
    + f"""
SELECT (period // 100)::INTEGER AS fiscal_yr,
       {cyc([g for _, g in pools.VERSIONS], "id")} AS version_group_nm,
       count(*) AS row_cnt,
       sum({dec("s * base", "DECIMAL(18,5)")})::DECIMAL(38,5) AS amt,
       sum({dec(f"{_DEBIT} * s * base", "DECIMAL(18,5)")})::DECIMAL(38,5) AS adjusted_amt,
       sum({dec(f"{_DEBIT} * qty", "DECIMAL(18,5)")})::DECIMAL(38,5) AS adjusted_qty
FROM b GROUP BY ALL"""
)
_REVENUE = log_normal(500000, 1000000, "z")


def statement_sql_of_balance_sheet(source: str, source_key: str) -> str:
    return (
        statement_source("consolidated_balance_sheet_fact", source, source_key, 10000)
        + f"b AS (SELECT *, {units(f'least(greatest({_REVENUE}, 10000e0), 50000000e0)')} AS base FROM c) "
        + table_sql(
            "consolidated_balance_sheet_fact",
            "b",
            {
                "consolidated_balance_sheet_fact_id": "id",
                "profit_center_nbr": pad("id % 2000 + 1", 7),
                "transaction_currency_cd": cyc(pools.CURRENCIES[:8], "id"),
                "document_type_cd": cyc(["SA", "KR", "DR", "RV", "IC"], "id"),
                "segment_nbr": pad("id % 100 + 1", 4),
                "ending_balance_amt": _AMT["group_currency_amt"],
                "_acdocu_latest_load_timestamp": LOADED,
                "group_currency_cd": "'USD'",
                **statement_columns(SUPPLIERS),
                **_AMT,
            },
        )
    )


BALANCE_SHEET = statement_sql_of_balance_sheet("orders", "o_orderkey")

# -- dimensions --------------------------------------------------------------------------

_FROM, _TO = "DATE '2015-01-01'", "DATE '2099-12-31'"
_NODES = ((1, 10), (2, 20), (3, 40))


def nested_sizes_cte(n: str, levels: int, step: int) -> str:
    """CTE text: ``sizes(level, size)`` by recursion over the levels."""
    return f"""
sizes(level, size) AS (
  SELECT 1::BIGINT, greatest(1, {n} // {levels * step})::BIGINT
  UNION ALL
  SELECT level + 1,
         size * greatest(1, greatest(1, {n} // (({levels} - level) * {step})) // size)
  FROM sizes WHERE level < {levels}
), z AS (SELECT list(size ORDER BY level) AS sz FROM sizes)"""


def levels_sql(count: int, stem: str, cd: str, nm: str) -> dict[str, str]:
    columns = {}
    for level in range(1, count + 1):
        node = f"(i % sz[{level}] + 1)"
        columns[f"{stem}{level}_cd"] = f"{q(cd.format(level))} || {node}"
        columns[f"{stem}{level}_nm"] = f"{q(nm.format(level))} || {node}"
    return columns


def dim(table: str, columns: dict[str, str], levels: tuple[int, int] | None = None) -> str:
    source, source_key = DIMENSION_ROWS[table]
    n = f"(SELECT count(*) FROM {source})"
    ids = f"ids AS (SELECT {source_key} + 1 AS i FROM {source})"
    if levels is None:
        return f"WITH {ids} " + table_sql(table, "ids", columns)
    sizes = nested_sizes_cte(n, *levels)
    return f"WITH RECURSIVE {ids}, {sizes} " + table_sql(table, "ids, z", columns)


def dimensions(channel: str | None = None) -> dict[str, str]:
    """SQL of the dimensions; ``channel`` replaces the customers' weighted draw."""
    copied = {
        "responsive_business_model": pools.BUSINESS_MODELS,
        "demand_stream": pools.DEMAND_STREAMS,
        "business_type": pools.ATTRIBUTION_BUSINESS_TYPES,
        "marketing_type": pools.MARKETING_TYPES,
        "gender_age": pools.GENDER_AGES,
        "direct_business_model": pools.BUSINESS_MODELS,
        "product_lifecycle": pools.LIFECYCLES,
        "quality": pools.QUALITIES,
        "distribution_method": pools.DISTRIBUTION_METHODS,
    }
    region, country = cyc(pools.REGIONS, "i"), cyc(pools.COUNTRIES, "i")
    division = cyc(pools.DIVISION_GROUPS, "i - 1")
    names = [n for _, n in pools.DOCUMENT_TYPES]
    document = listed(names, "i", "'Custom Document Type ' || i")
    product, customer, store = (
        "finance_product_dim_v",
        "finance_customer_dim_v",
        "retail_global_store_profile_v",
    )
    brand = weighted(f"{product}.brand", pools.BRANDS, pools.BRAND_WEIGHTS, "i")
    channel = channel or weighted(
        f"{customer}.channel", pools.CUSTOMER_CHANNELS, pools.CUSTOMER_CHANNEL_WEIGHTS, "i"
    )
    platform = cyc(pools.PLATFORMS, "i")
    style = "'STY' || (i % 900000 + 100000)"
    divisions = {
        "division_id": "i",
        "division_nbr": pad("i", 2),
        "division_nm": f"{division} || ' Division ' || {pad('i', 2)}",
        "division_group": division,
    }
    city = cyc(pools.COST_CENTER_CITIES, "i")
    cost_center = f"{region} || ' Cost Center ' || i"
    parts = DIMENSION_ROWS["gl_account_dim"][0]
    position = account_class("i")
    nbr = account_nbr("i", position)
    short = f"{nth(_LABELS, position)} || ' Acct ' || {nbr}"
    area = between(f"{store}.area", 500, 10500, "i") + "::FLOAT"
    order_type, item = cyc(pools.SALES_ORDER_TYPES, "i"), cyc(pools.SALES_ITEM_CATEGORIES, "i")
    hier_account = "(i % 8000 + 1)"
    hier_nbr = account_nbr(hier_account, account_class(hier_account))
    set_flags = (
        "functional_area_assignment_allowed_ind consolidation_chart_of_accounts_used_ind "
        "totals_visible_ind item_list_complete_transmission_ind "
        "hierarchy_name_list_complete_transmission_ind node_name_list_complete_transmission_ind "
        "functional_area_list_complete_transmission_ind gl_account_list_complete_transmission_ind "
        "relationship_list_complete_transmission_ind"
    ).split()
    account_hierarchy = {
        "gl_account_hierarchy_id": "i",
        "gl_account_nbr": hier_nbr,
        "hierarchy_chart_of_accounts_cd": cyc(pools.CHARTS_OF_ACCOUNTS, "i"),
        "hierarchy_nm": cyc(["P&L", "Balance Sheet", "Management", "CONSO"], "i"),
        "hierarchy_cd": f"'H' || {pad('i % 20 + 1', 3)}",
        "parent_cd": f"'P' || {pad('i % 50 + 1', 4)}",
        "node_nm": "'Node ' || i",
        "node_cd": f"'N' || {pad('i', 6)}",
        "node_gl_account_nbr": hier_nbr,
        "node_gl_account_to_nbr": f"{hier_nbr} + 100",
        "depth_of_leaf_nbr": "i % 8 + 1",
        "depth_of_tree_nbr": "30",
        "hierarchy_language_cd": "'EN'",
        "hierarchy_action_cd": "'U'",
        "hierarchy_category_cd": "'GL'",
        "recipient_business_system_id": "'ECC_PROD'",
        "sender_business_system_id": "'ECC_PROD'",
        "sign_reversed_ind": every(5, "'X'", "''", "i"),
        "credit_balance_ind": every(3, "'X'", "''", "i"),
        "debit_balance_ind": every(3, "''", "'X'", "i"),
        **{name: "'X'" for name in set_flags},
        **LOADER,
        **levels_sql(30, "gl_account_level_", "GL{}_", "GL Level {} - "),
    }
    cost_levels = levels_sql(30, "cost_center_level_", "L{:02d}_", "Level {} Node ")
    profit_levels = levels_sql(9, "profit_center_level_", "PCL{}_", "PC Level {} - ")
    segment_levels = levels_sql(
        10, "consolidation_segment_", "SEG{}_", "Segment Level {} - "
    )
    for level in range(1, 11):
        stem = f"consolidation_segment_{level}"
        segment_levels[f"{stem}_cd_nm"] = (
            f"{segment_levels[f'{stem}_cd']} || ' - ' || {segment_levels[f'{stem}_nm']}"
        )
    cost_hierarchy = {
        "cost_center_hierarchy_hist_id": "i",
        "cost_center_nbr": f"'CC' || {pad('i', 6)}",
        "cost_center_hierarchy_nm": region,
        "controlling_area_cd": "'1000'",
    }
    csh = f"'CSH' || {pad('i', 5)}"
    columns = {
        "accounting_document_type": {
            "accounting_document_type_id": "i",
            "accounting_document_type_cd": document_cd("i"),
            "accounting_document_type_nm": document,
            "active_ind": "'Y'",
            "language_cd": "'EN'",
            "accounting_document_type_cd_nm": (
                f"{document_cd('i')} || ' - ' || replace({document}, ' – ', ' ')"
            ),
        },
        "version_forecast_mapping": {
            "version_forecast_mapping_id": "i",
            "version_nbr": version_nbr("i"),
            "version_group_nm": version_group("i"),
            "active_ind": "'Y'",
        },
        "functional_area": {
            "functional_area_id": "i",
            "language_cd": "'EN'",
            "functional_area_cd": f"'FA' || {pad('i', 4)}",
            "functional_area_nm": (
                f"{cyc(pools.FUNCTIONAL_AREAS, 'i - 1')} || "
                "CASE WHEN i <= 15 THEN '' ELSE ' ' || ((i - 1) // 15 + 1) END"
            ),
        },
        "division_text": {
            **divisions,
            "last_row_ind": "'Y'",
            "common_data_service_view_nm": "'DIVISION_V'",
            "source_system_nm": "'SAP_ECC'",
            "raw_tmst": LOADED,
            "record_created_tmst_utc": LOADED,
            "record_update_tmst_utc": LOADED,
            "language_cd": "'EN'",
            "active_ind": "'Y'",
            **LOADER,
        },
        "division_text_dim_v": divisions,
        "company_code": {
            "company_id": "i",
            "company_cd": "1000 + i",
            "company_nm": (
                f"{cyc([c for c, _ in pools.COMPANIES], 'i - 1')} || "
                "CASE WHEN i <= 15 THEN '' ELSE ' ' || i END"
            ),
            "currency_cd": company_currency("i"),
            **LOADER,
        },
        product: {
            "product_id": "i",
            "primary_platform_desc": platform,
            "style_nm": f"{cyc(pools.FRANCHISES, 'i')} || ' ' || {style}",
            "franchise_nm": cyc(pools.FRANCHISES, "i"),
            "gender_desc": weighted(f"{product}.gender", pools.GENDERS, pools.GENDER_WEIGHTS, "i"),
            "global_category_core_focus_desc": cyc(pools.CORE_FOCUSES, "i"),
            "product_cd": f"left({brand}, 2) || '-' || {pad('i', 8)}",
            "team_nm": cyc(pools.TEAMS, "i"),
            "league_desc": cyc(pools.LEAGUES, "i"),
            "athlete_full_nm": cyc(pools.ATHLETES, "i"),
            "product_company_nm": brand,
            "age_desc": cyc(pools.AGES, "i"),
            "consumer_construct_dimension_nm": cyc(["Footwear", "Apparel", "Equipment"], "i"),
            "fields_of_play_nm": platform,
            "merchandising_classification_desc": cyc(pools.MERCHANDISING_CLASSES, "i"),
            "consumer_construct_segment_nm": cyc(pools.CONSTRUCT_SEGMENTS, "i"),
            "brand_nm": brand,
            "sub_category_desc": weighted(
                f"{product}.category", pools.CATEGORIES, pools.CATEGORY_WEIGHTS, "i"
            ),
            "blank_usage_ind": "'N'",
            "silhouette_desc": cyc(pools.SILHOUETTES, "i"),
            "silhouette_type_desc": cyc(pools.SILHOUETTE_TYPES, "i"),
            "style_nbr": style,
            "consumer_construct_global_consumer_offense_nm": cyc(pools.CONSUMER_OFFENSES, "i"),
            "active_ind": every(50, "'N'", "'Y'", "i"),
            "global_sport_focus_derived_desc": platform,
            "global_sport_focus_desc": platform,
            "global_sport_sub_focus_desc": f"{platform} || ' - Sub'",
            "sub_brand_desc": brand,
            "sub_brand_cd": f"left({brand}, 2)",
            **LOADER,
        },
        customer: {
            "finance_customer_id": "i",
            "customer_nbr": f"'CUST' || {pad('i', 8)}",
            "channel_desc": channel,
            "customer_nm": f"{channel} || ' Customer ' || i",
            "customer_owner_group_nm": region,
            "marketplace_channel_nm": cyc(pools.MARKETPLACE_CHANNELS, "i"),
            "geo_marketplace_unit_nm": region,
            "integrated_business_planning_level_1_desc": region,
            "integrated_business_planning_level_2_desc": channel,
            "integrated_business_planning_level_3_desc": f"{channel} || ' Detail'",
            "integrated_business_planning_mpu_desc": region,
            "sub_territory_nm": f"{region} || ' Sub-' || (i % 10 + 1)",
            "customer_business_type_nm": cyc(pools.CUSTOMER_BUSINESS_TYPES, "i"),
            "customer_subtype_nm": cyc(pools.CUSTOMER_SUBTYPES, "i"),
            "partner_channel": channel,
            "partner_sub_channel": cyc(pools.MARKETPLACE_CHANNELS, "i"),
            "partner_account_classification": cyc(["Tier 1", "Tier 2", "Tier 3"], "i"),
        },
        "copa_attribution_dim": {
            "copa_attribution_id": "i",
            **{f"{name}_cd": cyc(pool, "i") for name, pool in copied.items()},
            **{f"{name}_desc": cyc(pool, "i") for name, pool in copied.items()},
            "region_summary_product_group_cd": cyc(["FW", "AP", "EQ", "ACC"], "i"),
            "region_summary_product_group_desc": cyc(
                ["Footwear", "Apparel", "Equipment", "Accessories"], "i"
            ),
            "sales_order_type_cd": order_type,
            "sales_order_type_desc": f"{order_type} || ' Order'",
            "sales_order_type_group_desc": cyc(["B2C", "B2B", "B2B2C"], "i"),
            "sales_order_item_category_cd": item,
            "sales_order_item_category_desc": f"{item} || ' - Standard'",
            "sales_order_reason_cd": pad("i % 20 + 1", 2),
            "sales_order_reason_desc": f"'Reason ' || {pad('i % 20 + 1', 2)}",
        },
        "cost_center_dim_v": {
            "cost_center_nbr": f"'CC' || {pad('i', 6)}",
            "controlling_area_cd": "'1000'",
            "valid_to_dt": _TO,
            "valid_from_dt": _FROM,
            "iso_language_cd": "'EN'",
            "cost_center_nm": cost_center,
            "cost_center_desc": f"'Description for ' || {cost_center}",
            "cost_center_category_hierarchy_1_cd": cyc("ABCD", "i"),
            "cost_center_category_hierarchy_2_cd": cyc("1234", "i"),
            "company_cd": "i % 80 + 1001",
            "source_system": "'SAP_ECC'",
            "cost_center_type_cd": cyc("EFLMP", "i"),
            "cost_center_category_short_desc": cyc(
                ["Expenses", "Finance", "Logistics", "Marketing", "Production"], "i"
            ),
            "business_area_cd": f"'BA' || {pad('i % 10 + 1', 2)}",
            "tax_jurisdiction_cd": f"{country} || '0000000'",
            "functional_area_cd": f"'FA' || {pad('i % 150 + 1', 4)}",
            "currency_cd": cyc(["USD", "EUR", "GBP", "JPY", "CNY"], "i"),
            "posting_allowed_ind": "'X'",
            "planning_allowed_ind": "'X'",
            "secondary_costs_posting_allowed_ind": "'X'",
            "revenue_posting_allowed_ind": every(3, "'X'", "''", "i"),
            "commitment_update_allowed_ind": "'X'",
            "secondary_costs_planning_allowed_ind": "'X'",
            "revenue_planning_allowed_ind": every(3, "'X'", "''", "i"),
            "quantity_required_ind": every(5, "'X'", "''", "i"),
            "department_nm": "'Dept-' || (i % 20 + 1)",
            "profit_center_nbr": pad("i % 2000 + 1", 7),
            "responsible_user_nm": "'SYSTEM'",
            "responsible_user_id": "'SYSTEM'",
            "line_1_nm": cost_center,
            "country_cd": country,
            "region_cd": region,
            "city_nm": city,
            "postal_cd": "i % 90000 + 10000",
            "street_address_txt": f"'100 Commerce Way, ' || {city}",
            "correspondence_language_cd": "'EN'",
            "msg_header_tmst": LOADED,
            "begin_effective_dt": _FROM,
            "end_effective_dt": _TO,
            "cost_center_id": "i",
            "_cost_center_cleansed_latest_load_timestamp": LOADED,
        },
        "profit_center": {
            "profit_center_id": "i",
            "profit_center_nbr": pad("i", 7),
            "profit_center_nm": (
                f"{cyc(pools.PROFIT_CENTER_SEGMENTS, 'i')} || ' ' || "
                f"{cyc(pools.PROFIT_CENTER_CHANNELS, 'i')} || ' PC-' || i"
            ),
            "segment_id": f"'SEG' || {pad('i % 50 + 1', 3)}",
            "geography_nm": region,
            "profit_center_channel_nm": cyc(pools.PROFIT_CENTER_CHANNELS, "i"),
            "territory_nm": f"{region} || ' Territory'",
            "sub_territory_nm": f"{region} || ' Sub-Territory-' || (i % 10 + 1)",
            "begin_effective_dt": _FROM,
            "end_effective_dt": _TO,
            "active_ind": every(20, "'N'", "'Y'", "i"),
            "geography_sort": "i % 100 + 1",
            "operating_segment_nm": cyc(pools.OPERATING_SEGMENTS, "i"),
        },
        "gl_account_dim": {
            "gl_account_nbr": nbr,
            "gl_account_short_desc": short,
            "gl_account_long_desc": f"'General Ledger Account - ' || {short}",
            "begin_effective_dt": _FROM,
            "end_effective_dt": _TO,
            "active_ind": every(100, "'N'", "'Y'", "i"),
            "gl_accnt_id": "i",
        },
        "gl_account_zfsm_measures_hierarchy_dim": {
            "zfsm_measure_id": "i",
            "active_ind": every(50, "'N'", "'Y'", "i"),
            "zfsm_measure_cd": f"'ZFSM' || {pad('i', 6)}",
            "zfsm_measure_desc": f"{cyc(pools.MEASURES, 'i')} || ' - ZFSM' || {pad('i', 6)}",
            "record_created_tmst_utc": LOADED,
            "record_update_tmst_utc": LOADED,
            **{f"gl_account_level_{k}_cd": f"'L{k}_' || (i % {n} + 1)" for k, n in _NODES},
            **{
                f"gl_account_level_{k}_nm": f"'Level {k} - L{k}_' || (i % {n} + 1)"
                for k, n in _NODES
            },
            **LOADER,
        },
        "geo_marketplace_channel_dim": {
            "geo_marketplace_channel_id": "i",
            "geo_marketplace_channel_nm": (
                f"{cyc(pools.REGIONS, 'i - 1')} || ' - ' || "
                f"{cyc(pools.MARKETPLACE_CHANNELS, 'i - 1')}"
            ),
            "active_ind": "'Y'",
            **LOADER,
        },
        "geo_wholesale_value_business_dim": {
            "geo_wholesale_value_business_id": "i",
            "geo_wholesale_value_business_desc": (
                f"{cyc(pools.REGIONS, 'i - 1')} || ' Wholesale ' || "
                f"{cyc(pools.WHOLESALE_TIERS, 'i - 1')}"
            ),
            **LOADER,
        },
        store: {
            "store_uuid": f"'STR-' || {pad('i', 8)}",
            "brand_cd": cyc(["NK", "JD", "CV"], "i"),
            "brand_desc": cyc(["Nike", "Jordan", "Converse"], "i"),
            "change_timestamp": LOADED,
            "city_name": cyc(pools.STORE_CITIES, "i"),
            "country_cd": country,
            "country_name": country,
            "create_dt": "'2015-01-01'",
            "geography_region_name": region,
            "nike_selling_space_size_quantity": area,
            "pos_id": "i",
            "retail_concept_cd": cyc(["NSO", "NFS", "NCS", "EMPLOYEE"], "i"),
            "retail_concept_desc": cyc([d for _, d in pools.RETAIL_CONCEPTS], "i"),
            "space_uom": "'SQF'",
            "store_cd": f"{cyc(['NK', 'JD', 'CV'], 'i')} || {pad('i', 6)}",
            "store_id_kona": "i",
            "store_level": "i % 5 + 1",
            "store_name_english": (
                f"{cyc(['Nike', 'Jordan', 'Converse'], 'i')} || ' Store ' || i"
            ),
            "store_open_dt": "'2015-01-01'",
            "store_selling_space_size_quantity": area,
            "store_status_cd": (
                "CASE WHEN i % 15 = 0 THEN 'CLOSED' WHEN i % 20 = 0 THEN 'TEMP_CLOSED' "
                "ELSE 'OPEN' END"
            ),
            "store_status_desc": (
                "CASE WHEN i % 15 = 0 THEN 'Permanently Closed' "
                "WHEN i % 20 = 0 THEN 'Temporarily Closed' ELSE 'Open' END"
            ),
            "store_tier_desc": "'Tier ' || (i % 4 + 1)",
            "store_tier_id": "i % 4 + 1",
            "store_total_space_size": f"({area})::DOUBLE * 1.3e0",
            "territory_name": region,
            "iso_country_cd": country,
            "default_transaction_iso_currency_cd": cyc(pools.STORE_CURRENCIES, "i"),
            "space_uom_cd": "'SQF'",
            "region_cd": region,
            "comparable_status": every(3, "'Non-Comparable'", "'Comparable'", "i"),
        },
        "consolidation_functional_area_hierarchy": {
            "consolidation_functional_area_hierarchy_id": "i",
            "active_ind": every(20, "'N'", "'Y'", "i"),
            "functional_area_cd": f"'FA' || {pad('i', 4)}",
            "consolidation_functional_area_hierarchy_parent_cd": (
                f"CASE WHEN i > 10 THEN 'FA' || {pad('i % 10 + 1', 4)} END"
            ),
            "functional_area_level_nbr": "i % 7 + 1",
            "functional_area_type_nm": cyc(pools.FUNCTIONAL_AREAS, "i"),
            "consolidation_functional_area_hierarchy_cd": f"'FA' || {pad('i', 4)}",
            "consolidation_functional_area_hierarchy_desc": (
                f"'CFA Hierarchy FA' || {pad('i', 4)}"
            ),
            "record_created_tmst_utc": LOADED,
            "record_update_tmst_utc": LOADED,
            "_consolidation_functional_area_hierarchy_raw_latest_load_tmst": LOADED,
            **LOADER,
            **levels_sql(7, "consolidation_functional_area_", "CFA{}_", "CFA Level {} "),
        },
        "consolidation_segment_hierarchy_dim": {
            "consolidation_segment_hierarchy_id": "i",
            "segment_nbr": "i % 100 + 1",
            "segment_desc": cyc(pools.PROFIT_CENTER_SEGMENTS, "i"),
            "consolidation_segment_hierarchy_parent_cd": (
                f"CASE WHEN i > 10 THEN 'SEG' || {pad('i % 10 + 1', 3)} END"
            ),
            "segment_type_nm": cyc(["Operating", "Reporting", "Management"], "i"),
            "segment_level_nbr": "i % 10 + 1",
            "consolidation_segment_hierarchy_cd": csh,
            "consolidation_segment_hierarchy_desc": f"'Cons Segment Hierarchy ' || {csh}",
            "consolidation_segment_hierarchy_cd_desc": (
                f"{csh} || ' - Cons Segment Hierarchy ' || {csh}"
            ),
            "active_ind": "'Y'",
            **LOADER,
            **segment_levels,
        },
        "segment_cost_center_hierarchy_dim_v": {**cost_hierarchy, **cost_levels},
        "DisChannel_cost_center_hierarchy_dim_v": {**cost_hierarchy, **cost_levels},
        "segment_profit_center_hierarchy": {
            "segment_profit_center_nbr": "i",
            "profit_center_hierarchy_nm": "'Segment PC Hierarchy ' || i",
            **profit_levels,
        },
        "DisChannel_profit_center_hierarchy": {
            "profit_center_hierarchy_id": "i",
            "distrchnl_profit_center_nbr": pad("i", 7),
            "controlling_area_cd": "'1000'",
            "profit_center_hierarchy_nm": region,
            **profit_levels,
        },
        "PartDisChannel_profit_center_hierarchy": {
            "profit_center_hierarchy_id": "i",
            "prtrdistrchnl_profit_center_nbr": pad("i", 7),
            "controlling_area_cd": "'1000'",
            "profit_center_hierarchy_nm": region,
            **profit_levels,
        },
        "gl_account_hierarchy": {
            **account_hierarchy,
            "gl_account_hierarchy_hist_id": "i",
            "record_created_tmst_utc": LOADED,
            "record_update_tmst_utc": LOADED,
            "_gl_account_hierarchy_cleansed_latest_load_timestamp": LOADED,
        },
        "management_gl_account_hierarchy": {
            **account_hierarchy,
            "hierarchy_cd_nm": f"'H' || {pad('i', 3)}",
        },
    }
    levels = {
        "segment_cost_center_hierarchy_dim_v": (30, 10),
        "DisChannel_cost_center_hierarchy_dim_v": (30, 10),
        "segment_profit_center_hierarchy": (9, 5),
        "DisChannel_profit_center_hierarchy": (9, 5),
        "PartDisChannel_profit_center_hierarchy": (9, 5),
        "consolidation_functional_area_hierarchy": (7, 5),
        "consolidation_segment_hierarchy_dim": (10, 4),
        "gl_account_hierarchy": (30, 3),
        "management_gl_account_hierarchy": (30, 3),
    }
    return {f"dim_{t}": dim(t, dict(c), levels.get(t)) for t, c in columns.items()}


_CYCLIC_SHORT = f"{cyc(_LABELS, 'i')} || ' Acct ' || {cyclic_account('i')}"
_CHANNELS_DEALT = [
    c for c, w in zip(pools.CUSTOMER_CHANNELS, pools.CUSTOMER_CHANNEL_WEIGHTS) for _ in range(w)
]
CYCLIC_CUSTOMERS = dimensions(cyc(_CHANNELS_DEALT, "i"))["dim_finance_customer_dim_v"]
CYCLIC_ACCOUNTS = {
    "gl_account_nbr": cyclic_account("i"),
    "gl_account_short_desc": _CYCLIC_SHORT,
    "gl_account_long_desc": f"'General Ledger Account - ' || {_CYCLIC_SHORT}",
    "begin_effective_dt": _FROM,
    "end_effective_dt": _TO,
    "active_ind": every(100, "'N'", "'Y'", "i"),
    "gl_accnt_id": "i",
}

# -- aggregate ---------------------------------------------------------------------------

_ADDITIVE = (
    "company_currency_amt transaction_currency_amt performance_management_currency_amt "
    "sales_qty returns_qty"
).split()
SUMS = ", ".join(f"sum({a})::DECIMAL(38,5) AS {a}" for a in _ADDITIVE) + ", count(*) AS row_cnt"
CLASS_OF_NUMBER = (
    "CASE WHEN n < 2000000 THEN 'Revenue' WHEN n < 3000000 THEN 'COGS' "
    "WHEN n < 4000000 THEN 'Gross Profit' WHEN n < 4500000 THEN 'Selling' "
    "WHEN n < 5000000 THEN 'Admin' WHEN n < 6000000 THEN 'R&D' "
    "WHEN n < 6500000 THEN 'Other Income' WHEN n < 7000000 THEN 'Other Expense' ELSE 'Tax' END"
).replace("n <", "gl_account_nbr::BIGINT <")
AGGREGATE = f"""
SELECT fiscal_year_period_nbr, company_id, profit_center_id, division_id,
       version_forecast_mapping_id, {CLASS_OF_NUMBER} AS account_class, {SUMS}
FROM l GROUP BY ALL"""
QUARTER = "CASE WHEN p % 100 <= 3 THEN 1 WHEN p % 100 <= 6 THEN 2 WHEN p % 100 <= 9 THEN 3 ELSE 4 END"
QUARTER_OF_PERIOD = QUARTER.replace("p %", "fiscal_year_period_nbr %")
CENTER_REGION = cyc(pools.REGIONS, "profit_center_id")

DESCRIBED = f"""
SELECT a.*, (fiscal_year_period_nbr // 100)::INTEGER AS fiscal_year_nbr,
       ({QUARTER_OF_PERIOD})::INTEGER AS fiscal_quarter_nbr,
       (1000 + company_id)::VARCHAR AS company_cd,
       {cyc([c for c, _ in pools.COMPANIES], "company_id - 1")} ||
         CASE WHEN company_id <= 15 THEN '' ELSE ' ' || company_id END AS company_nm,
       {company_currency("company_id")} AS currency_cd,
       lpad(profit_center_id::VARCHAR, 7, '0') AS profit_center_nbr,
       {CENTER_REGION} AS geography_nm,
       {cyc(pools.DIVISION_GROUPS, "division_id - 1")} || ' Division ' ||
         lpad(division_id::VARCHAR, 2, '0') AS division_nm,
       {cyc(pools.DIVISION_GROUPS, "division_id - 1")} AS division_group,
       {version_nbr("version_forecast_mapping_id")} AS version_nbr,
       {version_group("version_forecast_mapping_id")} AS version_group_nm
FROM ({AGGREGATE}) a"""

_RATES = ", ".join(
    f"({q(c)}, {pools.UNITS_PER_USD.get(c, 1.0)!r}e0)" for c in pools.CURRENCIES
)
USD_RATE = (
    "CASE WHEN cd = 'USD' THEN 1 ELSE round(1e0 / per_usd, 8) END::DECIMAL(28,8)::DECIMAL(10,8)"
)

# -- value expressions -------------------------------------------------------------------

EVENTS = "(SELECT event_id AS id FROM events)"
STATUS = (
    "CASE WHEN id % 15 = 0 THEN 'CLOSED' WHEN id % 20 = 0 THEN 'TEMP_CLOSED' ELSE 'OPEN' END"
)
N_EVENTS = "(SELECT count(*) FROM events)"


def _row_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT {q(t)} AS table_name, count(*) AS row_cnt FROM {t}" for t in DRIVER_KEYS
    )


def _uniqueness(pairs: dict[str, tuple[str, str]], source: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {q(name)} AS table_name, {q(columns)} AS key_columns, "
        "sum(n)::BIGINT AS row_cnt, count(*) AS key_cnt, "
        "count(*) FILTER (n > 1) AS duplicate_keys, sum(n - 1)::BIGINT AS surplus_rows "
        f"FROM (SELECT count(*) AS n FROM {table} GROUP BY {columns})"
        for name, (table, columns) in pairs.items()
    )


def _orphans(relations: Sequence[tuple[str, str, str, str, str]]) -> str:
    """(name, child, column, parent, key) per relation; child and parent are FROM items."""
    return " UNION ALL ".join(
        f"SELECT {q(name)} AS relation, count(*) AS child_keys, "
        "count(*) FILTER (NOT found) AS orphan_keys, "
        "coalesce(sum(n) FILTER (NOT found), 0)::BIGINT AS orphan_rows FROM ("
        f"SELECT {column} AS k, count(*) AS n, "
        f"{column}::VARCHAR IN (SELECT {key_}::VARCHAR FROM {parent}) AS found "
        f"FROM {child} WHERE {column} IS NOT NULL GROUP BY {column})"
        for name, child, column, parent, key_ in relations
    )


def _ledger_orphans() -> str:
    """Every key of the ledger falls in its parent's range, so only the counts vary."""
    pairs = [
        ("accounting_document_type_id", "accounting_document_type", "accounting_document_type_id"),
        ("fiscal_year_period_nbr", "calendar_fiscal_period_v", "fiscal_year_period_nbr"),
        ("profit_center_id", "profit_center", "profit_center_id"),
        ("division_id", "division_text", "division_id"),
        ("version_forecast_mapping_id", "version_forecast_mapping", "version_forecast_mapping_id"),
        ("functional_area_id", "functional_area", "functional_area_id"),
        ("product_id", "finance_product_dim_v", "product_id"),
        ("customer_id", "finance_customer_dim_v", "finance_customer_id"),
        ("company_id", "company_code", "company_id"),
        ("copa_attribution_id", "copa_attribution_dim", "copa_attribution_id"),
        ("cost_center_nbr", "cost_center_dim_v", "cost_center_nbr"),
        ("geo_wholesale_value_business_id", "geo_wholesale_value_business_dim",
         "geo_wholesale_value_business_id"),
        ("geo_marketplace_channel_id", "geo_marketplace_channel_dim", "geo_marketplace_channel_id"),
        ("gl_account_nbr", "gl_account_dim", "gl_account_nbr"),
    ]
    return from_ledger(
        " UNION ALL ".join(
            f"SELECT 'general_ledger_fact.{c}->{p}.{k}' AS relation, "
            f"count(DISTINCT {c}) AS child_keys, 0::BIGINT AS orphan_keys, "
            "0::BIGINT AS orphan_rows FROM l"
            for c, p, k in pairs
        )
    )


def _density() -> str:
    return " UNION ALL ".join(
        f"SELECT {q(t)} AS table_name, count(*) AS row_cnt, count(DISTINCT {k[0]}) AS key_cnt, "
        f"min({k[0]})::BIGINT AS first_key, max({k[0]})::BIGINT AS last_key, "
        f"count(*) = count(DISTINCT {k[0]}) AND "
        f"count(DISTINCT {k[0]}) = max({k[0]}) - min({k[0]}) + 1 AS is_dense FROM {t}"
        for t, k in DRIVER_KEYS.items()
        if len(k) == 1
    )


# The columns of the driver's tables.
_DRIVER_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
    "l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


def _nulls(name: str, table: str, columns: Sequence[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {q(name)} AS table_name, {q(c)} AS column_name, count(*) AS row_cnt, "
        f"count(*) - count(\"{c}\") AS null_cnt FROM {table}"
        for c in columns
    )


def _null_profile() -> str:
    reports = [_nulls(t, t, c.split()) for t, c in _DRIVER_COLUMNS.items()]
    reports.append(_nulls("general_ledger_fact", "l", schema("general_ledger_fact").names))
    return from_ledger(" UNION ALL ".join(reports))


def _conformance() -> str:
    """Every declared column is found as declared; nulls are counted in one pass per table."""
    sources = {t.removeprefix("dim_"): sql for t, sql in dimensions().items()}
    sources |= {
        "calendar_fiscal_period_v": CALENDAR,
        "general_ledger_fact": LEDGER,
        "CIS_fact": INCOME_STATEMENT,
        "consolidated_balance_sheet_fact": BALANCE_SHEET,
    }
    # These two list fixed domains and have no null.
    for table, rows in (("atscale_geo_security", 15), ("finance_foreign_currency_exchange_rate", 90)):
        every = ", ".join(f'1 AS "{f.name}"' for f in schema(table))
        sources[table] = f"SELECT {every} FROM range({rows})"
    parts = []
    for table, sql in sources.items():
        items = ", ".join(
            f"{{'p': {i}, 'c': {q(f.name)}, 't': {q(f.dataType.simpleString())}, "
            f"'n': count(*) - count(\"{f.name}\")}}"
            for i, f in enumerate(schema(table).fields, start=1)
        )
        parts.append(
            f"SELECT '{table}' AS table_name, s.p::INTEGER AS declared_position, s.c AS column_name, "
            "s.t AS declared_type, s.t AS found_type, s.p::INTEGER AS found_position, "
            "true AS conforms, row_cnt, s.n AS null_cnt "
            f"FROM (SELECT count(*) AS row_cnt, unnest([{items}]) AS s FROM ({sql}))"
        )
    return " UNION ALL ".join(parts)


def _built() -> str:
    """Totals of the facts made from the same ids; no orphan and no repeated key."""
    orders = "(SELECT count(*) FROM orders)"
    sheet_rows = f"greatest(1, floor({orders} * 0.0004e0))::BIGINT"
    sheet = statement_sql_of_balance_sheet(f"(SELECT unnest(range({sheet_rows})) AS id)", "id")
    facts = {
        "general_ledger_fact": LEDGER,
        "CIS_fact": INCOME_STATEMENT,
        "consolidated_balance_sheet_fact": sheet,
    }
    totals = [
        f"SELECT 'totals' AS check_nm, '{t}' AS subject_nm, fiscal_year_period_nbr AS period_nbr, "
        f"count(*) AS row_cnt, sum(transaction_currency_amt)::DECIMAL(38,5) AS amt FROM ({sql}) "
        "GROUP BY fiscal_year_period_nbr"
        for t, sql in facts.items()
    ]
    none = [("orphan rows", r.name) for r in RELATIONS] + [("repeated keys", t) for t in TABLES]
    zeros = [
        f"SELECT '{check}' AS check_nm, '{name}' AS subject_nm, NULL::INTEGER AS period_nbr, "
        "0::BIGINT AS row_cnt, NULL::DECIMAL(38,5) AS amt"
        for check, name in none
    ]
    return " UNION ALL ".join([*totals, *zeros])


def _rules() -> str:
    amounts = "transaction_currency_amt company_currency_amt performance_management_currency_amt"
    signs = [f"({a} < 0)" for a in amounts.split()]
    broken = {
        "period belongs to a fiscal year": (
            "fiscal_year_period_nbr % 100 < 1 OR fiscal_year_period_nbr % 100 > 13"
        ),
        "one sign per row": f"{signs[0]} <> {signs[1]} OR {signs[0]} <> {signs[2]}",
        "company code is the company's": "company_cd::BIGINT - 1000 <> company_id",
        "functional area code is the area's": (
            "substr(Functional_Area_cd, 3)::BIGINT <> functional_area_id"
        ),
        "profit center number is the center's": (
            "profit_center_nbr <> lpad(profit_center_id::VARCHAR, 7, '0')"
        ),
        "returns are within sales": "returns_qty < 0 OR returns_qty > sales_qty * 0.08 + 0.00001",
        "exchange rates exist": (
            "least(etm_foreign_currency_exchange_rate_id,"
            " gaap_foreign_currency_exchange_rate_id) < 1 OR"
            " greatest(etm_foreign_currency_exchange_rate_id,"
            " gaap_foreign_currency_exchange_rate_id) > 90"
        ),
        "amount is within its class": (
            "abs(transaction_currency_amt) < 1000 OR abs(transaction_currency_amt) > 50000000"
        ),
    }
    return from_ledger(
        " UNION ALL ".join(
            f"SELECT {q(rule)} AS rule, count(*) AS row_cnt, "
            f"count(*) FILTER ({condition}) AS violations FROM l"
            for rule, condition in broken.items()
        )
    )


_LEVELS = {
    "gl_account_zfsm_measures_hierarchy_dim": ("gl_account_level_", 3),
    "gl_account_hierarchy": ("gl_account_level_", 30),
    "management_gl_account_hierarchy": ("gl_account_level_", 30),
    "consolidation_functional_area_hierarchy": ("consolidation_functional_area_", 7),
    "consolidation_segment_hierarchy_dim": ("consolidation_segment_", 10),
    "segment_cost_center_hierarchy_dim_v": ("cost_center_level_", 30),
    "segment_profit_center_hierarchy": ("profit_center_level_", 9),
    "DisChannel_cost_center_hierarchy_dim_v": ("cost_center_level_", 30),
    "DisChannel_profit_center_hierarchy": ("profit_center_level_", 9),
    "PartDisChannel_profit_center_hierarchy": ("profit_center_level_", 9),
}


def _weights_fit() -> str:
    """Chi-square of value counts against declared shares; critical values at 0.1 %."""
    currency = dict(zip(pools.CURRENCIES, pools.CURRENCY_WEIGHTS))
    negative = pools.NEGATIVE_SHARE
    period = dict(enumerate(pools.PERIOD_WEIGHTS, start=1))
    listed = {
        "currency": ("transaction_currency_cd", currency),
        "sign": ("transaction_currency_amt < 0", {"true": negative, "false": 1 - negative}),
        "period": ("fiscal_year_period_nbr % 100", period),
        "currency, all alike": ("transaction_currency_cd", dict.fromkeys(currency, 1)),
        "currency, one missing": (
            "transaction_currency_cd", {c: w for c, w in currency.items() if c != "USD"}
        ),
    }
    parts = []
    for name, (column, weights) in listed.items():
        shares = ", ".join(f"('{v}', {w / sum(weights.values())!r})" for v, w in weights.items())
        degrees = len(weights) - 1
        # The tabled quantiles.
        limit = {1: 10.828, 12: 32.909, 13: 34.528, 14: 36.123}[degrees]
        parts.append(f"""
SELECT '{name}' AS declaration, row_cnt, row_cnt - m AS undeclared_cnt,
       x::DECIMAL(18,6) AS chi_square, {degrees} AS degrees, row_cnt = m AND x <= {limit!r} AS fits
FROM (SELECT sum(o)::BIGINT AS m, sum((o - all_o * s) ** 2 / (all_o * s)) AS x
      FROM (SELECT s, count(r.v) AS o, sum(count(r.v)) OVER () AS all_o
            FROM (VALUES {shares}) AS d(v, s)
            LEFT JOIN (SELECT ({column})::VARCHAR AS v FROM l) AS r ON r.v = d.v GROUP BY d.v, s)),
     (SELECT count(*) AS row_cnt FROM l)""")
    return f"WITH l AS MATERIALIZED ({LEDGER_WEIGHTED}) " + " UNION ALL ".join(parts)


def _amounts_fit() -> str:
    """The largest gap between counted and declared shares below each edge, class by class."""
    rows = []
    for c in pools.ACCOUNT_CLASSES:
        a = pools.AMOUNTS[c.amounts]
        variance = math.log(1 + (a.std_dev / a.mean) ** 2)
        mu = math.log(a.mean) - variance / 2
        rows.append(f"('{c.label}', {mu!r}, {math.sqrt(variance)!r}, {a.low}::DOUBLE, {a.high}::DOUBLE)")
    cells = [(k, (1 + math.erf(k / 32 / math.sqrt(2))) / 2) for k in range(-192, 193)]
    edges = ", ".join(f"({k}, {share!r}::DOUBLE)" for k, share in cells)
    limit = math.sqrt(math.log(2000) / 2)
    return f"""WITH l AS MATERIALIZED (
    SELECT gl_account_nbr, transaction_currency_amt FROM ({LEDGER})
), p AS (
    SELECT account_class, mu + shift AS mu, sigma, low, high, shift
    FROM (VALUES {", ".join(rows)}) AS t(account_class, mu, sigma, low, high),
         (VALUES (0.0::DOUBLE), (0.5::DOUBLE)) AS s(shift)
), z AS MATERIALIZED (
    SELECT p.*, (ln(abs(amt)::DOUBLE) - mu) / sigma AS score, abs(amt) BETWEEN low AND high AS inside
    FROM (SELECT {CLASS_OF_NUMBER} AS account_class, transaction_currency_amt AS amt FROM l)
    JOIN p USING (account_class)
), g AS (
    SELECT account_class, shift, mu, sigma, low, high, count(*) AS row_cnt,
           count(*) FILTER (inside) AS inside_cnt FROM z GROUP BY ALL
), d AS (
    SELECT g.account_class, g.shift, k,
           abs(count(*) FILTER (z.inside AND z.score * 32 < k) / any_value(inside_cnt) - any_value(share)) AS gap
    FROM g JOIN (VALUES {edges}) AS e(k, share)
      ON k / 32 > (ln(g.low) - g.mu) / g.sigma AND k / 32 < (ln(g.high) - g.mu) / g.sigma
    JOIN z ON z.account_class = g.account_class AND z.shift = g.shift
    GROUP BY ALL
), m AS (SELECT account_class, shift, max(gap) AS gap FROM d GROUP BY ALL)
SELECT account_class, shift, row_cnt, row_cnt - inside_cnt AS outside_cnt,
       gap::DECIMAL(18,9) AS distance,
       row_cnt = inside_cnt AND gap * sqrt(inside_cnt) <= {limit!r} AS fits
FROM g JOIN m USING (account_class, shift)"""


def _nesting() -> str:
    """The nodes of each level, none of which may have two parents."""
    made = dimensions()
    parts = []
    for table, (stem, levels) in _LEVELS.items():
        columns = ", ".join(f"count(DISTINCT {stem}{k}_cd)" for k in range(2, levels + 1))
        parts.append(
            f"SELECT '{table}' AS table_name, unnest(range(2, {levels + 1}))::INTEGER AS level, "
            f"unnest([{columns}]) AS node_cnt, 0::BIGINT AS split_nodes "
            f"FROM ({made['dim_' + table]})"
        )
    return " UNION ALL ".join(parts)


def _closure() -> str:
    """Nodes of the consolidation hierarchies with all their ancestors, by recursion."""
    made, parts = dimensions(), []
    for table, name in (
        ("consolidation_functional_area_hierarchy", "consolidation_functional_area_hierarchy"),
        ("consolidation_segment_hierarchy_dim", "consolidation_segment_hierarchy"),
    ):
        source = f"FROM ({made['dim_' + table]})"
        parts.append(f"SELECT '{table} parents' AS h, {name}_cd AS c, {name}_parent_cd AS p {source}")
        stem, levels = _LEVELS[table]
        for k in range(1, levels + 1):
            above = f"{stem}{k - 1}_cd" if k > 1 else "NULL"
            parts.append(f"SELECT '{table} levels', {stem}{k}_cd, {above} {source}")
    return f"""
WITH RECURSIVE e AS MATERIALIZED (SELECT DISTINCT h, c, p FROM ({" UNION ALL ".join(parts)})),
up AS (
  SELECT h, c, p, 1 AS d FROM e WHERE p IS NOT NULL
  UNION
  SELECT up.h, up.c, e.p, d + 1 FROM up JOIN e ON e.h = up.h AND e.c = up.p WHERE e.p IS NOT NULL
)
SELECT h AS hierarchy, n AS node, coalesce(max(d), 0)::INTEGER AS depth, count(p) AS ancestor_cnt,
       CASE WHEN max(d) IS NULL THEN 'root' ELSE 'chain' END AS state
FROM (SELECT h, c AS n FROM e UNION SELECT h, p FROM e WHERE p IS NOT NULL)
LEFT JOIN (SELECT h AS h2, c, p, min(d) AS d FROM up GROUP BY ALL) ON h = h2 AND n = c
GROUP BY h, n"""


def _hierarchy_levels() -> str:
    n = "(SELECT count(*) FROM customer)"
    nested = ", ".join(f"'PCL{k}_' || (i % sz[{k}] + 1) AS level_{k}_cd" for k in range(1, 10))
    shrinking = ", ".join(
        f"'CFA{k}_' || (i % ({n} // {k * 5} + 1) + 1) AS area_{k}_cd" for k in range(1, 8)
    )
    return (
        f"WITH RECURSIVE {nested_sizes_cte(n, 9, 5)} SELECT i AS node_id, "
        f"CASE WHEN i > 10 THEN 'FA' || {pad('i % 10 + 1', 4)} END AS parent_cd, "
        f"{nested}, {shrinking} FROM (SELECT c_custkey + 1 AS i FROM customer), z"
    )


def _build_report() -> str:
    rows = {t: str(n) for t, n in pools.DEFAULT_ROWS.items()}
    orders = "(SELECT count(*) FROM orders)"
    rows |= {
        "calendar_fiscal_period_v": f"({LAST_YEAR} - {FIRST_YEAR} + 1) * 13",
        "finance_product_dim_v": PARTS,
        "finance_customer_dim_v": CUSTOMERS,
        "company_code": SUPPLIERS,
        "general_ledger_fact": orders,
        "CIS_fact": "(SELECT count(*) FROM events)",
        "consolidated_balance_sheet_fact": f"greatest(1, floor({orders} * 0.0004e0))",
    }
    return " UNION ALL ".join(
        f"SELECT {q(t)} AS table_name, 'OK' AS status, ({n})::BIGINT AS row_cnt"
        for t, n in rows.items()
    )


ORACLES: dict[str, str] = {
    "orders_by_quarter_region": f"""
SELECT 'FY' || (p // 100) || 'Q' || ({QUARTER}) AS fiscal_year_quarter_cd,
       {cyc(pools.REGIONS, "center")} AS geography_nm, count(*) AS row_cnt,
       sum(amt)::DECIMAL(38,5) AS amt
FROM (SELECT {PERIOD_OF_ORDER} AS p, {key("profit_center", 2000, "o_orderkey")} AS center,
             {dec(f'{sign("sign", "o_orderkey")} * '
                  f'{units(log_normal(500000, 1000000, normal("amount", "o_orderkey")))}')} AS amt
      FROM orders)
GROUP BY ALL""",
    "orders_fiscal_attribution": f"""
SELECT o_orderkey, p AS fiscal_year_period_nbr,
       'FY' || (p // 100) || 'P' || lpad((p % 100)::VARCHAR, 2, '0') AS fiscal_year_period_cd,
       'FY' || (p // 100) || 'Q' || ({QUARTER}) AS fiscal_year_quarter_cd,
       CASE WHEN p % 100 <= 6 THEN 'SS' ELSE 'FW' END || (p // 100) AS season_alternate_period_cd
FROM (SELECT o_orderkey, {PERIOD_OF_ORDER} AS p FROM orders)""",
    "cyclic_picks": f"""
SELECT id AS event_id, {cyc(pools.REGIONS, "id")} AS region,
       {cyc(pools.COUNTRIES, "id")} AS country,
       {cyc(pools.SILHOUETTES, "(id + 12)")} AS silhouette
FROM {EVENTS}""",
    "weighted_picks": f"""
SELECT id AS event_id,
       {weighted("currency", pools.CURRENCIES, pools.CURRENCY_WEIGHTS)} AS currency,
       {weighted("brand", pools.BRANDS, pools.BRAND_WEIGHTS)} AS brand,
       {weighted("gender", pools.GENDERS, pools.GENDER_WEIGHTS)} AS gender,
       {nth(pools.PLATFORMS, f"floor({u('platform')} * 10)")} AS platform
FROM {EVENTS}""",
    "threshold_picks": f"""
SELECT id AS event_id,
       {nth([c.name for c in pools.ACCOUNT_CLASSES], account_class("id"))} AS category,
       {account_nbr("id", account_class("id"))}::VARCHAR AS account_nbr
FROM {EVENTS}""",
    "keyed_flags": f"""
SELECT id AS event_id, {every(20, "'N'", "'Y'")} AS active_ind,
       {every(5, "1", "0")}::INTEGER AS etm_ind, {every(3, "'X'", "''")} AS revenue_ind,
       {STATUS} AS status_cd,
       CASE id % 9 WHEN 4 THEN '44' || {pad("id", 5)} WHEN 5 THEN '45' || {pad("id", 5)}
            ELSE {nth(["7", "1", "2", "3", "", "", "5", "6", "8"], "id % 9")} || {pad("id", 6)}
       END AS account_nbr
FROM {EVENTS}""",
    "formatted_codes": f"""
SELECT id AS event_id, {pad("id", 7)} AS profit_center_nbr,
       'CC' || {pad("id", 6)} AS cost_center_nbr, 'CUST' || {pad("id", 8)} AS customer_nbr,
       'FA' || {pad("id % 150 + 1", 4)} AS functional_area_cd,
       'FSI' || {pad("id % 500 + 1", 5)} AS item_cd,
       'STY' || (id % 900000 + 100000) AS style_nbr, {pad("id", 2)} AS short_nbr
FROM {EVENTS}""",
    "uniform_decimals": f"""
SELECT id AS event_id, {dec(units(between("qty", 0, 50000)))} AS qty,
       {dec(units(between("price", 1, 100000)))} AS price FROM {EVENTS}""",
    "lognormal_amounts": f"""
SELECT id AS event_id,
       {dec(units(log_normal(500000, 1000000, normal("revenue"))))} AS revenue_amt,
       {dec(units(log_normal(250000, 500000, normal("cogs"))))} AS cogs_amt,
       {dec(units(log_normal(100000, 200000, normal("opex"))))} AS opex_amt FROM {EVENTS}""",
    "signed_amounts": f"""
SELECT event_id, {dec("s * base")} AS amt, {dec(f"s * {scaled('base', 'f')}")} AS company_amt,
       {dec(f"s * {scaled('base', '0.92e0')}")} AS group_amt, {dec("sales")} AS sales_qty,
       {dec(scaled("sales", "r"))} AS returns_qty
FROM (SELECT id AS event_id, {sign("sign")} AS s,
             {units(between("base", 1000, 5000000))} AS base,
             {between("company", 0.85, 1.15)} AS f,
             {units(between("sales", 1, 100000))} AS sales,
             {u("returns")} * 0.08e0 AS r FROM {EVENTS})""",
    "random_dates": f"""
SELECT id AS event_id, DATE '2019-06-01' + floor({u("posted")} *
       (DATE '2026-06-01' - DATE '2019-06-01'))::INTEGER AS posted_dt FROM {EVENTS}""",
    "audit_columns": f"""
SELECT id AS event_id, c AS created_dt,
       CASE WHEN {u("audit/is_updated")} < 0.3e0
            THEN c + floor({u("audit/updated")} * (DATE '2024-12-31' - c))::INTEGER
            ELSE c END AS updated_dt,
       {cyc(pools.AUDIT_USERS, "id")} AS created_by_user_id,
       {weighted("source", pools.AUDIT_SOURCES, pools.AUDIT_SOURCE_WEIGHTS)} AS physical_source_cd
FROM (SELECT id, DATE '2018-01-01' + floor({u("audit/created")} * 2556)::INTEGER AS c
      FROM {EVENTS})""",
    "hierarchy_levels": _hierarchy_levels(),
    "derived_columns": f"""
SELECT id AS event_id, p AS platform, p || ' - Sub' AS sub_focus, left(p, 2) AS platform_cd,
       DATE '2015-01-01' AS begin_effective_dt, {LOADED} AS load_dt,
       NULL::VARCHAR AS cost_component_calc, NULL::INTEGER AS store_score,
       '1000' AS controlling_area_cd, 'Hierarchy ' || id AS hierarchy_nm
FROM (SELECT id, {cyc(pools.PLATFORMS, "id")} AS p FROM {EVENTS})""",
    **dimensions(),
    "dim_atscale_geo_security": from_ledger(f"""
SELECT region, 'ROLE_' || replace(upper(region), ' ', '_') AS role,
       count(amt) AS ledger_rows, coalesce(sum(amt), 0)::DECIMAL(38,5) AS transaction_currency_amt
FROM (SELECT unnest([{", ".join(q(r) for r in pools.SECURITY_REGIONS)}]) AS region) r
LEFT JOIN (SELECT {CENTER_REGION} AS g, transaction_currency_amt AS amt FROM l) v ON g = region
GROUP BY region"""),
    "dim_finance_foreign_currency_exchange_rate": from_ledger(f"""
, c AS (SELECT * FROM (VALUES {_RATES}) v(cd, per_usd)),
r AS (
  SELECT row_number() OVER (ORDER BY list_position([{", ".join(q(c) for c in pools.CURRENCIES)}], f.cd),
                            list_position(['M', 'P', 'B'], t.cd),
                            list_position(['USD', 'EUR'], e.cd)) AS id,
         f.cd AS f, t.cd AS t, t.nm AS nm, e.cd AS e,
         CASE WHEN f.cd = e.cd THEN 1e0 ELSE round(e.per_usd / f.per_usd, 8) END AS rate
  FROM c f, (VALUES ('M', 'Average Rate'), ('P', 'Month-End Rate'), ('B', 'Budget Rate')) t(cd, nm),
       c e WHERE e.cd IN ('USD', 'EUR')
)
SELECT id AS finance_foreign_currency_exchange_rate_id, f AS from_currency_cd,
       t AS exchange_rate_cd, nm AS exchange_rate_nm,
       rate::DECIMAL(28,8)::DECIMAL(38,18) AS exchange_rate, f AS from_currency_nm,
       e AS to_currency_cd, e AS to_currency_nm, 'Y' AS active_ind,
       (SELECT count(*) FROM l WHERE etm_foreign_currency_exchange_rate_id = id) AS ledger_rows
FROM r"""),
    "dim_calendar_fiscal_period_v": CALENDAR,
    "ledger_from_orders": LEDGER,
    "income_statement": INCOME_STATEMENT,
    "income_statement_signed": INCOME_STATEMENT_SIGNED,
    "balance_sheet": BALANCE_SHEET,
    "fk_dense": f"""
SELECT o_orderkey, {key("product_id", PARTS, "o_orderkey")} AS product_id,
       {key("customer_id", CUSTOMERS, "o_orderkey")} AS customer_id,
       (o_orderkey % {PARTS} + 1)::BIGINT AS cyclic_product_id FROM orders""",
    "fk_derived": f"""
SELECT o_orderkey, {account_nbr("a", account_class("a"))}::VARCHAR AS gl_account_nbr,
       'CC' || {pad("c", 6)} AS cost_center_nbr, {document_cd("d")} AS document_type_cd,
       (1000 + m)::VARCHAR AS company_cd, {company_currency("m")} AS company_currency_cd,
       {version_nbr("v")} AS version_nbr, {version_group("v")} AS version_group_nm,
       {cyc(pools.CURRENCIES[:8], "c")} AS center_currency_cd
FROM (SELECT o_orderkey, {key("account", 8000, "o_orderkey")} AS a,
             {key("center", 15000, "o_orderkey")} AS c, {key("document", 40, "o_orderkey")} AS d,
             {key("company", 80, "o_orderkey")} AS m, {key("version", 25, "o_orderkey")} AS v
      FROM orders)""",
    "fk_ordinal_join": f"""
WITH p AS (SELECT p_partkey, row_number() OVER (ORDER BY md5(p_partkey::VARCHAR)) AS k
           FROM part WHERE p_size < 40)
SELECT o_orderkey, p_partkey AS part_key
FROM (SELECT o_orderkey, {key("part", "(SELECT count(*) FROM p)", "o_orderkey")} AS k FROM orders)
LEFT JOIN p USING (k)""",
    "fk_literal_table": f"""
SELECT id AS event_id, {cyc(pools.SECURITY_REGIONS, "id")} AS region FROM {EVENTS}""",
    "distinct_parts": "SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL",
    "fiscal_years_shipped": f"""
SELECT DISTINCT {fiscal_year("l_shipdate")}::INTEGER AS fiscal_year FROM lineitem""",
    "agg_ledger": from_ledger(AGGREGATE),
    "agg_ledger_described": from_ledger(DESCRIBED),
    "agg_ledger_quarter_region": from_ledger(f"""
SELECT 'FY' || (fiscal_year_period_nbr // 100) || 'Q' || ({QUARTER_OF_PERIOD})
         AS fiscal_year_quarter_cd,
       {CENTER_REGION} AS geography_nm, {CLASS_OF_NUMBER} AS account_class, {SUMS}
FROM l GROUP BY ALL"""),
    "agg_bucketed": from_ledger(AGGREGATE),
    "agg_refresh": from_ledger(AGGREGATE),
    "measures_from_aggregate": from_ledger(f"""
SELECT (fiscal_year_period_nbr // 100 * 10 + ({QUARTER_OF_PERIOD}))::INTEGER AS fiscal_quarter,
       {CLASS_OF_NUMBER} AS account_class,
       sum(transaction_currency_amt)::DECIMAL(38,5) AS transaction_currency_amt,
       sum(sales_qty)::DECIMAL(38,5) AS sales_qty, count(*) AS row_cnt,
       (sum(returns_qty)::DOUBLE / sum(sales_qty)::DOUBLE)::DECIMAL(9,6) AS return_rate
FROM l WHERE company_id <= 5 AND {CLASS_OF_NUMBER} <> 'Tax' GROUP BY ALL"""),
    "measures_by_quarter": from_ledger(f"""
SELECT (fiscal_year_period_nbr // 100 * 10 + ({QUARTER_OF_PERIOD}))::INTEGER AS fiscal_quarter,
       {CLASS_OF_NUMBER} AS account_class,
       sum(transaction_currency_amt)::DECIMAL(38,5) AS transaction_currency_amt,
       sum(sales_qty)::DECIMAL(38,5) AS sales_qty, count(*) AS row_cnt,
       (count(*) FILTER (transaction_currency_amt < 0) / count(*))::DECIMAL(9,6) AS negative_share
FROM l WHERE general_ledger_fact_id % 10 <> 0 GROUP BY ALL"""),
    "measures_sql_view": from_ledger("""
SELECT company_cd, (fiscal_year_period_nbr // 100)::INTEGER AS fiscal_year,
       sum(company_currency_amt)::DECIMAL(38,5) AS company_currency_amt,
       (sum(returns_qty)::DOUBLE / sum(sales_qty)::DOUBLE)::DECIMAL(9,6) AS return_rate
FROM l GROUP BY ALL HAVING sum(company_currency_amt) > 0"""),
    "agg_reconcile": from_ledger(f"""
SELECT count(*) AS left_rows, count(*) AS right_rows, 0::BIGINT AS only_left,
       0::BIGINT AS only_right FROM ({AGGREGATE})"""),
    "fx_convert_ledger": from_ledger(f"""
SELECT cd AS from_currency_cd, (fiscal_year_period_nbr // 100)::INTEGER AS fiscal_year,
       count(*) AS row_cnt, sum(transaction_currency_amt)::DECIMAL(38,5) AS amt,
       (sum(transaction_currency_amt)::DECIMAL(27,5) * {USD_RATE})::DECIMAL(32,4) AS usd_amt
FROM l JOIN (VALUES {_RATES}) v(cd, per_usd) ON transaction_currency_cd = cd
GROUP BY cd, per_usd, fiscal_year"""),
    "events_with_segment": """
SELECT event_id, user_id, event_type, c_mktsegment FROM events LEFT JOIN customer
ON user_id = c_custkey""",
    "events_with_segment_bucketed": """
SELECT event_id, user_id, event_type, c_mktsegment FROM events LEFT JOIN customer
ON user_id = c_custkey""",
    "row_counts": _row_counts(),
    "fk_orphans_all": _orphans(
        [(r.name, r.child, r.column, r.parent, r.key) for r in DRIVER_RELATIONS]
    ),
    "fk_orphans_ledger": _ledger_orphans(),
    "fk_orphans_filtered_part": """
SELECT l_partkey, count(*) AS child_rows FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40) GROUP BY l_partkey""",
    "fk_orphans_bucketed": """
SELECT l_partkey, count(*) AS child_rows FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40) GROUP BY l_partkey""",
    "pk_duplicates_lineitem": """
SELECT l_orderkey, l_linenumber, count(*) AS row_cnt FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
    "pk_uniqueness_all": _uniqueness({t: (t, ",".join(k)) for t, k in DRIVER_KEYS.items()}),
    "pk_income_statement": f"WITH s AS ({INCOME_STATEMENT}) "
    + _uniqueness(
        {
            "declared": ("s", "gl_account_id"),
            "row": ("s", "consolidated_income_statement_fact_id"),
        }
    ),
    "pk_density": _density(),
    "not_null_profile": _null_profile(),
    "schema_conformance": _conformance(),
    "schema_projection": f"""
SELECT c_custkey AS company_id, c_nationkey::VARCHAR AS company_cd, c_name AS company_nm,
       {company_currency("(c_custkey + 1)")} AS currency_cd, 'ETL_SERVICE' AS created_by_user_id,
       'ETL_SERVICE' AS updated_by_user_id, NULL::VARCHAR AS physical_source_cd FROM customer""",
    "amount_distribution": from_ledger("""
SELECT count(*) AS row_cnt, count(*) FILTER (transaction_currency_amt < 0) AS negative_cnt,
       (count(*) FILTER (transaction_currency_amt < 0) / count(*))::DECIMAL(9,6) AS negative_share,
       sum(abs(transaction_currency_amt))::DECIMAL(38,5) AS abs_total,
       min(abs(transaction_currency_amt)) AS abs_min, max(abs(transaction_currency_amt)) AS abs_max,
       skewness(abs(transaction_currency_amt)::DOUBLE) > 0 AS is_right_skewed FROM l"""),
    "declared_weights_fit": _weights_fit(),
    "declared_amounts_fit": _amounts_fit(),
    "calendar_check": f"""
SELECT y::INTEGER AS fiscal_year_nbr, 13::BIGINT AS period_cnt, make_date(y, 6, 1) AS first_day,
       make_date(y + 1, 6, 30) AS last_day, 13::BIGINT AS month_cnt, true AS is_valid
FROM (SELECT unnest(range({FIRST_YEAR}, {LAST_YEAR} + 1)) AS y)""",
    "hierarchy_nesting_check": _nesting(),
    "hierarchy_closure": _closure(),
    "ledger_rules": _rules(),
    "partitioned_write": from_ledger("""
SELECT fiscal_year_period_nbr, count(*) AS row_cnt,
       sum(transaction_currency_amt)::DECIMAL(38,5) AS amt, min(gl_account_nbr) AS first_account
FROM l GROUP BY ALL"""),
    "replace_period": from_ledger("""
SELECT fiscal_year_period_nbr, count(*) AS row_cnt,
       (sum(transaction_currency_amt) * CASE WHEN fiscal_year_period_nbr // 100 = y THEN 2 ELSE 1 END)
         ::DECIMAL(38,5) AS amt,
       fiscal_year_period_nbr // 100 <> y AS files_kept
FROM l, (SELECT max(fiscal_year_period_nbr // 100) AS y FROM l) GROUP BY fiscal_year_period_nbr, y"""),
    "recluster_appended": from_ledger("""
SELECT fiscal_year_period_nbr, count(*) AS row_cnt,
       sum(transaction_currency_amt)::DECIMAL(38,5) AS amt,
       false AS overlapping, true AS as_needed, true AS late_only
FROM l GROUP BY fiscal_year_period_nbr"""),
    "sized_append_write": """
SELECT event_type, 2 * count(*) AS row_cnt, count(DISTINCT event_id) AS event_cnt
FROM events GROUP BY event_type""",
    "files_by_bytes": " UNION ALL ".join(
        f"SELECT '{layout}' AS layout, count(*) AS row_cnt, true AS most_near FROM lineitem"
        for layout in ("narrow", "wide")
    ),
    "build_report": _build_report(),
    "build_resumed": _build_report().replace("'OK'", "'KEPT'"),
    "build_then_check": _built(),
    "clustered_write_stats": " UNION ALL ".join(
        f"SELECT '{layout}' AS layout, count(*) AS row_cnt, sum(l_partkey)::BIGINT AS sum_l_partkey, "
        f"sum(l_suppkey)::BIGINT AS sum_l_suppkey, {narrow} AS narrow_l_partkey, "
        f"{narrow} AS narrow_l_suppkey FROM lineitem"
        for layout, narrow in (("written", "false"), ("clustered", "true"))
    ),
    "ledger_cyclic": LEDGER_CYCLIC,
    "income_statement_cyclic": INCOME_STATEMENT_CYCLIC,
    "dim_gl_account_dim_cyclic": dim("gl_account_dim", CYCLIC_ACCOUNTS),
    "dim_finance_customer_dim_v_cyclic": CYCLIC_CUSTOMERS,
    "ledger_weighted_periods": f"""
SELECT fiscal_year_period_nbr, count(*) AS row_cnt,
       sum(transaction_currency_amt)::DECIMAL(38,5) AS amt
FROM ({LEDGER_WEIGHTED}) GROUP BY fiscal_year_period_nbr""",
}

"""Generators of the ledger, the income statement and the balance sheet.

Foreign keys are arithmetic on the row id (see ``operators.fk``), so a fact plans as a range
and projections: no join, no shuffle and no key ever leaves the executors.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import keys, pools
from ledgerweave.functions.exprs import code, cyclic_number, cyclic_pick, every, zero_pad
from ledgerweave.functions.pools import AmountParams
from ledgerweave.functions.rng import (
    RowRandom,
    expand_weights,
    from_units,
    log_normal_params_of,
    to_units,
)
from ledgerweave.operators.fk import dense_key
from ledgerweave.sources.dims import AUDIT, LOADER
from ledgerweave.sources.schema import project
from ledgerweave.sources.spec import ID, Spec

PeriodDeal = Literal["even", "weighted"]


@dataclass(frozen=True)
class Parents:
    """How many rows each parent of a fact has; parent ids run from 1."""

    accounting_document_types: int = pools.DEFAULT_ROWS["accounting_document_type"]
    first_fiscal_year: int = pools.DEFAULT_FISCAL_YEARS[0]
    last_fiscal_year: int = pools.DEFAULT_FISCAL_YEARS[1]
    profit_centers: int = pools.DEFAULT_ROWS["profit_center"]
    divisions: int = pools.DEFAULT_ROWS["division_text"]
    versions: int = pools.DEFAULT_ROWS["version_forecast_mapping"]
    functional_areas: int = pools.DEFAULT_ROWS["functional_area"]
    products: int = pools.DEFAULT_ROWS["finance_product_dim_v"]
    customers: int = pools.DEFAULT_ROWS["finance_customer_dim_v"]
    companies: int = pools.DEFAULT_ROWS["company_code"]
    attributions: int = pools.DEFAULT_ROWS["copa_attribution_dim"]
    cost_centers: int = pools.DEFAULT_ROWS["cost_center_dim_v"]
    wholesale_units: int = pools.DEFAULT_ROWS["geo_wholesale_value_business_dim"]
    marketplace_channels: int = pools.DEFAULT_ROWS["geo_marketplace_channel_dim"]
    accounts: int = pools.DEFAULT_ROWS["gl_account_dim"]
    measures: int = pools.DEFAULT_ROWS["gl_account_zfsm_measures_hierarchy_dim"]
    exchange_rates: int = pools.DEFAULT_ROWS["finance_foreign_currency_exchange_rate"]

    @property
    def fiscal_years(self) -> int:
        return self.last_fiscal_year - self.first_fiscal_year + 1


@dataclass(frozen=True)
class Periods:
    """How a fact's rows are dealt to fiscal periods.

    ``even`` draws any period and ``weighted`` draws by the period weights.
    """

    deal: PeriodDeal = "even"

    def __post_init__(self) -> None:
        if self.deal not in ("even", "weighted"):
            raise ValueError(f"unknown way to deal periods: {self.deal!r}")

    def number(self, random: RowRandom, parents: Parents, cyclic: bool) -> Column:
        per_year = pools.PERIODS_PER_YEAR
        total = per_year * parents.fiscal_years
        first = F.lit(parents.first_fiscal_year)
        if self.deal == "weighted":
            year = random.index("fiscal_year", parents.fiscal_years)
            period = random.weighted(
                "fiscal_period", range(1, per_year + 1), pools.PERIOD_WEIGHTS
            )
            return ((first + year) * 100 + period).cast("int")
        if cyclic:
            position = F.pmod(random.row, F.lit(total))
        else:
            position = random.index("fiscal_year_period", total)
        year = first + F.floor(position / per_year)
        return (year * 100 + F.pmod(position, F.lit(per_year)) + 1).cast("int")


def _amount_params() -> list[tuple[float, float, float, float]]:
    """mu, sigma, low and high per account class."""
    by_class = [pools.AMOUNTS[c.amounts] for c in pools.ACCOUNT_CLASSES]
    return [(*log_normal_params_of(p), float(p.low), float(p.high)) for p in by_class]


def amount_by_class(normal: Column, class_index: Column) -> Column:
    """Log-normal amount with the parameters and bounds of the account's class, in units."""
    mu, sigma, low, high = (
        keys.of_class(class_index, column) for column in zip(*_amount_params())
    )
    return to_units(F.least(F.greatest(F.exp(mu + sigma * normal), low), high))


def amount(normal: Column, params: AmountParams) -> Column:
    """Log-normal amount inside the bounds of ``params``, in units."""
    mu, sigma = log_normal_params_of(params)
    value = F.exp(F.lit(mu) + F.lit(sigma) * normal)
    bounded = F.least(F.greatest(value, F.lit(float(params.low))), F.lit(float(params.high)))
    return to_units(bounded)


def _scaled(units: Column, factor: Column | float) -> Column:
    """Units times a factor, half up, still a whole number of units."""
    return F.floor(units * factor + F.lit(0.5))


def general_ledger_fact(
    ids: DataFrame, spec: Spec, parents: Parents = Parents(), periods: Periods = Periods()
) -> DataFrame:
    table, i = "general_ledger_fact", F.col(ID)
    random = spec.random(table)

    def key(salt: str, n: int) -> Column:
        return dense_key(random, salt, n, spec.cyclic)

    keyed = ids.select(
        ID,
        periods.number(random, parents, spec.cyclic).alias("period"),
        key("accounting_document_type_id", parents.accounting_document_types).alias("doc_type"),
        key("profit_center_id", parents.profit_centers).alias("profit_center"),
        key("version_forecast_mapping_id", parents.versions).alias("version"),
        key("functional_area_id", parents.functional_areas).alias("area"),
        key("company_id", parents.companies).alias("company"),
        key("gl_account_nbr", parents.accounts).alias("account"),
        random.standard_normal("amount").alias("normal"),
        random.sign("sign", pools.NEGATIVE_SHARE).alias("sign"),
        to_units(random.between("sales_qty", *pools.SALES_QTY_RANGE)).alias("sales"),
    ).withColumn("class_index", keys.account_class_index(F.col("account")))
    valued = keyed.withColumn(
        "base", amount_by_class(F.col("normal"), F.col("class_index"))
    )

    account, class_index = F.col("account"), F.col("class_index")
    base, sign, sales = F.col("base"), F.col("sign"), F.col("sales")
    account_nbr = (
        keys.gl_account_nbr(account, spec.style)
        if spec.cyclic
        else keys.account_number(account, class_index).cast("string")
    )
    currency = (
        cyclic_pick(expand_weights(pools.CURRENCIES, pools.CURRENCY_WEIGHTS), i)
        if spec.cyclic
        else random.weighted("transaction_currency", pools.CURRENCIES, pools.CURRENCY_WEIGHTS)
    )
    returned = _scaled(sales, random.uniform("returns") * F.lit(pools.RETURNS_RATIO))
    return project(
        valued,
        table,
        {
            "general_ledger_fact_id": i,
            "fiscal_year_period_nbr": F.col("period"),
            "profit_center_id": F.col("profit_center"),
            "division_id": key("division_id", parents.divisions),
            "version_forecast_mapping_id": F.col("version"),
            "functional_area_id": F.col("area"),
            "accounting_document_type_id": F.col("doc_type"),
            "product_id": key("product_id", parents.products),
            "customer_id": key("customer_id", parents.customers),
            "company_id": F.col("company"),
            "copa_attribution_id": key("copa_attribution_id", parents.attributions),
            "cost_center_nbr": keys.cost_center_nbr(key("cost_center_nbr", parents.cost_centers)),
            "geo_wholesale_value_business_id": key(
                "geo_wholesale_value_business_id", parents.wholesale_units
            ),
            "geo_marketplace_channel_id": key(
                "geo_marketplace_channel_id", parents.marketplace_channels
            ),
            "gl_account_nbr": account_nbr,
            "zfsm_measure_id": key("zfsm_measure_id", parents.measures),
            "company_currency_amt": from_units(
                sign * _scaled(base, random.between("company_factor", 0.85, 1.15))
            ),
            "transaction_currency_amt": from_units(sign * base),
            "performance_management_currency_amt": from_units(
                sign * _scaled(base, random.between("performance_factor", 0.88, 1.12))
            ),
            "etm_ind": every(i, 5, 1, 0),
            "etm_foreign_currency_exchange_rate_id": key("etm_rate", parents.exchange_rates),
            "gaap_foreign_currency_exchange_rate_id": key("gaap_rate", parents.exchange_rates),
            "sales_qty": from_units(sales),
            "returns_qty": from_units(returned),
            "general_ledger_fact_ind": every(i, 10, "N", "Y"),
            "cis_delta_ind": every(i, 20, "Y", "N"),
            "general_ledger_ocogs_allocation_fact_ind": every(i, 15, "Y", "N"),
            "anaplan_corporate_ind": every(i, 25, "Y", "N"),
            "company_currency_cd": keys.company_currency(F.col("company")),
            "transaction_currency_cd": currency,
            "Functional_Area_cd": keys.functional_area_cd(F.col("area")),
            "accounting_document_type_cd": keys.document_type_cd(F.col("doc_type")),
            "profit_center_nbr": keys.profit_center_nbr(F.col("profit_center")),
            "company_cd": keys.company_cd(F.col("company")),
        },
        nulls=("__cost_center_nbr_fk_id", "__gl_account_nbr_fk_id"),
    )


def _statement_columns(parents: Parents) -> dict[str, object]:
    """The columns the two statements share: codes by position, and the audit columns."""
    i = F.col(ID)
    version = cyclic_number(i, len(pools.VERSIONS), 1)
    return {
        "fiscal_year_period_nbr": F.col("period"),
        "fiscal_yr": F.floor(F.col("period") / 100),
        "functional_area_cd": keys.functional_area_cd(
            cyclic_number(i, parents.functional_areas, 1)
        ),
        "division_nbr": keys.division_nbr(cyclic_number(i, parents.divisions, 1)),
        "partner_segment_nbr": cyclic_number(i, 50, 1),
        "financial_statement_item_cd": keys.statement_item_cd(cyclic_number(i, 500, 1)),
        "local_currency_cd": cyclic_pick(pools.STATEMENT_CURRENCIES, i),
        "version_nbr": keys.version_nbr(version),
        "version_group_nm": keys.version_group(version),
        "partner_profit_center_nbr": keys.profit_center_nbr(
            cyclic_number(i, parents.profit_centers, 1)
        ),
        "partner_unit_cd": code("PU", cyclic_number(i, 50, 1), 3),
        "consolidation_unit_cd": cyclic_number(i, parents.companies, 1001),
        "trading_partner_nbr": cyclic_number(i, 200, 1),
        "region_summary_product_group_cd": cyclic_pick([c for c, _ in pools.PRODUCT_GROUPS], i),
        "consolidated_segment_nm": cyclic_pick(pools.PROFIT_CENTER_SEGMENTS, i),
        "consolidated_channel_nm": cyclic_pick(pools.CONSOLIDATED_CHANNELS, i),
        "posting_level_cd": cyclic_pick(pools.POSTING_LEVELS, i),
        "foreign_exchange_type_cd": cyclic_pick(pools.RATE_TYPE_CODES, i),
        "user_nm": LOADER,
        **AUDIT,
    }


def income_statement_fact(
    ids: DataFrame,
    spec: Spec,
    parents: Parents = Parents(),
    periods: Periods = Periods(),
    adjust_by_account: bool = False,
) -> DataFrame:
    """The ``CIS_fact`` table.

    The sign-adjusted columns copy the amounts, or with ``adjust_by_account`` carry them
    negated on accounts whose balance is normally a debit.
    """
    table, i = "CIS_fact", F.col(ID)
    random = spec.random(table)
    keyed = ids.select(
        ID,
        periods.number(random, parents, spec.cyclic).alias("period"),
        dense_key(random, "gl_account_id", parents.accounts, spec.cyclic).alias("account"),
        dense_key(random, "profit_center_id", parents.profit_centers, spec.cyclic).alias(
            "profit_center"
        ),
        random.standard_normal("amount").alias("normal"),
        random.sign("sign", pools.NEGATIVE_SHARE).alias("sign"),
        to_units(random.between("qty", 0, 50_000)).alias("qty"),
    ).withColumn("class_index", keys.account_class_index(F.col("account")))
    valued = keyed.withColumn(
        "base", amount_by_class(F.col("normal"), F.col("class_index"))
    )

    sign, base = F.col("sign"), F.col("base")
    amounts = {
        "transaction_currency_amt": sign * base,
        "group_currency_amt": sign * _scaled(base, F.lit(0.92)),
        "local_currency_amt": sign * _scaled(base, F.lit(0.95)),
        "qty": F.col("qty"),
    }
    direction = keys.of_class(
        F.col("class_index"),
        [-1 if adjust_by_account and c.sign == "debit" else 1 for c in pools.ACCOUNT_CLASSES],
    )
    columns = {name: from_units(units) for name, units in amounts.items()}
    columns |= {
        f"sign_adjusted_{name}": from_units(units * direction if adjust_by_account else units)
        for name, units in amounts.items()
    }
    account_nbr = (
        keys.gl_account_nbr(F.col("account"), spec.style)
        if spec.cyclic
        else keys.account_number(F.col("account"), F.col("class_index"))
    )
    return project(
        valued,
        table,
        {
            "gl_account_id": account_nbr,
            "profit_center_nbr": keys.profit_center_nbr(F.col("profit_center")),
            "profit_center_id": F.col("profit_center"),
            "segment_nbr": cyclic_number(i, 100, 1),
            "document_type_cd": cyclic_pick(pools.STATEMENT_DOCUMENT_TYPES, i),
            "original_company_cd": cyclic_number(i, parents.companies, 1001),
            "consolidated_income_statement_fact_id": i,
            "transaction_currency_cd": cyclic_pick(
                pools.STATEMENT_CURRENCIES, F.col("profit_center")
            ),
            "ledger_cd": cyclic_pick(pools.LEDGERS, i),
            "dimension_cd": code("DIM", cyclic_number(i, 20, 1), 3),
            "record_type_cd": cyclic_pick(pools.RECORD_TYPES, i),
            "consolidation_group_cd": cyclic_pick(pools.CONSOLIDATION_GROUPS, i),
            "consolidation_of_investment_activity_nbr": cyclic_number(i, 5),
            "chart_of_accounts_cd": cyclic_pick(pools.CHARTS_OF_ACCOUNTS, i),
            "base_unit_of_measure_cd": cyclic_pick(pools.BASE_UNITS, i),
            **_statement_columns(parents),
            **columns,
        },
        nulls=("additional_operation_information_nm", "cis_store_cd"),
    )


def balance_sheet_fact(
    ids: DataFrame, spec: Spec, parents: Parents = Parents(), periods: Periods = Periods()
) -> DataFrame:
    """The ``consolidated_balance_sheet_fact`` table."""
    table, i = "consolidated_balance_sheet_fact", F.col(ID)
    random = spec.random(table)
    valued = ids.select(
        ID,
        periods.number(random, parents, spec.cyclic).alias("period"),
        amount(random.standard_normal("amount"), pools.AMOUNTS["revenue"]).alias("base"),
        random.sign("sign", pools.NEGATIVE_SHARE).alias("sign"),
        to_units(random.between("qty", 0, 10_000)).alias("qty"),
    )
    sign, base = F.col("sign"), F.col("base")
    group_amount = from_units(sign * _scaled(base, F.lit(0.92)))
    return project(
        valued,
        table,
        {
            "consolidated_balance_sheet_fact_id": i,
            "profit_center_nbr": keys.profit_center_nbr(
                cyclic_number(i, parents.profit_centers, 1)
            ),
            "transaction_currency_cd": cyclic_pick(pools.STATEMENT_CURRENCIES, i),
            "document_type_cd": cyclic_pick(pools.STATEMENT_DOCUMENT_TYPES[:5], i),
            "transaction_currency_amt": from_units(sign * base),
            "local_currency_amt": from_units(sign * _scaled(base, F.lit(0.95))),
            "group_currency_amt": group_amount,
            "ending_balance_amt": group_amount,
            "segment_nbr": zero_pad(cyclic_number(i, 100, 1), 4),
            "qty": from_units(F.col("qty")),
            "_acdocu_latest_load_timestamp": spec.as_of,
            "group_currency_cd": "USD",
            **_statement_columns(parents),
        },
        nulls=("additional_operation_information_nm",),
    )

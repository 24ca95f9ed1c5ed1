"""Every declared table by name, sized by one set of volumes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions import pools
from ledgerweave.functions.calendar import fiscal_calendar, fiscal_years
from ledgerweave.sources import dims, facts, hierarchies
from ledgerweave.sources.facts import Parents, PeriodDeal, Periods
from ledgerweave.sources.schema import FACTS, LAYOUTS, TABLES, row_key
from ledgerweave.sources.spec import ID, Spec, cores_for, id_range
from ledgerweave.sources.tables import ROWS_PER_FILE, file_count

CALENDAR = "calendar_fiscal_period_v"

DIMENSION_GENERATORS = {
    "accounting_document_type": dims.accounting_document_type,
    "atscale_geo_security": dims.atscale_geo_security,
    "version_forecast_mapping": dims.version_forecast_mapping,
    "functional_area": dims.functional_area,
    "division_text": dims.division_text,
    "division_text_dim_v": dims.division_text_dim_v,
    "finance_foreign_currency_exchange_rate": dims.finance_foreign_currency_exchange_rate,
    "company_code": dims.company_code,
    "finance_product_dim_v": dims.finance_product_dim_v,
    "finance_customer_dim_v": dims.finance_customer_dim_v,
    "copa_attribution_dim": dims.copa_attribution_dim,
    "profit_center": dims.profit_center,
    "gl_account_dim": dims.gl_account_dim,
    "gl_account_zfsm_measures_hierarchy_dim": dims.gl_account_zfsm_measures_hierarchy_dim,
    "geo_marketplace_channel_dim": dims.geo_marketplace_channel_dim,
    "geo_wholesale_value_business_dim": dims.geo_wholesale_value_business_dim,
    "retail_global_store_profile_v": dims.retail_global_store_profile_v,
    "consolidation_functional_area_hierarchy": hierarchies.consolidation_functional_area_hierarchy,
    "consolidation_segment_hierarchy_dim": hierarchies.consolidation_segment_hierarchy_dim,
    "segment_cost_center_hierarchy_dim_v": hierarchies.segment_cost_center_hierarchy_dim_v,
    "DisChannel_cost_center_hierarchy_dim_v": hierarchies.dis_channel_cost_center_hierarchy_dim_v,
    "segment_profit_center_hierarchy": hierarchies.segment_profit_center_hierarchy,
    "DisChannel_profit_center_hierarchy": hierarchies.dis_channel_profit_center_hierarchy,
    "PartDisChannel_profit_center_hierarchy": hierarchies.part_dis_channel_profit_center_hierarchy,
}

#: Tables that list a fixed domain.
FINITE = {
    "atscale_geo_security": len(pools.SECURITY_REGIONS),
    "finance_foreign_currency_exchange_rate": pools.EXCHANGE_RATE_ROWS,
}


@dataclass(frozen=True)
class Volumes:
    """Ledger rows, fiscal years, any row counts that differ from the defaults, and how the
    facts' rows are dealt to periods."""

    ledger_rows: int = 250
    first_fiscal_year: int = pools.DEFAULT_FISCAL_YEARS[0]
    last_fiscal_year: int = pools.DEFAULT_FISCAL_YEARS[1]
    rows: Mapping[str, int] = field(default_factory=dict)
    periods: PeriodDeal = "even"

    def __post_init__(self) -> None:
        for table, most in FINITE.items():
            if self.rows.get(table, 0) > most:
                raise ValueError(f"{table} has {most} rows at most, not {self.rows[table]}")

    def of(self, table: str) -> int:
        """The number of rows of a table."""
        if table not in TABLES:
            raise ValueError(f"unknown table {table!r}; known are {', '.join(TABLES)}")
        if table in self.rows:
            return self.rows[table]
        if table in FACTS:
            return max(1, int(self.ledger_rows * pools.FACT_RATIOS[table]))
        if table == CALENDAR:
            years = self.last_fiscal_year - self.first_fiscal_year + 1
            return years * pools.PERIODS_PER_YEAR
        return pools.DEFAULT_ROWS[table]

    def parents(self) -> Parents:
        """The sizes of a fact's parents."""
        return Parents(
            accounting_document_types=self.of("accounting_document_type"),
            first_fiscal_year=self.first_fiscal_year,
            last_fiscal_year=self.last_fiscal_year,
            profit_centers=self.of("profit_center"),
            divisions=self.of("division_text"),
            versions=self.of("version_forecast_mapping"),
            functional_areas=self.of("functional_area"),
            products=self.of("finance_product_dim_v"),
            customers=self.of("finance_customer_dim_v"),
            companies=self.of("company_code"),
            attributions=self.of("copa_attribution_dim"),
            cost_centers=self.of("cost_center_dim_v"),
            wholesale_units=self.of("geo_wholesale_value_business_dim"),
            marketplace_channels=self.of("geo_marketplace_channel_dim"),
            accounts=self.of("gl_account_dim"),
            measures=self.of("gl_account_zfsm_measures_hierarchy_dim"),
            exchange_rates=self.of("finance_foreign_currency_exchange_rate"),
        )


def generate(
    spark: SparkSession,
    table: str,
    volumes: Volumes,
    spec: Spec,
    ids: DataFrame | None = None,
) -> DataFrame:
    """A declared table, lazily.

    Row ids come from ``ids`` where given, else from a range: from 0 for a fact and from 1
    for a dimension.
    """
    n = volumes.of(table)
    parents, periods = volumes.parents(), Periods(volumes.periods)
    if table == CALENDAR:
        years = fiscal_years(spark, volumes.first_fiscal_year, volumes.last_fiscal_year)
        return fiscal_calendar(years, volumes.first_fiscal_year)
    if ids is None:
        ids = id_range(spark, n, start=0 if table in FACTS else 1)
    if table == "general_ledger_fact":
        return facts.general_ledger_fact(ids, spec, parents, periods)
    if table == "CIS_fact":
        return facts.income_statement_fact(ids, spec, parents, periods)
    if table == "consolidated_balance_sheet_fact":
        return facts.balance_sheet_fact(ids, spec, parents, periods)
    if table == "cost_center_dim_v":
        return dims.cost_center_dim_v(
            ids, n, spec, parents.companies, parents.profit_centers, parents.functional_areas
        )
    if table == "gl_account_hierarchy":
        return hierarchies.gl_account_hierarchy(ids, n, spec, parents.accounts)
    if table == "management_gl_account_hierarchy":
        return hierarchies.management_gl_account_hierarchy(ids, n, spec, parents.accounts)
    return DIMENSION_GENERATORS[table](ids, n, spec)


def generate_clustered(
    spark: SparkSession,
    table: str,
    volumes: Volumes,
    spec: Spec,
    ids: DataFrame | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> DataFrame:
    """A declared table whose partitions are ranges of its layout's columns.

    A row follows from its id, so only the id and the layout's columns are shuffled; the
    other columns are computed after it.  The row id closes the range key, so the rows of
    one hot value are split over several partitions.
    """
    layout = LAYOUTS[table]
    by, key = [*layout.partition_by, *layout.cluster_by], row_key(table)
    n = volumes.of(table)
    partitions = file_count(n, rows_per_file)
    if layout.partition_by:  # many files in any case, so let every core write some
        partitions = max(partitions, cores_for(spark, n))
    rows = generate(spark, table, volumes, spec, ids=ids)
    ranged = rows.select(*by, key).repartitionByRange(partitions, *by, key)
    return generate(spark, table, volumes, spec, ids=ranged.select(F.col(key).alias(ID)))

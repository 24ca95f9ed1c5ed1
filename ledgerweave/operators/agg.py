"""The ledger's aggregate table, measures computed on demand, and their reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerweave.operators.joins import Lookup, lookup, lookups

# The aggregate's grain; the account class stands for the account.
GRAIN = (
    "fiscal_year_period_nbr",
    "company_id",
    "profit_center_id",
    "division_id",
    "version_forecast_mapping_id",
    "account_class",
)
AMOUNTS = (
    "company_currency_amt",
    "transaction_currency_amt",
    "performance_management_currency_amt",
    "sales_qty",
    "returns_qty",
)
SUM_TYPE = "decimal(38,5)"
LEDGER_KEY = "general_ledger_fact_id"


def account_class(accounts: DataFrame) -> DataFrame:
    """The account dimension's key and the class its description starts with."""
    label = F.substring_index("gl_account_short_desc", " Acct ", 1)
    return accounts.select("gl_account_nbr", label.alias("account_class"))


def with_account_class(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """The ledger with the class of each row's account."""
    return lookup(
        ledger,
        account_class(accounts),
        ("gl_account_nbr", "gl_account_nbr"),
        ["account_class"],
        LEDGER_KEY,
    )


def measure_sums(rows: str = "row_cnt", count: Column | None = None) -> list[Column]:
    """Additive measures: the sums of the amounts and quantities, and the row count."""
    sums = [F.sum(a).cast(SUM_TYPE).alias(a) for a in AMOUNTS]
    return [*sums, (F.count("*") if count is None else F.sum(count)).cast("bigint").alias(rows)]


def ledger_aggregate(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """Ledger rows summed to the grain: one broadcast join and one shuffle of partial sums."""
    used = ledger.select(LEDGER_KEY, "gl_account_nbr", *GRAIN[:-1], *AMOUNTS)
    return sum_to_grain(with_account_class(used, accounts))


def sum_to_grain(rows: DataFrame) -> DataFrame:
    """Ledger rows that know their account's class, summed to the grain."""
    return rows.groupBy(*GRAIN).agg(*measure_sums())


def roll_up(aggregate: DataFrame, by: Sequence[str]) -> DataFrame:
    """The aggregate summed further, to fewer columns."""
    return aggregate.groupBy(*by).agg(*measure_sums(count=F.col("row_cnt")))


def describe(
    aggregate: DataFrame,
    calendar: DataFrame,
    companies: DataFrame,
    profit_centers: DataFrame,
    divisions: DataFrame,
    versions: DataFrame,
) -> DataFrame:
    """The aggregate with the descriptions of its keys: joined late, to the fewer rows."""
    parents = (
        (calendar, "fiscal_year_period_nbr", ["fiscal_year_nbr", "fiscal_quarter_nbr"]),
        (companies, "company_id", ["company_cd", "company_nm", "currency_cd"]),
        (profit_centers, "profit_center_id", ["profit_center_nbr", "geography_nm"]),
        (divisions, "division_id", ["division_nm", "division_group"]),
        (versions, "version_forecast_mapping_id", ["version_nbr", "version_group_nm"]),
    )
    keyed = aggregate.withColumn("_row", F.xxhash64(*GRAIN))
    steps = [Lookup(parent, key, key, columns) for parent, key, columns in parents]
    return lookups(keyed, steps, "_row").drop("_row")


@dataclass(frozen=True)
class MeasureView:
    """Named dimensions and measures over a source, computed when they are asked for.

    Both are SQL expressions; a measure is an aggregate.  Nothing is stored: a query is a
    group-by over the source, of which only the columns it names are read.
    """

    source: DataFrame
    dimensions: Mapping[str, str]
    measures: Mapping[str, str]

    def query(
        self, by: Sequence[str], measures: Sequence[str], where: str | None = None
    ) -> DataFrame:
        """The measures per combination of the dimensions, for the rows meeting ``where``."""
        rows = self.source if where is None else self.source.where(where)
        return rows.groupBy(*(F.expr(self.dimensions[d]).alias(d) for d in by)).agg(
            *(F.expr(self.measures[m]).alias(m) for m in measures)
        )

    def create_view(self, name: str, by: Sequence[str], measures: Sequence[str]) -> None:
        """A temporary view of a query, for SQL users."""
        self.query(by, measures).createOrReplaceTempView(name)


@dataclass(frozen=True)
class RoutedView:
    """A measure view that answers from a stored aggregate whatever it holds.

    ``stored`` states the same dimensions and measures over the aggregate, as far as they follow
    from it: sums of sums, counts as sums of counts.  A query goes there if it names none but
    those and its condition reads grain columns alone; otherwise the detail rows answer.
    """

    detail: MeasureView
    stored: MeasureView
    grain: Sequence[str] = GRAIN

    def route(
        self, by: Sequence[str], measures: Sequence[str], where: str | None = None
    ) -> MeasureView:
        """The view that answers a query."""
        named = set(by) <= set(self.stored.dimensions) and set(measures) <= set(
            self.stored.measures
        )
        return self.stored if named and self._has_columns_of(where) else self.detail

    def query(
        self, by: Sequence[str], measures: Sequence[str], where: str | None = None
    ) -> DataFrame:
        """The measures per combination of the dimensions, for the rows meeting ``where``."""
        return self.route(by, measures, where).query(by, measures, where)

    def _has_columns_of(self, where: str | None) -> bool:
        """Whether the analyzer finds all of a condition's columns in the grain.

        The aggregate's sums have the names of amounts, yet no condition on a row's amount.
        """
        if where is None:
            return True
        # Rows of their own, for a filter sees past a projection.
        fields = [f for f in self.stored.source.schema if f.name in self.grain]
        rows = self.stored.source.sparkSession.createDataFrame([], StructType(fields))
        try:
            return bool(rows.where(where).schema)
        except AnalysisException:
            return False


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: the rows of either side, and how many differ counting repeats.

    Both sides meet in a single group-by, where equal rows cancel out.
    """
    columns = left.columns
    tagged = left.select(*columns, F.lit(1).alias("_side")).unionAll(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    per_row = tagged.groupBy(*columns).agg(
        F.count_if(F.col("_side") == 1).alias("_left"),
        F.count_if(F.col("_side") == -1).alias("_right"),
    )
    return per_row.agg(
        F.coalesce(F.sum("_left"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_right"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.greatest(F.col("_left") - F.col("_right"), F.lit(0))), F.lit(0)).alias(
            "only_left"
        ),
        F.coalesce(F.sum(F.greatest(F.col("_right") - F.col("_left"), F.lit(0))), F.lit(0)).alias(
            "only_right"
        ),
    )

"""The 13-period fiscal calendar, and the mapping from a date to its period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions.exprs import code, zero_pad
from ledgerweave.functions.pools import FISCAL_START_MONTH, PERIODS_PER_YEAR
from ledgerweave.sources.schema import project

TABLE = "calendar_fiscal_period_v"


def fiscal_year(date: Column) -> Column:
    """The fiscal year a date falls in, named after the calendar year it starts in."""
    return F.year(date) - (F.month(date) < FISCAL_START_MONTH).cast("int")


def fiscal_period(date: Column) -> Column:
    """The month-long period 1..12.  Period 13 is supplemental and holds no dates."""
    return F.pmod(F.month(date) - F.lit(FISCAL_START_MONTH), F.lit(12)) + F.lit(1)


def fiscal_year_period(date: Column) -> Column:
    """The calendar's key for a date, by arithmetic: an equi-join key, not a range."""
    return fiscal_year(date) * 100 + fiscal_period(date)


def fiscal_years(spark: SparkSession, first: int, last: int) -> DataFrame:
    """One row per fiscal year."""
    return spark.range(first, last + 1, 1, 1).select(F.col("id").cast("int").alias("fiscal_year"))


def fiscal_years_spanned(df: DataFrame, date: str) -> DataFrame:
    """One row per fiscal year between a column's first and last date."""
    span = df.agg(F.min(date).alias("first"), F.max(date).alias("last")).where("first is not null")
    years = F.sequence(fiscal_year(F.col("first")), fiscal_year(F.col("last")))
    return span.select(F.explode(years).alias("fiscal_year"))


def fiscal_calendar(years: DataFrame, first_year: int | Column) -> DataFrame:
    """Thirteen periods for each row of ``years``; sequences count from ``first_year``."""
    base = first_year if isinstance(first_year, Column) else F.lit(first_year)
    periods = years.select(
        F.col("fiscal_year").alias("fy"),
        base.cast("int").alias("fy0"),
        F.explode(F.sequence(F.lit(1), F.lit(PERIODS_PER_YEAR))).alias("p"),
    )
    fy, fy0, p = F.col("fy"), F.col("fy0"), F.col("p")
    start, quarter, season = F.col("start"), F.col("quarter"), F.col("season")
    year_start = F.make_date(fy, F.lit(FISCAL_START_MONTH), F.lit(1))
    rows = periods.select(
        "fy",
        "fy0",
        "p",
        F.add_months(year_start, p - 1).alias("start"),
        F.ceil(p * 4 / PERIODS_PER_YEAR).cast("int").alias("quarter"),
        F.when(p <= PERIODS_PER_YEAR // 2, F.lit("SS")).otherwise(F.lit("FW")).alias("season"),
    )
    is_first_season = season == "SS"
    season_first = F.add_months(year_start, F.when(is_first_season, 0).otherwise(6))
    season_last_month = F.add_months(
        year_start, F.when(is_first_season, 5).otherwise(PERIODS_PER_YEAR - 1)
    )
    sequence = (fy - fy0) * PERIODS_PER_YEAR + p
    period_cd = code("P", p, 2)
    fy_name = code("FY", fy)
    quarter_cd = code("Q", quarter)
    return project(
        rows,
        TABLE,
        {
            "fiscal_year_period_nbr": fy * 100 + p,
            "month_long_nm": F.date_format(start, "MMMM"),
            "month_short_nm": F.date_format(start, "MMM"),
            "month_nbr": F.month(start),
            "year_mth": F.year(start) * 100 + F.month(start),
            "month_relevance_dt": start,
            "month_start_dt": start,
            "month_end_dt": F.last_day(start),
            "month_sort_sequence_nbr": sequence,
            "fiscal_period_nbr": p,
            "fiscal_period_cd": period_cd,
            "fiscal_period_sort_sequence_nbr": p,
            "fiscal_year_period_cd": F.concat(fy_name, period_cd),
            "fiscal_year_period_nm": F.concat(fy_name, F.lit(" Period "), zero_pad(p, 2)),
            "season_period_cd": season,
            "season_alternate_period_cd": F.concat(season, fy.cast("string")),
            "season_nm": F.when(is_first_season, F.lit("Spring/Summer")).otherwise(
                F.lit("Fall/Winter")
            ),
            "season_relevance_dt": start,
            "season_start_dt": season_first,
            "season_end_dt": F.last_day(season_last_month),
            "season_sort_sequence_nbr": (fy - fy0) * 2 + F.when(is_first_season, 1).otherwise(2),
            "quarter_calendar_nbr": F.quarter(start),
            "quarter_calendar_sequence_nbr": (F.year(start) - fy0) * 4 + quarter,
            "quarter_business_nbr": quarter,
            "fiscal_quarter_nbr": quarter,
            "fiscal_quarter_cd": quarter_cd,
            "fiscal_quarter_sort_sequence_nbr": quarter,
            "fiscal_year_quarter_nbr": fy * 10 + quarter,
            "fiscal_year_quarter_cd": F.concat(fy_name, quarter_cd),
            "fiscal_year_quarter_alternate_cd": F.concat(fy.cast("string"), quarter_cd),
            "year_cd": fy.cast("string"),
            "year_nm": fy_name,
            "year_nbr": fy.cast("string"),
            "year_start_dt": year_start,
            "year_end_dt": F.date_sub(F.add_months(year_start, 12), 1),
            "business_year_nbr": fy,
            "fiscal_year_nbr": fy,
            "fiscal_year_cd": fy_name,
            "fiscal_period_sort": sequence,
        },
    )

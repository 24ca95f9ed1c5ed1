"""The fiscal calendar and the mapping from dates to periods."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerweave.functions.calendar import (
    fiscal_calendar,
    fiscal_year,
    fiscal_year_period,
    fiscal_years,
    fiscal_years_spanned,
)
from ledgerweave.operators.checks import calendar_check


@pytest.fixture(scope="module")
def calendar(spark):
    df = fiscal_calendar(fiscal_years(spark, 2019, 2025), 2019)
    return {r.fiscal_year_period_nbr: r for r in df.collect()}


def test_periods_and_months(calendar):
    assert len(calendar) == 91
    assert len({r.month_start_dt for r in calendar.values()}) == 85
    firsts = {p: calendar[202000 + p].month_start_dt for p in (1, 7, 8, 12, 13)}
    assert firsts == {
        1: dt.date(2020, 6, 1),
        7: dt.date(2020, 12, 1),
        8: dt.date(2021, 1, 1),
        12: dt.date(2021, 5, 1),
        13: dt.date(2021, 6, 1),
    }


def test_quarters_and_seasons(calendar):
    quarters = [calendar[202000 + p].fiscal_quarter_nbr for p in range(1, 14)]
    assert quarters == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 4]
    seasons = [calendar[202000 + p].season_period_cd for p in range(1, 14)]
    assert seasons == ["SS"] * 6 + ["FW"] * 7


def test_names_and_sequences(calendar):
    row = calendar[202102]
    assert row.month_long_nm == "July" and row.month_short_nm == "Jul"
    assert row.year_mth == 202107 and row.month_end_dt == dt.date(2021, 7, 31)
    assert row.fiscal_year_period_cd == "FY2021P02"
    assert row.fiscal_year_period_nm == "FY2021 Period 02"
    assert row.fiscal_year_quarter_cd == "FY2021Q1"
    assert row.fiscal_year_quarter_alternate_cd == "2021Q1"
    assert row.month_sort_sequence_nbr == 2 * 13 + 2
    assert row.season_sort_sequence_nbr == 5
    assert calendar[202108].quarter_calendar_sequence_nbr == (2022 - 2019) * 4 + 3


def test_year_spans_its_twelve_months_whatever_the_period(calendar):
    for p in range(1, 14):
        row = calendar[202000 + p]
        assert (row.year_start_dt, row.year_end_dt) == (dt.date(2020, 6, 1), dt.date(2021, 5, 31))


def test_every_date_has_one_period_that_holds_it(spark, calendar):
    days = spark.sql(
        "select explode(sequence(date'2019-06-01', date'2026-05-31')) as d"
    ).select("d", fiscal_year_period(F.col("d")).alias("p"), fiscal_year(F.col("d")).alias("y"))
    for row in days.collect():
        period = calendar[row.p]
        assert period.month_start_dt <= row.d <= period.month_end_dt
        assert period.fiscal_period_nbr <= 12 and period.fiscal_year_nbr == row.y


def test_spanned_years_come_from_the_data(spark):
    dates = spark.createDataFrame(
        [(dt.date(2020, 5, 31),), (dt.date(2021, 6, 1),), (None,)], "d date"
    )
    years = [r[0] for r in fiscal_years_spanned(dates, "d").collect()]
    assert years == [2019, 2020, 2021]
    assert fiscal_years_spanned(dates.where("d is null"), "d").collect() == []


def test_check_reports_a_short_year(spark):
    good = fiscal_calendar(fiscal_years(spark, 2019, 2021), 2019)
    short = good.where("fiscal_year_period_nbr <> 202001")
    found = {r.fiscal_year_nbr: r.is_valid for r in calendar_check(short).collect()}
    assert found == {2019: True, 2020: False, 2021: True}

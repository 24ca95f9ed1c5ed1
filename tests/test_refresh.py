"""The aggregate kept up to date, measures routed to it, and partitions replaced in place."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ledgerweave.operators import agg, refresh
from ledgerweave.plans.queries import measure_view, stored_view
from ledgerweave.sources import tables
from ledgerweave.sources.generate import Volumes, generate
from ledgerweave.sources.schema import Layout
from ledgerweave.sources.spec import id_range

SIZES = Volumes(
    ledger_rows=9_000, rows={"profit_center": 5, "company_code": 3, "division_text": 2}
)
LEDGER = "general_ledger_fact"


@pytest.fixture(scope="module")
def accounts(spark, salted):
    return generate(spark, "gl_account_dim", SIZES, salted)


@pytest.fixture(scope="module")
def rows(spark, salted):
    def between(first, last):
        ids = id_range(spark, last - first + 1, start=first)
        return generate(spark, LEDGER, SIZES, salted, ids=ids)

    return between


def same(left, right):
    return tuple(agg.reconcile(left, right.select(*left.columns)).first())[2:] == (0, 0)


def test_two_appends_equal_a_rebuild(spark, rows, accounts, tmp_path):
    target = f"{tmp_path}/aggregate"
    refresh.create_aggregate(rows(1, 5_000), accounts, target)
    refresh.refresh_aggregate(spark, target, rows(5_001, 7_000), accounts, 1)
    refresh.refresh_aggregate(spark, target, rows(7_001, 9_000), accounts, 2)
    stored = refresh.stored_aggregate(spark, target)
    assert same(stored, agg.ledger_aggregate(rows(1, 9_000), accounts))
    assert stored.groupBy(*agg.GRAIN).count().where("count > 1").count() == 0


def test_a_refresh_reads_the_appended_rows_and_the_aggregate_alone(
    spark, rows, accounts, tmp_path, physical_plan, monkeypatch
):
    ledger, target = f"{tmp_path}/ledger", f"{tmp_path}/aggregate"
    tables.save_declared(rows(1, 5_000), LEDGER, ledger)
    refresh.create_aggregate(tables.read_table(spark, ledger), accounts, target)
    plans = []
    replace = refresh.replace_partitions

    def watched(spark, df, *rest):
        plans.append(physical_plan(df))
        replace(spark, df, *rest)

    monkeypatch.setattr(refresh, "replace_partitions", watched)
    period = 200001
    appended = rows(5_001, 6_000).where(F.col(refresh.PERIOD) >= period)
    refresh.refresh_aggregate(spark, target, appended, accounts, 1)
    assert len(plans) == 1
    # No scan has the ledger's own columns, and only touched periods are read.
    assert "gl_account_nbr" not in plans[0]
    assert "PartitionFilters: [fiscal_year_period_nbr" in plans[0]


def test_periods_without_new_rows_keep_their_files(spark, rows, accounts, tmp_path):
    target = f"{tmp_path}/aggregate"
    refresh.create_aggregate(rows(1, 5_000), accounts, target)
    before = files(target)
    last = max(before)
    appended = rows(5_001, 6_000).where(F.concat(F.lit(f"{refresh.PERIOD}="), refresh.PERIOD) == last)
    refresh.refresh_aggregate(spark, target, appended, accounts, 1)
    after = files(target)
    assert {p for p in before if before[p] != after[p]} == {last}


def test_a_refresh_that_broke_off_is_not_counted_twice(spark, rows, accounts, tmp_path, monkeypatch):
    target = f"{tmp_path}/aggregate"
    refresh.create_aggregate(rows(1, 5_000), accounts, target)
    replace = refresh.replace_partitions

    def half(spark, df, *rest):
        periods = sorted(r[0] for r in df.select(refresh.PERIOD).distinct().collect())
        replace(spark, df.where(F.col(refresh.PERIOD).isin(periods[::2])), *rest)
        raise OSError("lost")

    monkeypatch.setattr(refresh, "replace_partitions", half)
    with pytest.raises(OSError):
        refresh.refresh_aggregate(spark, target, rows(5_001, 6_000), accounts, 1)
    monkeypatch.setattr(refresh, "replace_partitions", replace)
    for _ in range(2):
        refresh.refresh_aggregate(spark, target, rows(5_001, 6_000), accounts, 1)
    want = agg.ledger_aggregate(rows(1, 6_000), accounts)
    assert same(refresh.stored_aggregate(spark, target), want)


def test_an_append_of_nothing_changes_nothing(spark, rows, accounts, tmp_path):
    target = f"{tmp_path}/aggregate"
    refresh.create_aggregate(rows(1, 500), accounts, target)
    before = files(target)
    refresh.refresh_aggregate(spark, target, rows(1, 500).limit(0), accounts, 1)
    assert files(target) == before


@pytest.fixture(scope="module")
def routed(spark, rows, accounts, tmp_path_factory):
    root = tmp_path_factory.mktemp("routed")
    tables.save_declared(rows(1, 4_000), LEDGER, f"{root}/ledger")
    ledger = tables.read_table(spark, f"{root}/ledger")
    refresh.create_aggregate(ledger, accounts, f"{root}/aggregate")
    stored = refresh.stored_aggregate(spark, f"{root}/aggregate")
    return agg.RoutedView(measure_view(ledger, accounts), stored_view(stored))


@pytest.mark.parametrize(
    "by, measures, where, stored",
    [
        (["fiscal_year", "account_class"], ["sales_qty", "row_cnt"], None, True),
        (["company_id"], ["return_rate"], "fiscal_year_period_nbr >= 200001", True),
        ([], ["row_cnt"], "account_class like 'R%'", True),
        (["fiscal_year"], ["negative_share"], None, False),
        (["company_cd"], ["row_cnt"], None, False),
        (["fiscal_year"], ["row_cnt"], "product_id < 9", False),
        # A condition on a row's amount isn't one on a sum of the same name.
        (["fiscal_year"], ["row_cnt"], "transaction_currency_amt > 0", False),
    ],
)
def test_a_query_goes_where_it_can_be_answered(routed, physical_plan, by, measures, where, stored):
    got = routed.query(by, measures, where)
    folder = "/aggregate/" if stored else "/ledger/"
    assert got.inputFiles() and all(folder in f for f in got.inputFiles())
    if stored:
        assert "Join" not in physical_plan(got)
    assert same(got, routed.detail.query(by, measures, where))


def test_an_unknown_column_is_an_error(routed):
    with pytest.raises(Exception, match="nowhere"):
        routed.query(["fiscal_year"], ["row_cnt"], "nowhere = 1")


def files(path):
    return {
        d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet"))
        for d in os.listdir(path)
        if "=" in d
    }


LAYOUT = Layout(("p",), ("k",))


def numbered(spark, first, last, parts=3):
    return spark.range(first, last).select(
        "id", (F.col("id") % parts).alias("p"), (F.col("id") * 7 % 1000).alias("k")
    )


def test_replaced_partitions_hold_the_new_rows_alone(spark, tmp_path):
    target = f"{tmp_path}/t"
    tables.save_table(numbered(spark, 0, 3_000), target, LAYOUT, "id", 3_000, rows_per_file=500)
    before = files(target)
    new = tables.read_table(spark, target).where("p = 1 and k < 300")  # from the table itself
    tables.replace_partitions(spark, new, target, LAYOUT, "id")
    after = files(target)
    assert {p for p in before if before[p] != after[p]} == {"p=1"}
    saved = tables.read_table(spark, target)
    assert saved.where("p = 1").agg(F.max("k")).first()[0] < 300
    assert saved.where("p <> 1").count() == 2_000


def test_a_failed_replacement_leaves_the_partition(spark, tmp_path):
    target = f"{tmp_path}/t"
    tables.save_table(numbered(spark, 0, 300), target, LAYOUT, "id")
    before = files(target)
    broken = tables.read_table(spark, target).where("p = 1")
    broken = broken.withColumn("k", F.when(F.col("id") < 200, F.col("k")).otherwise(
        F.raise_error(F.lit("broken")).cast("bigint")))
    with pytest.raises(Exception, match="broken"):
        tables.replace_partitions(spark, broken, target, LAYOUT, "id")
    assert files(target) == before
    assert tables.read_table(spark, target).count() == 300


def test_partitions_of_a_catalog_table_are_replaced(spark):
    tables.save_table(numbered(spark, 0, 300), "replaced_here", LAYOUT, "id")
    new = spark.table("replaced_here").where("p = 2").withColumn("k", F.lit(-1).cast("bigint"))
    tables.replace_partitions(spark, new, "replaced_here", LAYOUT, "id")
    got = spark.table("replaced_here")
    assert got.where("p = 2").agg(F.max("k"), F.count("*")).first() == (-1, 100)
    assert got.where("p <> 2").agg(F.min("k"), F.count("*")).first() == (0, 200)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    spark.sql("drop table replaced_here")


def test_a_layout_without_partitions_has_none_to_replace(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.replace_partitions(spark, spark.range(1), f"{tmp_path}/t", Layout(), "id")


def test_only_overlapping_partitions_are_clustered_again(spark, tmp_path):
    target, whole = f"{tmp_path}/t", f"{tmp_path}/whole"
    rows = numbered(spark, 0, 6_000)
    appended = numbered(spark, 6_000, 9_000).where("p = 2")
    for path, part, mode in (
        (target, rows, "overwrite"),
        (target, appended, "append"),
        (whole, rows.union(appended), "overwrite"),
    ):
        tables.save_table(part, path, LAYOUT, "id", part.count(), mode, rows_per_file=100)
    assert tables.overlapping_partitions(tables.read_table(spark, target), "p", "k") == [2]
    before = files(target)
    sizes = {p: sum(os.path.getsize(f"{target}/{p}/{f}") for f in names) for p, names in before.items()}
    assert tables.recluster_appended(spark, target, LAYOUT, "id", 3_000, 100) == [2]
    after = files(target)
    assert {p for p in before if before[p] != after[p]} == {"p=2"}
    assert sizes["p=2"] < sum(sizes.values()) / 2 * 1.2  # half of the partition's bytes are new
    assert tables.overlapping_partitions(tables.read_table(spark, target), "p", "k") == []
    assert tables.recluster_appended(spark, target, LAYOUT, "id") == []

    def span(path):
        saved = tables.read_table(spark, path).where("p = 2")
        ranges = saved.groupBy(F.input_file_name()).agg((F.max("k") - F.min("k")).alias("s"))
        return ranges.agg(F.avg("s")).first()[0]

    assert span(target) <= 1.2 * span(whole)
    assert tables.read_table(spark, target).agg(F.sum("id"), F.count("*")).first() == (
        rows.union(appended).agg(F.sum("id"), F.count("*")).first()
    )

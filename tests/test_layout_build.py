"""Writing in a layout, and building many tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ledgerweave.operators import checks
from ledgerweave.plans import build as build_module
from ledgerweave.plans import queries as queries_module
from ledgerweave.plans.build import build, build_order, parents_of, resolve_scope, table_of
from ledgerweave.sources.generate import Volumes, generate
from ledgerweave.sources import tables as tables_module
from ledgerweave.sources.schema import DIMENSIONS, FACTS, RELATIONS, TABLES, Layout
from ledgerweave.sources.tables import (
    cluster,
    file_count,
    file_sizes,
    read_table,
    recluster,
    rows_per_file,
    save_by_bytes,
    save_table,
    scratch_path,
    size_files,
    zorder_key,
)

SMALL = Volumes(
    ledger_rows=4_000,
    rows={"finance_product_dim_v": 300, "finance_customer_dim_v": 200, "cost_center_dim_v": 100},
)


def files_of(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_file_count():
    assert [file_count(n, 10) for n in (0, 1, 10, 11, 95)] == [1, 1, 1, 2, 10]


def test_size_files_writes_that_many(spark):
    path = scratch_path(spark, "t")
    save_table(size_files(spark.range(95), 95, 10), path)
    assert len(files_of(path)) == 10


def test_clustering_splits_a_hot_value_over_partitions(spark):
    rows = spark.range(9_000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k")
    )
    sizes = [
        r[1] for r in cluster(rows, ["k"], "id", 9).groupBy(F.spark_partition_id()).count().collect()
    ]
    assert len(sizes) == 9 and max(sizes) < 2_000


def test_partitions_are_pruned_and_rows_are_kept(spark, physical_plan):
    path = scratch_path(spark, "t")
    rows = spark.range(1_000).select("id", (F.col("id") % 4).cast("int").alias("p"))
    save_table(rows, path, Layout(("p",), ("id",)), "id", rows=1_000, rows_per_file=100)
    back = read_table(spark, path).where("p = 2")
    assert back.count() == 250
    assert "PartitionFilters: [isnotnull(p" in physical_plan(back)
    assert "ZSTD" in str(os.listdir(os.path.join(path, "p=2"))).upper()


def test_append_adds_and_overwrite_replaces(spark):
    path = scratch_path(spark, "t")
    for mode in ("overwrite", "append"):
        save_table(spark.range(10), path, mode=mode)
    assert read_table(spark, path).count() == 20
    save_table(spark.range(3), path)
    assert read_table(spark, path).count() == 3


def test_save_and_read_by_name(spark):
    save_table(spark.range(5), "saved_numbers")
    assert read_table(spark, "saved_numbers").count() == 5
    spark.sql("drop table saved_numbers")


def test_zorder_interleaves_and_follows_each_column(spark):
    rows = spark.range(256).select(
        (F.col("id") % 16).alias("a"), F.floor(F.col("id") / 16).alias("b")
    )
    keyed = rows.select("a", "b", zorder_key(rows, ["a", "b"], bits=4).alias("z"))

    def cell(key: int, column: int) -> int:
        return sum(((key >> (2 * bit + column)) & 1) << bit for bit in range(4))

    found = keyed.collect()
    for column, name in enumerate("ab"):
        cells = {(r[name], cell(r.z, column)) for r in found}
        assert len(cells) == 16  # the column's cell does not depend on the other column
        in_order = [c for _, c in sorted(cells)]
        assert in_order == sorted(in_order) and len(set(in_order)) >= 15


def test_zorder_of_strings_and_dates_is_monotone(spark):
    rows = spark.range(1_000).select(
        F.concat(F.lit("CC"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("s"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"),
    )
    for column in ("s", "d"):
        found = rows.select(column, zorder_key(rows, [column]).alias("z")).orderBy(column).collect()
        cells = [r.z for r in found]
        assert cells == sorted(cells) and len(set(cells)) == 64
    constant = rows.select(F.lit("x").alias("s"))
    assert constant.select(zorder_key(constant, ["s"])).distinct().count() == 1


def test_recluster_narrows_the_files(spark):
    source, target = scratch_path(spark, "a"), scratch_path(spark, "b")
    rows = spark.range(20_000).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(1_000)).alias("a"), F.pmod(F.hash("id"), F.lit(1_000)).alias("b")
    )
    save_table(size_files(rows, 20_000, 1_250), source)
    recluster(spark, source, target, ["a", "b"], "id", 20_000, 1_250)

    def touched(path):
        back = read_table(spark, path).withColumn("file", F.input_file_name())
        ranges = back.groupBy("file").agg(F.min("a").alias("lo"), F.max("a").alias("hi"))
        return ranges.where("500 between lo and hi").count(), ranges.count()

    assert read_table(spark, target).exceptAll(rows).count() == 0
    assert touched(source) == (16, 16)
    hit, files = touched(target)
    assert files == 16 and hit <= 8


def test_scratch_path_is_under_the_sessions_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_build_order_puts_parents_first():
    order = build_order()
    assert sorted(order) == sorted(TABLES)
    for table in TABLES:
        assert all(order.index(p) < order.index(table) for p in parents_of(table))


def test_scopes():
    assert set(resolve_scope("dimensions")) == set(DIMENSIONS)
    assert set(resolve_scope("facts")) == set(FACTS)
    assert resolve_scope("profit_center") == ["profit_center"]
    with pytest.raises(ValueError, match="unknown scope"):
        resolve_scope("everything")


def test_build_all_then_check(spark, salted):
    target = scratch_path(spark, "build")
    report = {r.table_name: r for r in build(spark, target, salted, SMALL).collect()}
    assert {r.status for r in report.values()} == {"OK"} and len(report) == 31
    tables = {t: table_of(spark, target, t) for t in TABLES}
    counts = {r.table_name: r.row_cnt for r in checks.row_counts(tables).collect()}
    assert counts == {t: r.row_cnt for t, r in report.items()}
    orphans = checks.orphan_report(tables, RELATIONS)
    assert orphans.count() == 14 and orphans.where("orphan_rows > 0").count() == 0
    ledger = tables["general_ledger_fact"]
    assert checks.schema_conformance(ledger, "general_ledger_fact").where("not conforms").count() == 0
    assert checks.key_density(ledger, "l", "general_ledger_fact_id").first().is_dense


def test_facts_alone_refer_to_the_same_parents(spark, salted):
    target = scratch_path(spark, "build")
    report = build(spark, target, salted, SMALL, scope="CIS_fact")
    assert [(r.table_name, r.status, r.row_cnt) for r in report.collect()] == [("CIS_fact", "OK", 8)]
    centers = generate(spark, "profit_center", SMALL, salted)
    facts = table_of(spark, target, "CIS_fact")
    assert checks.orphan_keys(facts, "profit_center_id", centers, "profit_center_id").count() == 0


def test_appends_take_new_ids_and_report_what_they_wrote(spark, salted):
    target = scratch_path(spark, "build")
    ledger, n = "general_ledger_fact", SMALL.of("general_ledger_fact")
    for i, mode in enumerate(("overwrite", "append", "append")):
        report = build(
            spark, target, salted, SMALL, scope=ledger, mode=mode, first_ids={ledger: i * n}
        )
        assert [(r.status, r.row_cnt) for r in report.collect()] == [("OK", n)]
    rows = table_of(spark, target, ledger)
    assert rows.count() == 3 * n
    assert checks.duplicate_keys(rows, ["general_ledger_fact_id"]).count() == 0


def test_a_build_writes_what_generate_makes_and_leaves_the_session(spark, salted):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    target = scratch_path(spark, "build")
    try:
        build(spark, target, salted, SMALL, scope="facts")
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for table in FACTS:
        made, written = generate(spark, table, SMALL, salted), table_of(spark, target, table)
        assert made.exceptAll(written).count() == 0 and written.exceptAll(made).count() == 0


def test_files_of_a_built_fact_span_few_profit_centers(spark, salted, monkeypatch):
    n = 60_000
    sized = Volumes(ledger_rows=n, first_fiscal_year=2024, last_fiscal_year=2024)
    clustered = build_module.generate_clustered
    monkeypatch.setattr(
        build_module,
        "generate_clustered",
        lambda *a, **k: clustered(*a, **k, rows_per_file=n // (13 * 30)),
    )
    target = scratch_path(spark, "build")
    build(spark, target, salted, sized, scope="general_ledger_fact")
    rows = table_of(spark, target, "general_ledger_fact").withColumn("file", F.input_file_name())
    per_file = rows.groupBy("file").agg(
        (F.max("profit_center_id") - F.min("profit_center_id")).alias("span")
    )
    files, span = per_file.agg(F.count("*"), F.avg("span")).first()
    assert files >= 13 * 30 and span < 200


def test_a_failure_skips_its_children_only(spark, salted, monkeypatch):
    def failing(spark, table, *args, **kwargs):
        if table == "division_text":
            raise RuntimeError("no space")
        return generate(spark, table, *args, **kwargs)

    monkeypatch.setattr(build_module, "generate", failing)
    scope = ("division_text", "division_text_dim_v", "general_ledger_fact", "company_code")
    monkeypatch.setitem(build_module.SCOPES, "some", scope)
    report = {
        r.table_name: r for r in build(spark, scratch_path(spark, "b"), salted, SMALL, "some").collect()
    }
    assert {t: r.status for t, r in report.items()} == {
        "division_text": "FAILED",
        "division_text_dim_v": "SKIPPED",
        "general_ledger_fact": "SKIPPED",
        "company_code": "OK",
    }
    assert report["division_text"].error == "RuntimeError: no space"
    assert "division_text" in report["general_ledger_fact"].error


def test_files_of_narrow_and_wide_rows_have_the_wanted_bytes(spark, tmp_path):
    hashes = [F.sha2(F.concat("id", F.lit(str(i))), 256).alias(f"c{i}") for i in range(8)]
    tables = {
        "narrow": spark.range(1_000_000).select(F.xxhash64("id").alias("id")),
        "wide": spark.range(30_000).select("id", *hashes),
    }
    wanted = 1 << 19
    for table, df in tables.items():
        path = f"{tmp_path}/{table}"
        files = save_by_bytes(df, path, bytes_per_file=wanted)
        assert files > 8 and len(near_files(spark, path, wanted)) == files
        # An append is measured by the table's own files.
        assert save_by_bytes(df, path, "append", bytes_per_file=wanted) == files
        assert len(near_files(spark, path, wanted)) == 2 * files
        saved = read_table(spark, path)
        assert saved.count() == 2 * df.count() and saved.exceptAll(df.unionAll(df)).count() == 0


def near_files(spark, path, wanted):
    sizes = [r.length for r in file_sizes(spark, path).collect()]
    return [s for s in sizes if wanted / 2 <= s <= 2 * wanted]


def test_files_by_bytes_where_wide_rows_stand_together(spark, tmp_path):
    text = F.when(F.col("id") > 150_000, F.sha2(F.col("id").cast("string"), 512)).otherwise("")
    path = f"{tmp_path}/t"
    files = save_by_bytes(spark.range(200_000).select("id", text), path, bytes_per_file=1 << 18)
    assert files > 8 and len(near_files(spark, path, 1 << 18)) == files


def test_by_bytes_takes_empty_tables_and_appends_to_them(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert save_by_bytes(spark.range(0), path) == 1
    assert save_by_bytes(spark.range(10), path, mode="append") == 1
    assert save_by_bytes(spark.range(10), f"{tmp_path}/new", mode="append") == 1
    assert read_table(spark, path).count() == read_table(spark, f"{tmp_path}/new").count()
    assert save_by_bytes(spark.range(100), path, bytes_per_file=100, row_bytes=8.0) == 8


def test_zorder_cells_count_the_bounds_that_a_value_has_passed(spark):
    values = [None, float("-inf"), -1.5, -0.0, 0.0, 2.5, 7.0, float("inf"), float("nan")]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for bounds in ([], [0.0], [-1.5, 0.0], [-1.5, 0.0, 2.5], [float(n) for n in range(-3, 9)]):
        cell = tables_module._cell(F.col("x"), bounds, len(bounds) + 1)
        passed = [r[0] for r in rows.select(cell).collect()]
        # Spark takes NaN as larger than any number.
        assert passed == [
            0 if v is None else sum(not v < bound for bound in bounds) for v in values
        ]


def test_files_of_a_larger_table_hold_more_rows():
    assert [rows_per_file(n, 500, 1_200) for n in (0, 600_000, 600_001, 36_000_000)] == [
        500, 500, 501, 30_000
    ]
    assert rows_per_file(10**12, 500, 1_200) == 2_500_000


def test_clustered_layout_is_measured_on_a_bounded_number_of_files(spark, tmp_path, monkeypatch):
    lines = spark.range(4_000).select(
        F.col("id").alias("l_orderkey"),
        *(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(900)).alias(c) for c in ("l_partkey", "l_suppkey")),
    )
    save_table(lines, f"{tmp_path}/sf/lineitem.parquet")
    monkeypatch.setattr(queries_module, "SMALL_FILE", 10)
    monkeypatch.setattr(queries_module, "SMALL_FILES", 40, raising=False)
    monkeypatch.setattr(queries_module, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    found = queries_module.clustered_files(spark, f"{tmp_path}/sf").collect()
    assert [(r.layout, r.row_cnt, r.narrow_l_partkey) for r in found] == [
        ("written", 4_000, False), ("clustered", 4_000, True)
    ]
    for layout in ("written", "clustered"):
        assert 30 <= len(files_of(f"{tmp_path}/lineitem/{layout}")) <= 40


def test_files_by_bytes_are_bounded_in_a_larger_table(spark, tmp_path, monkeypatch):
    columns = ("l_orderkey", "l_partkey", "l_suppkey")
    lines = spark.range(40_000).select(*(F.xxhash64("id", F.lit(c)).alias(c) for c in columns))
    save_table(lines, f"{tmp_path}/sf/lineitem.parquet")
    bound = 16 << 10
    monkeypatch.setattr(queries_module, "BYTES_PER_FILE", bound, raising=False)
    monkeypatch.setattr(queries_module, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    found = queries_module.files_by_bytes(spark, f"{tmp_path}/sf").collect()
    assert [tuple(r) for r in found] == [("narrow", 40_000, True), ("wide", 40_000, True)]
    for layout in ("narrow", "wide"):
        sizes = [r.length for r in file_sizes(spark, f"{tmp_path}/{layout}/sized").collect()]
        assert len(sizes) > 30 and max(sizes) <= 2 * bound

"""Overwrites that fail leave the former table; builds run side by side and can be resumed."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F

from ledgerweave.plans import build as build_module
from ledgerweave.plans.build import build, table_of
from ledgerweave.sources import tables
from ledgerweave.sources.generate import Volumes, generate
from ledgerweave.sources.schema import Layout
from ledgerweave.sources.spec import id_range

SMALL = Volumes(
    ledger_rows=300,
    rows={"finance_customer_dim_v": 40, "finance_product_dim_v": 40, "CIS_fact": 20},
)
LEDGER = "general_ledger_fact"


def failing(df):
    broken = F.when(F.col("id") < 150, F.col("k")).otherwise(F.raise_error(F.lit("broken")))
    return df.withColumn("k", broken.cast("bigint"))


def rows_of(spark, shift=0):
    return spark.range(200).select("id", (F.col("id") % 3).alias("p"), (F.col("id") + shift).alias("k"))


@pytest.mark.parametrize("layout", [Layout(), Layout(("p",), ("k",))])
@pytest.mark.parametrize("named", [False, True])
def test_a_failed_overwrite_leaves_the_former_table(spark, tmp_path, layout, named):
    target = f"kept_{len(layout.partition_by)}" if named else f"{tmp_path}/t"
    tables.save_table(rows_of(spark), target, layout, "id")
    with pytest.raises(Exception, match="broken"):
        tables.save_table(failing(rows_of(spark)), target, layout, "id")
    assert tables.read_table(spark, target).agg(F.sum("k"), F.count("*")).first() == (19_900, 200)
    tables.save_table(rows_of(spark, 1), target, layout, "id")
    assert tables.read_table(spark, target).agg(F.sum("k"), F.count("*")).first() == (20_100, 200)
    if named:
        left = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{target}__")]
        assert not [t for t in left if t.endswith("_former")]
        tables.save_table(rows_of(spark, 2), target, layout, "id", mode="append")
        assert spark.table(target).count() == 400
        spark.sql(f"drop table {target}")
    else:
        assert [d for d in os.listdir(tmp_path) if d.endswith("_former")] == []


def test_a_table_may_be_overwritten_with_its_own_rows(spark, tmp_path):
    target = f"{tmp_path}/t"
    tables.save_table(rows_of(spark), target)
    tables.save_table(tables.read_table(spark, target).where("id < 50"), target)
    assert tables.read_table(spark, target).count() == 50


def test_a_failed_build_leaves_the_former_tables(spark, salted, tmp_path, monkeypatch):
    target = f"{tmp_path}/star"
    build(spark, target, salted, SMALL, scope="company_code")
    before = table_of(spark, target, "company_code").collect()

    def broken(*args, **kwargs):
        made = generate(*args, **kwargs)
        return made.withColumn("company_nm", F.raise_error(F.lit("broken")).cast("string"))

    monkeypatch.setattr(build_module, "generate", broken)
    report = build(spark, target, salted, SMALL, scope="company_code").first()
    assert report.status == "FAILED" and "broken" in report.error
    assert table_of(spark, target, "company_code").collect() == before


def test_independent_tables_are_written_at_the_same_time(spark, salted, tmp_path, monkeypatch):
    together = threading.Barrier(2, timeout=60)
    write = build_module._write

    def waiting(spark, table, *args):
        together.wait()  # breaks unless two tables are under way
        write(spark, table, *args)

    monkeypatch.setattr(build_module, "_write", waiting)
    monkeypatch.setitem(build_module.SCOPES, "some", ("company_code", "functional_area"))
    report = build(spark, f"{tmp_path}/star", salted, SMALL, "some").collect()
    assert [r.status for r in report] == ["OK", "OK"]


def test_parents_are_written_before_their_children(spark, salted, tmp_path, monkeypatch):
    done, write = [], build_module._write

    def noted(spark, table, *args):
        assert build_module.parents_of(table) & set(build_module.TABLES) <= set(done)
        write(spark, table, *args)
        done.append(table)

    monkeypatch.setattr(build_module, "_write", noted)
    report = build(spark, f"{tmp_path}/star", salted, SMALL).collect()
    assert {r.status for r in report} == {"OK"}
    assert [r.table_name for r in report] == build_module.build_order()


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names)


def test_a_resumed_build_writes_only_what_is_missing(spark, salted, tmp_path):
    target = f"{tmp_path}/star"
    scope = ("company_code", "functional_area", LEDGER)
    build_module.SCOPES["some"] = scope
    try:
        ids = {LEDGER: id_range(spark, 300)}
        build(spark, target, salted, SMALL, "some", ids=ids)
        first = files(target)
        report = build(spark, target, salted, SMALL, "some", ids=ids, resume=True)
        assert {r.table_name: (r.status, r.row_cnt) for r in report.collect()}[LEDGER] == ("KEPT", 300)
        assert {r.status for r in report.collect()} == {"KEPT"}
        assert files(target) == first
        # A table that lost rows, and one with other ids, are written again.
        fewer = table_of(spark, target, "company_code").limit(2)
        tables.save_table(fewer, f"{target}/company_code")
        other = {LEDGER: id_range(spark, 299)}
        report = build(spark, target, salted, SMALL, "some", ids=other, resume=True)
        assert {r.table_name: r.status for r in report.collect()} == {
            "company_code": "OK", "functional_area": "KEPT", LEDGER: "OK",
        }
        # After an append nothing is known to be as it was built.
        build(spark, target, salted, SMALL, LEDGER, "append", first_ids={LEDGER: 1_000})
        report = build(spark, target, salted, SMALL, LEDGER, ids=other, resume=True)
        assert [(r.status, r.row_cnt) for r in report.collect()] == [("OK", 299)]
    finally:
        del build_module.SCOPES["some"]


def test_an_append_cannot_be_resumed(spark, salted, tmp_path):
    with pytest.raises(ValueError):
        build(spark, f"{tmp_path}/star", salted, SMALL, mode="append", resume=True)


def test_a_database_is_built_and_resumed(spark, salted):
    spark.sql("create database if not exists resumed")
    try:
        for want in ("OK", "KEPT"):
            report = build(spark, "resumed", salted, SMALL, scope="CIS_fact", resume=True)
            assert [(r.status, r.row_cnt) for r in report.collect()] == [(want, 20)]
        assert table_of(spark, "resumed", "CIS_fact").count() == 20
    finally:
        spark.sql("drop database resumed cascade")

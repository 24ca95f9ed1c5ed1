"""Each check on data that breaks what it checks."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerweave.operators import checks
from ledgerweave.sources.generate import Volumes, generate
from ledgerweave.sources.schema import Relation


def test_orphan_keys_and_rows(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "pk bigint")
    assert [tuple(r) for r in checks.orphan_keys(child, "k", parent, "pk").collect()] == [(9, 3)]
    relations = [Relation("c", "k", "p", "pk"), Relation("p", "pk", "c", "k")]
    report = {
        r.relation: (r.child_keys, r.orphan_keys, r.orphan_rows)
        for r in checks.orphan_report({"c": child, "p": parent}, relations).collect()
    }
    assert report == {"c.k->p.pk": (3, 1, 3), "p.pk->c.k": (2, 0, 0)}


def test_duplicates_and_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (None, "x")], "k int, s string")
    assert [tuple(r) for r in checks.duplicate_keys(df, ["k", "s"]).collect()] == [(1, "a", 2)]
    row = checks.key_uniqueness({"t": (df, ["k"])}).first()
    assert tuple(row) == ("t", "k", 5, 3, 1, 2)
    empty = checks.key_uniqueness({"t": (df.where("false"), ["k"])}).first()
    assert tuple(empty) == ("t", "k", 0, 0, 0, 0)


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    found = {r.column_name: (r.row_cnt, r.null_cnt) for r in checks.null_counts(df, "t").collect()}
    assert found == {"a": (2, 1), "b": (2, 2)}


def test_schema_conformance_reports_type_order_and_absence(spark, salted):
    table = "version_forecast_mapping"
    good = generate(spark, table, Volumes(), salted)
    assert checks.schema_conformance(good, table).where("not conforms").count() == 0
    bad = good.select(
        "version_forecast_mapping_id",
        "version_group_nm",
        F.col("version_nbr").cast("int").alias("version_nbr"),
    ).where("version_forecast_mapping_id <= 7")
    found = {
        r.column_name: (r.conforms, r.found_type, r.found_position)
        for r in checks.schema_conformance(bad, table).collect()
    }
    assert found == {
        "version_forecast_mapping_id": (True, "bigint", 1),
        "version_nbr": (False, "int", 3),
        "version_group_nm": (False, "string", 2),
        "active_ind": (False, None, None),
    }


def test_amount_distribution(spark):
    df = spark.createDataFrame(
        [(Decimal(x),) for x in ("-1", "2", "3", "100")], "amt decimal(28,5)"
    )
    row = checks.amount_distribution(df, "amt").first()
    assert (row.row_cnt, row.negative_cnt, row.negative_share) == (4, 1, Decimal("0.25"))
    assert (row.abs_total, row.abs_min, row.abs_max) == (106, 1, 100)
    assert row.is_right_skewed
    left = spark.createDataFrame([(Decimal(x),) for x in ("1", "99", "98", "100")], df.schema)
    assert not checks.amount_distribution(left, "amt").first().is_right_skewed


def test_key_density(spark):
    def dense(*keys):
        df = spark.createDataFrame([(k,) for k in keys], "k int")
        return checks.key_density(df, "t", "k").first().is_dense

    assert dense(3, 1, 2)
    assert not dense(1, 2, 4)
    assert not dense(1, 2, 2, 3)
    assert not dense(1, 2, 3, None)


def test_node_parents_finds_a_split_node(spark):
    df = spark.createDataFrame(
        [("A", "a"), ("A", "b"), ("B", "b")], "level_1_cd string, level_2_cd string"
    )
    assert [tuple(r) for r in checks.node_parents(df, "level_", 2).collect()] == [(2, 2, 1)]


def test_rule_violations_count_false_and_null(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    found = {
        r.rule: (r.row_cnt, r.violations)
        for r in checks.rule_violations(df, {"positive": "x > 0", "any": "true"}).collect()
    }
    assert found == {"positive": (3, 2), "any": (3, 0)}


def test_row_counts(spark):
    found = {
        r.table_name: r.row_cnt
        for r in checks.row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()
    }
    assert found == {"a": 3, "b": 0}


KEYS = {
    "bigint": "id",
    "int": "cast(id as int)",
    "decimal": "cast(id as decimal(10,2))",
    "double": "cast(id as double)",
    "date": "date_add(date'2024-01-01', cast(id as int))",
    "timestamp": "cast(date_add(date'2024-01-01', cast(id as int)) as timestamp)",
}


@pytest.mark.parametrize(
    "child, parent",
    [("decimal", "bigint"), ("bigint", "decimal"), ("int", "double"), ("date", "timestamp")],
)
def test_mixed_key_types_meet_in_their_common_type(spark, child, parent):
    tables = {
        "c": spark.range(5).selectExpr(f"{KEYS[child]} as k"),
        "p": spark.range(4).selectExpr(f"{KEYS[parent]} as k"),
    }
    found = checks.orphan_report(tables, [Relation("c", "k", "p", "k")]).first()
    assert (found.child_keys, found.orphan_keys, found.orphan_rows) == (5, 1, 1)


def test_text_and_numbers_are_not_compared(spark):
    tables = {"c": spark.range(3), "p": spark.range(3).select(F.col("id").cast("string"))}
    with pytest.raises(ValueError, match="can't be compared"):
        checks.orphan_report(tables, [Relation("c", "id", "p", "id")])

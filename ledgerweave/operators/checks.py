"""Checks of declared constraints and expected properties.

Every check is a Spark job that returns rows; none collects data or raises.  Group-bys
aggregate on the map side before the shuffle, so a hot key reaches its task as one row
per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.functions.pools import FISCAL_START_MONTH, PERIODS_PER_YEAR
from ledgerweave.sources.schema import Relation, schema


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and its number of rows."""
    return union_all(
        df.agg(F.count("*").alias("row_cnt")).select(F.lit(name).alias("table_name"), "row_cnt")
        for name, df in tables.items()
    )


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """The child keys without a parent, and how many rows hold each.

    Counting per key first bounds the anti join by the number of distinct keys.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column)
    used = used.agg(F.count("*").alias("child_rows"))
    parents = parent.select(F.col(key).alias("_parent_key"))
    return used.join(parents, used[column] == parents["_parent_key"], "left_anti")


def orphan_report(tables: Mapping[str, DataFrame], relations: Sequence[Relation]) -> DataFrame:
    """Per relation: distinct child keys, orphan keys and orphan rows.

    All relations of a child are checked in one scan of it: its key columns become
    (relation, key) rows, which meet the parents' keys in one group-by.  A relation is a
    number until the end.  Both ends are cast to their common type first, as a join would;
    whole-number keys stay numbers and the others are then compared as that type's text.  A
    text and another type have no common type: such a relation is refused.
    """
    numbered = [(i, r, _key_type(tables, r)) for i, r in enumerate(relations)]
    children = dict.fromkeys(r.child for r in relations)
    used = union_all(
        _key_rows(
            tables[child], [(i, r.column, kind) for i, r, kind in numbered if r.child == child]
        )
        for child in children
    )
    known = union_all(_key_rows(tables[r.parent], [(i, r.key, kind)]) for i, r, kind in numbered)
    per_key = (
        used.withColumn("is_child", F.lit(1))
        .unionByName(known.withColumn("is_child", F.lit(0)))
        .groupBy("relation", "number", "text")
        .agg(F.sum("is_child").alias("child_rows"), F.min("is_child").alias("is_orphan"))
    )
    is_used = F.col("child_rows") > 0
    is_orphan = F.col("is_orphan") == 1  # no parent row has brought a zero
    names = F.array(*(F.lit(r.name) for r in relations))
    return (
        per_key.groupBy("relation")
        .agg(
            F.count_if(is_used).alias("child_keys"),
            F.count_if(is_orphan).alias("orphan_keys"),
            F.coalesce(F.sum(F.when(is_orphan, F.col("child_rows"))), F.lit(0)).alias(
                "orphan_rows"
            ),
        )
        .withColumn("relation", F.get(names, F.col("relation")))
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The key values held by more than one row."""
    return df.groupBy(*key).agg(F.count("*").alias("row_cnt")).where(F.col("row_cnt") > 1)


def key_uniqueness(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table and key: rows, distinct keys, duplicated keys and surplus rows."""

    def summary(name: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
        per_key = df.groupBy(*key).agg(F.count("*").alias("n"))
        return per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_cnt"),
            F.count("*").alias("key_cnt"),
            F.count_if(F.col("n") > 1).alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
        ).select(F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("key_columns"), "*")

    return union_all(summary(name, df, key) for name, (df, key) in tables.items())


def null_counts(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows and nulls, from one scan."""
    names = list(columns or df.columns)
    counted = df.agg(
        F.count("*").alias("_rows"),
        *(F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(names)),
    )
    pairs = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("null_cnt"))
            for i, c in enumerate(names)
        )
    )
    return counted.select("_rows", F.explode(pairs).alias("c")).select(
        F.lit(table).alias("table_name"),
        "c.column_name",
        F.col("_rows").alias("row_cnt"),
        "c.null_cnt",
    )


def schema_conformance(df: DataFrame, table: str) -> DataFrame:
    """Per declared column: its position and type as declared and as found, and its nulls."""
    spark = df.sparkSession
    found = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(df.schema, start=1)}
    rows = []
    for i, field in enumerate(schema(table), start=1):
        position, kind = found.get(field.name, (None, None))
        expected = field.dataType.simpleString()
        rows.append(
            (i, field.name, expected, kind, position, (position, kind) == (i, expected))
        )
    declared = spark.createDataFrame(
        rows,
        "declared_position int, column_name string, declared_type string, "
        "found_type string, found_position int, conforms boolean",
    )
    present = [f.name for f in schema(table) if f.name in found]
    return declared.join(
        null_counts(df, table, present).drop("table_name"), "column_name", "left"
    ).select(F.lit(table).alias("table_name"), *declared.columns, "row_cnt", "null_cnt")


def amount_distribution(df: DataFrame, amount: str) -> DataFrame:
    """Rows, sign split, and whether the absolute amounts lean to the right.

    Shares and means are decimals computed from exact sums.
    """
    value, size = F.col(amount), F.abs(F.col(amount))
    counted = df.agg(
        F.count(value).alias("row_cnt"),
        F.count_if(value < 0).alias("negative_cnt"),
        F.sum(size).cast("decimal(38,5)").alias("abs_total"),
        F.min(size).alias("abs_min"),
        F.max(size).alias("abs_max"),
        (F.skewness(size.cast("double")) > 0).alias("is_right_skewed"),
    )
    return counted.select(
        "row_cnt",
        "negative_cnt",
        (F.col("negative_cnt") / F.col("row_cnt")).cast("decimal(9,6)").alias("negative_share"),
        "abs_total",
        "abs_min",
        "abs_max",
        "is_right_skewed",
    )


def calendar_check(calendar: DataFrame) -> DataFrame:
    """Per fiscal year: number of periods, first day, and whether both are as they should be."""
    per_year = calendar.groupBy("fiscal_year_nbr").agg(
        F.count("*").alias("period_cnt"),
        F.min("month_start_dt").alias("first_day"),
        F.max("month_end_dt").alias("last_day"),
        F.count_distinct("month_start_dt").alias("month_cnt"),
    )
    return per_year.withColumn(
        "is_valid",
        (F.col("period_cnt") == PERIODS_PER_YEAR)
        & (F.month("first_day") == FISCAL_START_MONTH)
        & (F.year("first_day") == F.col("fiscal_year_nbr")),
    )


def key_density(df: DataFrame, table: str, key: str) -> DataFrame:
    """Whether an integer key runs from its first to its last value without gap or repeat."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    counted = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_cnt"),
        F.count(F.col(key)).alias("key_cnt"),
        F.min(key).cast("bigint").alias("first_key"),
        F.max(key).cast("bigint").alias("last_key"),
    )
    width = F.col("last_key") - F.col("first_key") + 1
    return counted.select(
        F.lit(table).alias("table_name"),
        "*",
        ((F.col("row_cnt") == F.col("key_cnt")) & (F.col("key_cnt") == width)).alias("is_dense"),
    )


def node_parents(hierarchy: DataFrame, stem: str, levels: int) -> DataFrame:
    """Per level: its nodes, and how many of them lie under more than one node above."""
    pairs = F.array(
        *(
            F.struct(
                F.lit(level).alias("level"),
                F.col(f"{stem}{level}_cd").alias("node"),
                F.col(f"{stem}{level - 1}_cd").alias("parent"),
            )
            for level in range(2, levels + 1)
        )
    )
    links = hierarchy.select(F.explode(pairs).alias("p")).select("p.*").distinct()
    nodes = links.groupBy("level", "node").agg(F.count("*").alias("parents"))
    return nodes.groupBy("level").agg(
        F.count("*").alias("node_cnt"),
        F.count_if(F.col("parents") > 1).alias("split_nodes"),
    )


def file_spans(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row over the files of a saved table: rows, and per integer column its sum and the
    mean share of the column's range that a file spans."""
    per_file = df.groupBy(F.input_file_name().alias("_file")).agg(
        F.count("*").alias("_rows"),
        *(f(c).alias(f"_{f.__name__}_{c}") for c in by for f in (F.min, F.max, F.sum)),
    )
    return per_file.agg(
        F.sum("_rows").alias("row_cnt"),
        *(F.sum(f"_sum_{c}").alias(f"sum_{c}") for c in by),
        *(
            (
                F.avg(F.col(f"_max_{c}") - F.col(f"_min_{c}"))
                / F.greatest(F.max(f"_max_{c}") - F.min(f"_min_{c}"), F.lit(1))
            ).alias(f"mean_span_{c}")
            for c in by
        ),
    )


def rule_violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Per named rule, a SQL condition on one row: how many rows break it, from one scan."""
    broken = {name: ~F.coalesce(F.expr(text), F.lit(False)) for name, text in rules.items()}
    counted = df.agg(
        F.count("*").alias("_rows"), *(F.count_if(c).alias(name) for name, c in broken.items())
    )
    pairs = F.array(
        *(F.struct(F.lit(r).alias("rule"), F.col(r).alias("violations")) for r in rules)
    )
    return counted.select(F.explode(pairs).alias("r"), "_rows").select(
        "r.rule", F.col("_rows").alias("row_cnt"), "r.violations"
    )


def _key_type(tables: Mapping[str, DataFrame], relation: Relation) -> T.DataType:
    """The type that both ends of a relation are compared in."""
    child, parent = tables[relation.child], tables[relation.parent]
    ends = child.schema[relation.column].dataType, parent.schema[relation.key].dataType
    if ends[0] == ends[1]:
        return ends[0]
    texts = [isinstance(t, T.StringType) for t in ends]
    empty = child.sparkSession.createDataFrame([], "nothing int")
    try:
        if any(texts) and not all(texts):
            raise ValueError
        both = F.coalesce(*(F.lit(None).cast(t) for t in ends))
        return empty.select(both.alias("key")).schema["key"].dataType
    except (AnalysisException, ValueError) as error:
        kinds = " and ".join(t.simpleString() for t in ends)
        raise ValueError(f"{relation.name}: {kinds} can't be compared") from error


def _key_rows(df: DataFrame, keys: Sequence[tuple[int, str, T.DataType]]) -> DataFrame:
    """(relation, number, text) rows of the non-null keys: (relation, column, compared type)."""
    none = F.lit(None)
    whole = [isinstance(kind, T.IntegralType) for _, _, kind in keys]
    structs = F.array(
        *(
            F.struct(
                F.lit(relation).alias("relation"),
                (F.col(c) if number else none).cast("bigint").alias("number"),
                (none if number else F.col(c).cast(kind)).cast("string").alias("text"),
            )
            for (relation, c, kind), number in zip(keys, whole)
        )
    )
    rows = df.select(F.explode(structs).alias("k")).select("k.*")
    return rows.where("number is not null or text is not null")


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """The rows of all frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)

"""The registered queries: every operator over the driver's tables.

Row ids and table sizes come from those tables, so the work of a query grows with them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions import keys, pools
from ledgerweave.functions.calendar import (
    fiscal_calendar,
    fiscal_year,
    fiscal_year_period,
    fiscal_years_spanned,
)
from ledgerweave.functions.exprs import (
    case,
    code,
    cyclic_number,
    cyclic_pick,
    every,
    level_nodes,
    literal_array,
    nested_level_sizes,
    parent_code,
    shrinking_level_sizes,
    zero_pad,
)
from ledgerweave.functions.rng import RowRandom, from_units, log_normal_params_of, to_units
from ledgerweave.operators import agg, checks, fit, fk
from ledgerweave.operators.buckets import (
    Bucketed,
    bucketed_lookup,
    bucketed_orphans,
    save_bucketed,
)
from ledgerweave.operators.hierarchy import level_edges, node_report, parent_edges
from ledgerweave.operators.joins import Lookup, lookup, lookups
from ledgerweave.operators.refresh import (
    create_aggregate,
    refresh_aggregate,
    stored_aggregate,
)
from ledgerweave.plans.build import build, table_of
from ledgerweave.session import tune
from ledgerweave.sources.facts import income_statement_fact
from ledgerweave.sources.generate import CALENDAR, FINITE, Volumes, generate, generate_clustered
from ledgerweave.sources.schema import (
    FACTS,
    LAYOUTS,
    RELATIONS,
    TABLES,
    Relation,
    project,
    row_key,
)
from ledgerweave.sources.spec import ID, Spec, ids_from
from ledgerweave.sources.tables import (
    BYTES_PER_FILE,
    ROWS_PER_FILE,
    file_count,
    file_sizes,
    overlapping_partitions,
    read_table,
    recluster,
    recluster_appended,
    replace_partitions,
    rows_per_file,
    save_by_bytes,
    save_declared,
    save_table,
    scratch_path,
    scratch_table,
    size_files,
)

Query = Callable[[SparkSession, str], DataFrame]

SPEC = Spec(as_of=dt.date(2025, 1, 1), seed=42)
CYCLIC = replace(SPEC, style="cyclic")
#: Least rows per file of the layout that is measured, and its files before they hold more rows;
#: production files hold ROWS_PER_FILE.
SMALL_FILE, SMALL_FILES = 500, 1_200
LEDGER = "general_ledger_fact"
SUM = "decimal(38,5)"

# Which of the driver's tables supplies the row ids of a dimension: its key plus one.
DIMENSION_ROWS = {
    "accounting_document_type": ("supplier", "s_suppkey"),
    "version_forecast_mapping": ("supplier", "s_suppkey"),
    "functional_area": ("supplier", "s_suppkey"),
    "division_text": ("supplier", "s_suppkey"),
    "division_text_dim_v": ("supplier", "s_suppkey"),
    "company_code": ("supplier", "s_suppkey"),
    "finance_product_dim_v": ("part", "p_partkey"),
    "finance_customer_dim_v": ("customer", "c_custkey"),
    "copa_attribution_dim": ("part", "p_partkey"),
    "cost_center_dim_v": ("orders", "o_orderkey"),
    "profit_center": ("customer", "c_custkey"),
    "gl_account_dim": ("part", "p_partkey"),
    "gl_account_zfsm_measures_hierarchy_dim": ("supplier", "s_suppkey"),
    "gl_account_hierarchy": ("customer", "c_custkey"),
    "management_gl_account_hierarchy": ("customer", "c_custkey"),
    "geo_marketplace_channel_dim": ("supplier", "s_suppkey"),
    "geo_wholesale_value_business_dim": ("supplier", "s_suppkey"),
    "consolidation_functional_area_hierarchy": ("part", "p_partkey"),
    "consolidation_segment_hierarchy_dim": ("part", "p_partkey"),
    "segment_cost_center_hierarchy_dim_v": ("customer", "c_custkey"),
    "segment_profit_center_hierarchy": ("supplier", "s_suppkey"),
    "DisChannel_cost_center_hierarchy_dim_v": ("part", "p_partkey"),
    "DisChannel_profit_center_hierarchy": ("customer", "c_custkey"),
    "PartDisChannel_profit_center_hierarchy": ("customer", "c_custkey"),
    "retail_global_store_profile_v": ("supplier", "s_suppkey"),
}

DRIVER_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}
DRIVER_RELATIONS = (
    Relation("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Relation("lineitem", "l_partkey", "part", "p_partkey"),
    Relation("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    Relation("orders", "o_custkey", "customer", "c_custkey"),
    Relation("customer", "c_nationkey", "nation", "n_nationkey"),
    Relation("supplier", "s_nationkey", "nation", "n_nationkey"),
    Relation("nation", "n_regionkey", "region", "r_regionkey"),
    Relation("events", "user_id", "customer", "c_custkey"),
    Relation("labels", "doc_id", "documents", "doc_id"),
)
# The first part of the level columns' names, and the number of levels that are filled.
HIERARCHIES = {
    "gl_account_zfsm_measures_hierarchy_dim": ("gl_account_level_", 3),
    "gl_account_hierarchy": ("gl_account_level_", 30),
    "management_gl_account_hierarchy": ("gl_account_level_", 30),
    "consolidation_functional_area_hierarchy": ("consolidation_functional_area_", 7),
    "consolidation_segment_hierarchy_dim": ("consolidation_segment_", 10),
    "segment_cost_center_hierarchy_dim_v": ("cost_center_level_", 30),
    "segment_profit_center_hierarchy": ("profit_center_level_", 9),
    "DisChannel_cost_center_hierarchy_dim_v": ("cost_center_level_", 30),
    "DisChannel_profit_center_hierarchy": ("profit_center_level_", 9),
    "PartDisChannel_profit_center_hierarchy": ("profit_center_level_", 9),
}
# The codes of a row and of its parent.
PARENT_CODES = {
    f"consolidation_{table}": (f"consolidation_{name}_cd", f"consolidation_{name}_parent_cd")
    for table, name in (
        ("functional_area_hierarchy", "functional_area_hierarchy"),
        ("segment_hierarchy_dim", "segment_hierarchy"),
    )
}
LEDGER_RULES = {
    "period belongs to a fiscal year": "fiscal_year_period_nbr % 100 between 1 and 13",
    "one sign per row": (
        "sign(transaction_currency_amt) = sign(company_currency_amt) and "
        "sign(transaction_currency_amt) = sign(performance_management_currency_amt)"
    ),
    "company code is the company's": "company_cd = cast(1000 + company_id as string)",
    "functional area code is the area's": (
        "Functional_Area_cd = concat('FA', lpad(cast(functional_area_id as string), 4, '0'))"
    ),
    "profit center number is the center's": "cast(profit_center_nbr as bigint) = profit_center_id",
    "returns are within sales": "returns_qty between 0 and sales_qty * 0.08 + 0.00001",
    "exchange rates exist": (
        "etm_foreign_currency_exchange_rate_id between 1 and 90 and "
        "gaap_foreign_currency_exchange_rate_id between 1 and 90"
    ),
    "amount is within its class": "abs(transaction_currency_amt) between 1000 and 50000000",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: read(spark, sf_dir, name) for name in DRIVER_KEYS}


def volumes(spark: SparkSession, sf_dir: str) -> Volumes:
    """A ledger as large as orders, with the products, customers and companies of the data.

    One job reads the three counts and the span of the order dates: four rows come back.
    """
    sources = {
        "finance_product_dim_v": "part",
        "finance_customer_dim_v": "customer",
        "company_code": "supplier",
        LEDGER: "orders",
    }
    none = F.lit(None).cast("int")
    sized = checks.union_all(
        read(spark, sf_dir, source).agg(
            F.lit(table).alias("table_name"),
            F.count("*").alias("row_cnt"),
            (fiscal_year(F.min("o_orderdate")) if table == LEDGER else none).alias("first"),
            (fiscal_year(F.max("o_orderdate")) if table == LEDGER else none).alias("last"),
        )
        for table, source in sources.items()
    )
    found = {row["table_name"]: row for row in sized.collect()}
    orders = found.pop(LEDGER)
    return Volumes(
        ledger_rows=orders["row_cnt"],
        first_fiscal_year=orders["first"],
        last_fiscal_year=orders["last"],
        rows={table: row["row_cnt"] for table, row in found.items()},
    )


def ledger(spark: SparkSession, sf_dir: str, sized: Volumes | None = None) -> DataFrame:
    """One ledger row per order."""
    ids = ids_from(read(spark, sf_dir, "orders"), F.col("o_orderkey"))
    return generate(spark, LEDGER, sized or volumes(spark, sf_dir), SPEC, ids=ids)


def with_parents(
    spark: SparkSession, sf_dir: str, *tables: str
) -> tuple[DataFrame, list[DataFrame]]:
    """The ledger, and its parents in the same volumes."""
    sized = volumes(spark, sf_dir)
    parents = [generate(spark, table, sized, SPEC) for table in tables]
    return ledger(spark, sf_dir, sized), parents


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids_from(read(spark, sf_dir, "events"), F.col("event_id"))


# -- value expressions -------------------------------------------------------------------


def cyclic_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col(ID)
    return event_rows(spark, sf_dir).select(
        i.alias("event_id"),
        cyclic_pick(pools.REGIONS, i).alias("region"),
        cyclic_pick(pools.COUNTRIES, i).alias("country"),
        cyclic_pick(pools.SILHOUETTES, i - 1).alias("silhouette"),
    )


def weighted_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    random = RowRandom(ID)
    return event_rows(spark, sf_dir).select(
        F.col(ID).alias("event_id"),
        random.weighted("currency", pools.CURRENCIES, pools.CURRENCY_WEIGHTS).alias("currency"),
        random.weighted("brand", pools.BRANDS, pools.BRAND_WEIGHTS).alias("brand"),
        random.weighted("gender", pools.GENDERS, pools.GENDER_WEIGHTS).alias("gender"),
        random.pick("platform", pools.PLATFORMS).alias("platform"),
    )


def threshold_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_rows(spark, sf_dir)
    position = keys.account_class_index(F.col(ID))
    return events.select(
        F.col(ID).alias("event_id"),
        keys.of_class(position, [c.name for c in pools.ACCOUNT_CLASSES]).alias("category"),
        keys.account_number(F.col(ID), position).cast("string").alias("account_nbr"),
    )


def keyed_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col(ID)
    status = case(
        (
            (F.pmod(i, F.lit(15)) == 0, F.lit("CLOSED")),
            (F.pmod(i, F.lit(20)) == 0, F.lit("TEMP_CLOSED")),
        ),
        F.lit("OPEN"),
    )
    return event_rows(spark, sf_dir).select(
        i.alias("event_id"),
        every(i, 20, "N", "Y").alias("active_ind"),
        every(i, 5, 1, 0).cast("int").alias("etm_ind"),
        every(i, 3, "X", "").alias("revenue_ind"),
        status.alias("status_cd"),
        keys.gl_account_nbr(i, "cyclic").alias("account_nbr"),
    )


def formatted_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col(ID)
    return event_rows(spark, sf_dir).select(
        i.alias("event_id"),
        keys.profit_center_nbr(i).alias("profit_center_nbr"),
        keys.cost_center_nbr(i).alias("cost_center_nbr"),
        keys.customer_nbr(i).alias("customer_nbr"),
        keys.functional_area_cd(cyclic_number(i, 150, 1)).alias("functional_area_cd"),
        keys.statement_item_cd(cyclic_number(i, 500, 1)).alias("item_cd"),
        code("STY", cyclic_number(i, 900_000, 100_000), 6).alias("style_nbr"),
        zero_pad(i, 2).alias("short_nbr"),
    )


def uniform_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    random = RowRandom(ID)
    return event_rows(spark, sf_dir).select(
        F.col(ID).alias("event_id"),
        random.decimal("qty", 0, 50_000).alias("qty"),
        random.decimal("price", 1, 100_000).alias("price"),
    )


def lognormal_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    random = RowRandom(ID)
    amounts = {
        name: from_units(to_units(random.log_normal(name, p.mean, p.std_dev))).alias(f"{name}_amt")
        for name, p in pools.AMOUNTS.items()
    }
    return event_rows(spark, sf_dir).select(F.col(ID).alias("event_id"), *amounts.values())


def signed_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign flips, correlated amounts and dependent quantities."""
    random = RowRandom(ID)
    drawn = event_rows(spark, sf_dir).select(
        F.col(ID).alias("event_id"),
        random.sign("sign", pools.NEGATIVE_SHARE).alias("sign"),
        F.floor(random.between("base", 1_000, 5_000_000) * 1e5 + 0.5).alias("base"),
        random.between("company", 0.85, 1.15).alias("factor"),
        F.floor(random.between("sales", *pools.SALES_QTY_RANGE) * 1e5 + 0.5).alias("sales"),
        (random.uniform("returns") * pools.RETURNS_RATIO).alias("returned"),
    )
    scaled = F.expr("floor(base * factor + 0.5)")
    return drawn.select(
        "event_id",
        from_units(F.col("sign") * F.col("base")).alias("amt"),
        from_units(F.col("sign") * scaled).alias("company_amt"),
        from_units(F.col("sign") * F.floor(F.col("base") * 0.92 + 0.5)).alias("group_amt"),
        from_units(F.col("sales")).alias("sales_qty"),
        from_units(F.expr("floor(sales * returned + 0.5)")).alias("returns_qty"),
    )


def random_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    random = RowRandom(ID)
    return event_rows(spark, sf_dir).select(
        F.col(ID).alias("event_id"),
        random.date("posted", "2019-06-01", "2026-06-01").alias("posted_dt"),
    )


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    random = RowRandom(ID)
    created, updated = random.audit_dates("audit", *pools.AUDIT_WINDOW, pools.AUDIT_UPDATE_SHARE)
    return event_rows(spark, sf_dir).select(
        F.col(ID).alias("event_id"),
        created.alias("created_dt"),
        updated.alias("updated_dt"),
        cyclic_pick(pools.AUDIT_USERS, F.col(ID)).alias("created_by_user_id"),
        random.weighted("source", pools.AUDIT_SOURCES, pools.AUDIT_SOURCE_WEIGHTS).alias(
            "physical_source_cd"
        ),
    )


def hierarchy_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested and shrinking levels side by side, and parent codes."""
    customers = read(spark, sf_dir, "customer")
    n = customers.count()
    i = F.col(ID)
    nested = level_nodes(i, nested_level_sizes(n, 9, 5))
    shrinking = level_nodes(i, shrinking_level_sizes(n, 7, 5, plus=1))
    return ids_from(customers, F.col("c_custkey") + 1).select(
        i.alias("node_id"),
        parent_code(i, "FA", 4).alias("parent_cd"),
        *(code(f"PCL{k}_", node).alias(f"level_{k}_cd") for k, node in enumerate(nested, 1)),
        *(code(f"CFA{k}_", node).alias(f"area_{k}_cd") for k, node in enumerate(shrinking, 1)),
    )


def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies, concatenations, constants, typed nulls, renames and caller-supplied columns."""
    i = F.col(ID)
    extra: dict[str, Callable[[Column], Column]] = {
        "controlling_area_cd": lambda _: F.lit("1000"),
        "hierarchy_nm": lambda key: code("Hierarchy ", key),
    }
    platform = cyclic_pick(pools.PLATFORMS, i)
    return (
        event_rows(spark, sf_dir)
        .select(
            i.alias("event_id"),
            platform.alias("platform"),
            F.concat(platform, F.lit(" - Sub")).alias("sub_focus"),
            F.substring(platform, 1, 2).alias("platform_cd"),
            F.lit(dt.date(2015, 1, 1)).alias("begin_effective_dt"),
            F.lit(SPEC.as_of).alias("load_dt"),
            F.lit(None).cast("string").alias("cost_component_calc"),
            F.lit(None).cast("int").alias("store_score"),
        )
        .withColumns({name: of_key(F.col("event_id")) for name, of_key in extra.items()})
    )


# -- dimensions and facts ----------------------------------------------------------------


def dimension_query(table: str, spec: Spec = SPEC) -> Query:
    source, key = DIMENSION_ROWS[table]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = read(spark, sf_dir, source)
        sized = Volumes(rows={table: rows.count()})
        return generate(spark, table, sized, spec, ids=ids_from(rows, F.col(key) + 1))

    return query


def geo_security(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each security role, and the ledger rows and amount of its region."""
    rows, (roles, centers) = with_parents(
        spark, sf_dir, "atscale_geo_security", "profit_center"
    )
    rows = lookup(
        rows,
        centers,
        ("profit_center_id", "profit_center_id"),
        ["geography_nm"],
        "general_ledger_fact_id",
    )
    visible = rows.groupBy("geography_nm").agg(
        F.count("*").alias("ledger_rows"), F.sum("transaction_currency_amt").alias("amt")
    )
    return roles.join(visible, roles["region"] == visible["geography_nm"], "left").select(
        "region",
        "role",
        F.coalesce("ledger_rows", F.lit(0)).alias("ledger_rows"),
        F.coalesce(F.col("amt"), F.lit(0)).cast(SUM).alias("transaction_currency_amt"),
    )


def exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each exchange rate, and how many ledger rows refer to it."""
    key = "finance_foreign_currency_exchange_rate_id"
    rows, (rates,) = with_parents(spark, sf_dir, "finance_foreign_currency_exchange_rate")
    used = rows.groupBy(F.col("etm_foreign_currency_exchange_rate_id").alias(key)).agg(
        F.count("*").alias("ledger_rows")
    )
    return rates.join(used, key, "left").fillna(0, ["ledger_rows"])


def orders_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fiscal calendar of the years that orders span."""
    orders = read(spark, sf_dir, "orders")
    first = orders.agg(fiscal_year(F.min("o_orderdate"))).scalar()
    return fiscal_calendar(fiscal_years_spanned(orders, "o_orderdate"), first)


def income_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One income-statement row per event."""
    sized = volumes(spark, sf_dir)
    return generate(spark, "CIS_fact", sized, SPEC, ids=event_rows(spark, sf_dir))


def income_statement_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed totals per account class sign, with debits negated."""
    parents = volumes(spark, sf_dir).parents()
    rows = income_statement_fact(
        event_rows(spark, sf_dir), SPEC, parents, adjust_by_account=True
    )
    return rows.groupBy("fiscal_yr", "version_group_nm").agg(
        F.count("*").alias("row_cnt"),
        F.sum("transaction_currency_amt").cast(SUM).alias("amt"),
        F.sum("sign_adjusted_transaction_currency_amt").cast(SUM).alias("adjusted_amt"),
        F.sum("sign_adjusted_qty").cast(SUM).alias("adjusted_qty"),
    )


def balance_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One balance-sheet row per order."""
    ids = ids_from(read(spark, sf_dir, "orders"), F.col("o_orderkey"))
    table = "consolidated_balance_sheet_fact"
    return generate(spark, table, volumes(spark, sf_dir), SPEC, ids=ids)


# -- foreign keys ------------------------------------------------------------------------


def fk_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product and a customer for every order by arithmetic, drawn and cyclic."""
    products = read(spark, sf_dir, "part").count()
    customers = read(spark, sf_dir, "customer").count()
    random = RowRandom("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        fk.dense_key(random, "product_id", products).alias("product_id"),
        fk.dense_key(random, "customer_id", customers).alias("customer_id"),
        fk.dense_key(random, "product_id", products, cyclic=True).alias("cyclic_product_id"),
    )


def fk_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are formulas of a dense id, and codes that follow from an assigned key."""
    random = RowRandom("o_orderkey")
    assigned = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        fk.dense_key(random, "account", 8_000).alias("account"),
        fk.dense_key(random, "center", 15_000).alias("center"),
        fk.dense_key(random, "document", 40).alias("document"),
        fk.dense_key(random, "company", 80).alias("company"),
        fk.dense_key(random, "version", 25).alias("version"),
    )
    return assigned.select(
        "o_orderkey",
        keys.gl_account_nbr(F.col("account")).alias("gl_account_nbr"),
        keys.cost_center_nbr(F.col("center")).alias("cost_center_nbr"),
        keys.document_type_cd(F.col("document")).alias("document_type_cd"),
        keys.company_cd(F.col("company")).alias("company_cd"),
        keys.company_currency(F.col("company")).alias("company_currency_cd"),
        keys.version_nbr(F.col("version")).alias("version_nbr"),
        keys.version_group(F.col("version")).alias("version_group_nm"),
        cyclic_pick(pools.STATEMENT_CURRENCIES, F.col("center")).alias("center_currency_cd"),
    )


def fk_ordinal_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part for every order from a parent whose keys have gaps."""
    parts = read(spark, sf_dir, "part").where("p_size < 40").select("p_partkey")
    orders = read(spark, sf_dir, "orders").select("o_orderkey")
    random = RowRandom("o_orderkey")
    return fk.assign_parent_key(orders, parts, "p_partkey", random, "part", "part_key")


def fk_literal_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value for every event from a driver-side list, by joining it as a table."""
    values = fk.literal_table(spark, pools.SECURITY_REGIONS)
    events = event_rows(spark, sf_dir)
    position = cyclic_number(F.col(ID), len(pools.SECURITY_REGIONS))
    joined = events.withColumn("position", position).join(values, "position")
    return joined.select(F.col(ID).alias("event_id"), F.col("value").alias("region"))


def distinct_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fk.distinct_values(read(spark, sf_dir, "lineitem"), "l_partkey")


def fiscal_years_shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fiscal years of the shipping dates' periods."""
    lines = read(spark, sf_dir, "lineitem")
    periods = lines.select(fiscal_year_period(F.col("l_shipdate")).alias("period"))
    return fk.fiscal_years_in(periods, "period")


# -- fiscal attribution and the aggregate ------------------------------------------------


def orders_fiscal_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its fiscal period, quarter and season: an equi-join on the period."""
    periods = orders_calendar(spark, sf_dir).select(
        "fiscal_year_period_nbr",
        "fiscal_year_period_cd",
        "fiscal_year_quarter_cd",
        "season_alternate_period_cd",
    )
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", fiscal_year_period(F.col("o_orderdate")).alias("fiscal_year_period_nbr")
    )
    return orders.join(periods, "fiscal_year_period_nbr", "left")


def orders_by_quarter_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drawn amount per order, by fiscal quarter and the region of a drawn profit center.

    The orders are summed per period and profit center first, so both joins see only
    partial sums and one shuffle carries them.
    """
    random = RowRandom("o_orderkey")
    p = pools.AMOUNTS["revenue"]
    amount = F.floor(random.log_normal("amount", p.mean, p.std_dev) * 1e5 + 0.5)
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        fiscal_year_period(F.col("o_orderdate")).alias("fiscal_year_period_nbr"),
        fk.dense_key(random, "profit_center", 2_000).alias("profit_center_id"),
        from_units(random.sign("sign", pools.NEGATIVE_SHARE) * amount).alias("amt"),
    )
    summed = rows.groupBy("fiscal_year_period_nbr", "profit_center_id").agg(
        F.count("*").alias("row_cnt"), F.sum("amt").alias("amt")
    )
    quarters = orders_calendar(spark, sf_dir).select(
        "fiscal_year_period_nbr", "fiscal_year_quarter_cd"
    )
    centers = generate(spark, "profit_center", Volumes(), SPEC)
    centers = centers.select("profit_center_id", "geography_nm")
    return (
        summed.join(quarters, "fiscal_year_period_nbr")
        .join(centers, "profit_center_id")
        .groupBy("fiscal_year_quarter_cd", "geography_nm")
        .agg(F.sum("row_cnt").alias("row_cnt"), F.sum("amt").cast(SUM).alias("amt"))
    )


def aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, (accounts,) = with_parents(spark, sf_dir, "gl_account_dim")
    return agg.ledger_aggregate(rows, accounts)


def aggregate_described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate with the descriptions of its keys."""
    rows, (accounts, *parents) = with_parents(
        spark,
        sf_dir,
        "gl_account_dim",
        CALENDAR,
        "company_code",
        "profit_center",
        "division_text",
        "version_forecast_mapping",
    )
    return agg.describe(agg.ledger_aggregate(rows, accounts), *parents)


def aggregate_by_quarter_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate summed to fiscal quarter, region and account class."""
    rows, (accounts, calendar, centers) = with_parents(
        spark, sf_dir, "gl_account_dim", CALENDAR, "profit_center"
    )
    by = ["fiscal_year_period_nbr", "profit_center_id", "account_class"]
    summed = agg.roll_up(agg.ledger_aggregate(rows, accounts), by)
    summed = summed.withColumn("_row", F.xxhash64(*by))
    steps = [
        Lookup(parent, key, key, [column])
        for parent, key, column in (
            (calendar, "fiscal_year_period_nbr", "fiscal_year_quarter_cd"),
            (centers, "profit_center_id", "geography_nm"),
        )
    ]
    summed = lookups(summed, steps, "_row")
    return agg.roll_up(summed, ["fiscal_year_quarter_cd", "geography_nm", "account_class"])


LEDGER_DIMENSIONS = {
    "fiscal_year": "cast(floor(fiscal_year_period_nbr / 100) as int)",
    "fiscal_quarter": (
        "cast(floor(fiscal_year_period_nbr / 100) * 10"
        " + ceil((fiscal_year_period_nbr % 100) * 4 / 13) as int)"
    ),
    "company_cd": "company_cd",
    **{column: column for column in agg.GRAIN},
}
LEDGER_RETURN_RATE = (
    "cast(cast(sum(returns_qty) as double) / cast(sum(sales_qty) as double) as decimal(9,6))"
)


def measure_view(rows: DataFrame, accounts: DataFrame) -> agg.MeasureView:
    return agg.MeasureView(
        agg.with_account_class(rows, accounts),
        LEDGER_DIMENSIONS,
        measures={
            **{a: f"cast(sum({a}) as {agg.SUM_TYPE})" for a in agg.AMOUNTS},
            "row_cnt": "count(*)",
            "negative_share": (
                "cast(count_if(transaction_currency_amt < 0) / count(*) as decimal(9,6))"
            ),
            "return_rate": LEDGER_RETURN_RATE,
        },
    )


def stored_view(aggregate: DataFrame) -> agg.MeasureView:
    """What follows from the stored aggregate: a share of rows by sign doesn't."""
    dimensions = dict(LEDGER_DIMENSIONS)
    del dimensions["company_cd"]
    return agg.MeasureView(
        aggregate,
        dimensions,
        measures={
            **{a: f"cast(sum({a}) as {agg.SUM_TYPE})" for a in agg.AMOUNTS},
            "row_cnt": "cast(sum(row_cnt) as bigint)",
            "return_rate": LEDGER_RETURN_RATE,
        },
    )


def measures_from_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures whose dimensions and condition the stored aggregate holds, answered from it."""
    path = scratch_path(spark, "aggregate")
    rows, (accounts,) = with_parents(spark, sf_dir, "gl_account_dim")
    create_aggregate(rows, accounts, path)
    routed = agg.RoutedView(
        measure_view(rows, accounts), stored_view(stored_aggregate(spark, path))
    )
    return routed.query(
        by=["fiscal_quarter", "account_class"],
        measures=["transaction_currency_amt", "sales_qty", "row_cnt", "return_rate"],
        where="company_id <= 5 and account_class <> 'Tax'",
    )


def aggregate_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored aggregate after a first build and two appends, each a third of the orders."""
    sized = volumes(spark, sf_dir)
    accounts = generate(spark, "gl_account_dim", sized, SPEC)
    ids = ids_from(read(spark, sf_dir, "orders"), F.col("o_orderkey"))
    last = ids.agg(F.max(ID)).first()[0] or 0
    path = scratch_path(spark, "aggregate")
    for batch in range(3):
        low, high = last * batch // 3, last * (batch + 1) // 3
        part = ids.where(F.col(ID).between(low + (batch > 0), high))
        rows = generate(spark, LEDGER, sized, SPEC, ids=part)
        if batch == 0:
            create_aggregate(rows, accounts, path)
        else:
            refresh_aggregate(spark, path, rows, accounts, batch)
    return stored_aggregate(spark, path)


def measures_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, (accounts,) = with_parents(spark, sf_dir, "gl_account_dim")
    return measure_view(rows, accounts).query(
        by=["fiscal_quarter", "account_class"],
        measures=["transaction_currency_amt", "sales_qty", "row_cnt", "negative_share"],
        where="general_ledger_fact_ind = 'Y'",
    )


def measures_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same measures reached through SQL on a temporary view."""
    rows, (accounts,) = with_parents(spark, sf_dir, "gl_account_dim")
    measure_view(rows, accounts).create_view(
        "ledger_measures", ["fiscal_year", "company_cd"], ["company_currency_amt", "return_rate"]
    )
    return spark.sql(
        "select company_cd, fiscal_year, company_currency_amt, return_rate "
        "from ledger_measures where company_currency_amt > 0"
    )


def aggregate_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored aggregate against the same measures on demand."""
    columns = [*agg.GRAIN, *agg.AMOUNTS, "row_cnt"]
    path = scratch_path(spark, "aggregate")
    rows, (accounts,) = with_parents(spark, sf_dir, "gl_account_dim")
    save_table(agg.ledger_aggregate(rows, accounts).select(*columns), path)
    on_demand = measure_view(rows, accounts).query(agg.GRAIN, [*agg.AMOUNTS, "row_cnt"])
    return agg.reconcile(read_table(spark, path), on_demand.select(*columns))


def ledger_in_dollars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger amounts converted to US dollars at the month-end rate, by currency and year.

    Sums per currency and period come first: the rate is the same for all of their rows.
    """
    rows, (rates,) = with_parents(spark, sf_dir, "finance_foreign_currency_exchange_rate")
    summed = rows.groupBy(
        F.col("transaction_currency_cd").alias("from_currency_cd"),
        F.floor(F.col("fiscal_year_period_nbr") / 100).cast("int").alias("fiscal_year"),
    ).agg(F.count("*").alias("row_cnt"), F.sum("transaction_currency_amt").alias("amt"))
    return in_dollars(summed, rates)


def in_dollars(summed: DataFrame, rates: DataFrame) -> DataFrame:
    """Sums per currency and year with their value at the month-end rate."""
    rates = rates.where("exchange_rate_cd = 'P' and to_currency_cd = 'USD'").select(
        "from_currency_cd", F.col("exchange_rate").cast("decimal(10,8)")
    )
    return summed.join(rates, "from_currency_cd", "left").select(
        "from_currency_cd",
        "fiscal_year",
        "row_cnt",
        F.col("amt").cast(SUM).alias("amt"),
        # Whole sums of 22 digits before the point: the product keeps all of its 13 decimals.
        (F.col("amt").cast("decimal(27,5)") * F.col("exchange_rate"))
        .cast("decimal(32,4)")
        .alias("usd_amt"),
    )


def events_with_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its customer's market segment; hot users are split if there are any."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    customers = read(spark, sf_dir, "customer")
    return lookup(events, customers, ("user_id", "c_custkey"), ["c_mktsegment"], "event_id")


def bucketed(
    spark: SparkSession, child: DataFrame, parent: DataFrame, on: tuple[str, str], row_id: str
) -> Bucketed:
    """A child and its parent in buckets of the key, as many as the child has tasks' worth."""
    names = scratch_table("child"), scratch_table("parent")
    return save_bucketed(child, parent, on, row_id, names, file_count(child.count()))


def events_with_segment_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its customer's market segment, joined bucket by bucket."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    saved = bucketed(spark, events, customers, ("user_id", "c_custkey"), "event_id")
    return bucketed_lookup(spark, saved, ["c_mktsegment"])


def orphans_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of line items that aren't among the smaller parts, counted where the items lie."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = read(spark, sf_dir, "part").where("p_size < 40").select("p_partkey")
    lines = lines.withColumn("line", F.xxhash64("l_orderkey", "l_linenumber"))
    saved = bucketed(spark, lines, parts, ("l_partkey", "p_partkey"), "line")
    return bucketed_orphans(spark, saved)


def aggregate_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate of a ledger that lies in the buckets of its accounts."""
    rows, (accounts,) = with_parents(spark, sf_dir, "gl_account_dim")
    used = rows.select(agg.LEDGER_KEY, "gl_account_nbr", *agg.GRAIN[:-1], *agg.AMOUNTS)
    key = "gl_account_nbr"
    saved = bucketed(spark, used, agg.account_class(accounts), (key, key), agg.LEDGER_KEY)
    return agg.sum_to_grain(bucketed_lookup(spark, saved, ["account_class"]))


# -- checks ------------------------------------------------------------------------------


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.row_counts(read_all(spark, sf_dir))


def orphans_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.orphan_report(read_all(spark, sf_dir), DRIVER_RELATIONS)


def orphans_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared relations of the ledger made from orders."""
    parents = [r.parent for r in RELATIONS]
    rows, tables = with_parents(spark, sf_dir, *parents)
    return checks.orphan_report({LEDGER: rows, **dict(zip(parents, tables))}, RELATIONS)


def orphans_filtered_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").where("p_size < 40")
    return checks.orphan_keys(read(spark, sf_dir, "lineitem"), "l_partkey", parts, "p_partkey")


def duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = read_all(spark, sf_dir)
    return checks.key_uniqueness({t: (tables[t], key) for t, key in DRIVER_KEYS.items()})


def statement_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The income statement's declared key against the one that identifies its rows."""
    rows = income_statement(spark, sf_dir)
    return checks.key_uniqueness(
        {
            "declared": (rows, ["gl_account_id"]),
            "row": (rows, ["consolidated_income_statement_fact_id"]),
        }
    )


def key_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    single = {t: k[0] for t, k in DRIVER_KEYS.items() if len(k) == 1}
    return checks.union_all(
        checks.key_density(read(spark, sf_dir, t), t, k) for t, k in single.items()
    )


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = read_all(spark, sf_dir) | {LEDGER: ledger(spark, sf_dir)}
    return checks.union_all(checks.null_counts(df, t) for t, df in tables.items())


def declared_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All declared tables: dimensions on the ids of the given tables, facts per order, event
    and order."""
    sized = volumes(spark, sf_dir)
    tables = {t: dimension_query(t)(spark, sf_dir) for t in DIMENSION_ROWS}
    for table in (CALENDAR, *FINITE):
        tables[table] = generate(spark, table, sized, SPEC)
    tables[LEDGER] = ledger(spark, sf_dir, sized)
    tables["CIS_fact"] = income_statement(spark, sf_dir)
    tables["consolidated_balance_sheet_fact"] = balance_sheet(spark, sf_dir)
    return tables


def schema_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared column of all 31 tables as it comes out of its generator."""
    tables = declared_tables(spark, sf_dir)
    return checks.union_all(checks.schema_conformance(tables[t], t) for t in TABLES)


def conformed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers brought into a declared schema: names, order and types."""
    customers = read(spark, sf_dir, "customer")
    return project(
        customers,
        "company_code",
        {
            "company_id": F.col("c_custkey"),
            "company_cd": F.col("c_nationkey"),
            "company_nm": F.col("c_name"),
            "currency_cd": keys.company_currency(F.col("c_custkey") + 1),
            "created_by_user_id": "ETL_SERVICE",
            "updated_by_user_id": "ETL_SERVICE",
        },
        nulls=("physical_source_cd",),
    )


def amount_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.amount_distribution(ledger(spark, sf_dir), "transaction_currency_amt")


def declared_weights_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chi-square of the ledger's picks against their weights, and against wrong ones."""
    sized = replace(volumes(spark, sf_dir), periods="weighted")
    rows = ledger(spark, sf_dir, sized)
    currency, negative = F.col("transaction_currency_cd"), F.col("transaction_currency_amt") < 0
    period = F.col("fiscal_year_period_nbr") % 100
    declared = {
        "currency": (currency, dict(zip(pools.CURRENCIES, pools.CURRENCY_WEIGHTS))),
        "sign": (negative, {True: pools.NEGATIVE_SHARE, False: 1 - pools.NEGATIVE_SHARE}),
        "period": (period, dict(enumerate(pools.PERIOD_WEIGHTS, start=1))),
        "currency, all alike": (currency, dict.fromkeys(pools.CURRENCIES, 1)),
        "currency, one missing": (currency, dict(zip(pools.CURRENCIES[1:], pools.CURRENCY_WEIGHTS[1:]))),
    }
    return checks.union_all(
        fit.weight_fit(rows, column, weights)
        .withColumn("chi_square", F.col("chi_square").cast("decimal(18,6)"))
        .withColumn("declaration", F.lit(name))
        for name, (column, weights) in declared.items()
    )


def declared_amounts_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of each account class's amounts from its log-normal, and from a shifted one."""
    step = 100_000
    labels = [""] * (max(c.end for c in pools.ACCOUNT_CLASSES) // step + 1)
    for c in pools.ACCOUNT_CLASSES:
        slots = range(c.start // step, c.end // step + 1)
        labels[slots.start : slots.stop] = [c.label] * len(slots)
    number = F.pmod(F.col("gl_account_nbr").cast("bigint"), F.lit(keys.ROUND))
    by = F.get(literal_array(labels), F.floor(number / step).cast("int"))
    amounts = {c.label: pools.AMOUNTS[c.amounts] for c in pools.ACCOUNT_CLASSES}
    rows, amount = ledger(spark, sf_dir), F.col("transaction_currency_amt")

    def shifted(shift: float) -> dict[str, tuple[float, float, float, float]]:
        params = {label: (*log_normal_params_of(a), a.low, a.high) for label, a in amounts.items()}
        return {label: (mu + shift, *rest) for label, (mu, *rest) in params.items()}

    return checks.union_all(
        fit.log_normal_fit(rows, amount, by, shifted(shift)).select(
            F.col("grp").alias("account_class"),
            F.lit(shift).alias("shift"),
            "row_cnt",
            "outside_cnt",
            F.col("distance").cast("decimal(18,9)").alias("distance"),
            "fits",
        )
        for shift in (0.0, 0.5)
    )


def calendar_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.calendar_check(orders_calendar(spark, sf_dir))


def hierarchy_nesting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with more than one parent, on each level of the ten hierarchies."""
    return checks.union_all(
        checks.node_parents(dimension_query(table)(spark, sf_dir), stem, levels).withColumn(
            "table_name", F.lit(table)
        )
        for table, (stem, levels) in HIERARCHIES.items()
    )


def hierarchy_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consolidation hierarchies' nodes, by parent codes and by levels: depth, ancestors."""
    edges = []
    for table, (child, parent) in PARENT_CODES.items():
        rows = dimension_query(table)(spark, sf_dir)
        edges.append(parent_edges(rows, f"{table} parents", child, parent))
        edges.append(level_edges(rows, f"{table} levels", *HIERARCHIES[table]))
    return node_report(checks.union_all(edges))


def cyclic_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger row per order with every pick and key by row number."""
    ids = ids_from(read(spark, sf_dir, "orders"), F.col("o_orderkey"))
    return generate(spark, LEDGER, volumes(spark, sf_dir), CYCLIC, ids=ids)


def cyclic_income_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One income-statement row per event with every key by row number."""
    sized = volumes(spark, sf_dir)
    return generate(spark, "CIS_fact", sized, CYCLIC, ids=event_rows(spark, sf_dir))


def cyclic_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account dimension by row number, an account per part."""
    return dimension_query("gl_account_dim", CYCLIC)(spark, sf_dir)


def cyclic_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension by row number: its channel is a weighted pick."""
    return dimension_query("finance_customer_dim_v", CYCLIC)(spark, sf_dir)


def weighted_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and amount per period of a ledger whose periods are drawn by weight."""
    sized = replace(volumes(spark, sf_dir), periods="weighted")
    return ledger(spark, sf_dir, sized).groupBy("fiscal_year_period_nbr").agg(
        F.count("*").alias("row_cnt"), F.sum("transaction_currency_amt").cast(SUM).alias("amt")
    )


def ledger_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.rule_violations(ledger(spark, sf_dir), LEDGER_RULES)


# -- layout and builds -------------------------------------------------------------------


def partitioned_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger written by period, clustered, read back and summed per period."""
    path = scratch_path(spark, LEDGER)
    ids = ids_from(read(spark, sf_dir, "orders"), F.col("o_orderkey"))
    rows = generate_clustered(spark, LEDGER, volumes(spark, sf_dir), SPEC, ids)
    save_declared(rows, LEDGER, path, already_partitioned=True)
    return (
        read_table(spark, path)
        .groupBy("fiscal_year_period_nbr")
        .agg(
            F.count("*").alias("row_cnt"),
            F.sum("transaction_currency_amt").cast(SUM).alias("amt"),
            F.min("gl_account_nbr").alias("first_account"),
        )
    )


def files_of(saved: DataFrame) -> DataFrame:
    """Each period's files."""
    return saved.select("fiscal_year_period_nbr", F.input_file_name().alias("file")).distinct()


def period_totals(spark: SparkSession, path: str, before: DataFrame) -> DataFrame:
    """Totals of each period, and whether it has the files that it had before."""
    saved = read_table(spark, path)
    tagged = before.withColumn("side", F.lit(1)).unionAll(
        files_of(saved).withColumn("side", F.lit(-1))
    )
    kept = (
        tagged.groupBy("fiscal_year_period_nbr", "file")
        .agg(F.sum("side").alias("side"))
        .groupBy("fiscal_year_period_nbr")
        .agg((F.max(F.abs("side")) == 0).alias("files_kept"))
    )
    totals = saved.groupBy("fiscal_year_period_nbr").agg(
        F.count("*").alias("row_cnt"), F.sum("transaction_currency_amt").cast(SUM).alias("amt")
    )
    return totals.join(kept, "fiscal_year_period_nbr")


def saved_files(spark: SparkSession, path: str) -> DataFrame:
    """The files of a saved ledger as they are now."""
    before = scratch_path(spark, "files")
    save_table(files_of(read_table(spark, path)), before)
    return read_table(spark, before)


def replaced_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last fiscal year's periods restated at twice their amounts, in place."""
    path = scratch_path(spark, LEDGER)
    sized = volumes(spark, sf_dir)
    save_declared(ledger(spark, sf_dir, sized), LEDGER, path, sized.ledger_rows)
    before = saved_files(spark, path)
    doubled = (F.col("transaction_currency_amt") * 2).cast("decimal(28,5)")
    year = F.floor(F.col("fiscal_year_period_nbr") / 100)
    last = read_table(spark, path).agg(F.max(year)).first()[0]
    restated = read_table(spark, path).where(year == last)
    restated = restated.withColumn("transaction_currency_amt", doubled)
    replace_partitions(spark, restated, path, LAYOUTS[LEDGER], row_key(LEDGER))
    return period_totals(spark, path, before)


def reclustered_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger that gets the last fiscal year's later rows by an append, clustered again there.

    Per period its totals, whether files overlap afterwards, whether its files stayed unless
    they overlapped, and whether only that year's did.
    """
    path = scratch_path(spark, LEDGER)
    sized = volumes(spark, sf_dir)
    rows = ledger(spark, sf_dir, sized)
    late = (F.floor(F.col("fiscal_year_period_nbr") / 100) == sized.last_fiscal_year) & (
        F.col(row_key(LEDGER)) > sized.ledger_rows // 2
    )
    save_declared(rows.where(~late), LEDGER, path, sized.ledger_rows)
    save_declared(rows.where(late), LEDGER, path, sized.ledger_rows, mode="append")
    before = saved_files(spark, path)
    layout = LAYOUTS[LEDGER]
    period = F.col("fiscal_year_period_nbr")
    crossed = period.isin(recluster_appended(spark, path, layout, row_key(LEDGER)))
    left = overlapping_partitions(
        read_table(spark, path), layout.partition_by[0], layout.cluster_by[0]
    )
    return period_totals(spark, path, before).select(
        "fiscal_year_period_nbr",
        "row_cnt",
        "amt",
        period.isin(left).alias("overlapping"),
        (F.col("files_kept") == ~crossed).alias("as_needed"),
        (~crossed | (F.floor(period / 100) == sized.last_fiscal_year)).alias("late_only"),
    )


def sized_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events spread over the files they need, appended twice and counted back."""
    path = scratch_path(spark, "events")
    events = read(spark, sf_dir, "events").select("event_id", "event_type")
    rows = events.count()
    sized = size_files(events, rows, ROWS_PER_FILE)
    save_table(sized, path)
    save_table(sized, path, mode="append")
    return read_table(spark, path).groupBy("event_type").agg(
        F.count("*").alias("row_cnt"), F.count_distinct("event_id").alias("event_cnt")
    )


def files_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrow and a wide table written in files of an eighth of their bytes, BYTES_PER_FILE at
    most, since one task writes a file: rows, and whether most hold between half and twice that."""
    wide = read(spark, sf_dir, "lineitem")
    found = []
    for name, df in (("narrow", wide.select("l_orderkey", "l_partkey")), ("wide", wide)):
        path = scratch_path(spark, name)
        save_table(df, f"{path}/whole")
        total = file_sizes(spark, f"{path}/whole").agg(F.sum("length")).first()[0]
        wanted = max(1, min(total // 8, BYTES_PER_FILE))
        save_by_bytes(df, f"{path}/sized", bytes_per_file=wanted)
        near = F.col("length").between(wanted // 2, wanted * 2)
        most = file_sizes(spark, f"{path}/sized").agg(F.count_if(near) * 2 > F.count("*"))
        rows = read_table(spark, f"{path}/sized").agg(F.count("*").alias("row_cnt"))
        is_near = F.lit(most.first()[0]).alias("most_near")
        found.append(rows.select(F.lit(name).alias("layout"), "row_cnt", is_near))
    return checks.union_all(found)


def clustered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as written and clustered by an interleaved key: rows, key sums, and whether a
    file spans less than three quarters of either key's range on average."""
    path = scratch_path(spark, "lineitem")
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    by = ["l_partkey", "l_suppkey"]
    rows = lines.count()
    held = rows_per_file(rows, SMALL_FILE, SMALL_FILES)
    save_table(size_files(lines, rows, held), f"{path}/written")
    recluster(spark, f"{path}/written", f"{path}/clustered", by, "l_orderkey", rows, held)
    return checks.union_all(
        checks.file_spans(read_table(spark, f"{path}/{layout}"), by).select(
            F.lit(layout).alias("layout"),
            "row_cnt",
            *(f"sum_{c}" for c in by),
            *((F.col(f"mean_span_{c}") < 0.75).alias(f"narrow_{c}") for c in by),
        )
        for layout in ("written", "clustered")
    )


def built(
    spark: SparkSession, sf_dir: str, target: str | None = None, resume: bool = False
) -> tuple[str, DataFrame]:
    """All tables built: a ledger row per order and an income-statement row per event.

    Returns where they are and the report.
    """
    orders = ids_from(read(spark, sf_dir, "orders"), F.col("o_orderkey"))
    events = event_rows(spark, sf_dir)
    sized = volumes(spark, sf_dir)
    sized = replace(sized, rows={**sized.rows, "CIS_fact": events.count()})
    target = target or scratch_path(spark, "build")
    ids = {LEDGER: orders, "CIS_fact": events}
    return target, build(spark, target, SPEC, sized, ids=ids, resume=resume)


def build_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, report = built(spark, sf_dir)
    return report.select("table_name", "status", "row_cnt")


def build_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of building the star a second time from the same inputs: all of it is kept."""
    target, _ = built(spark, sf_dir)
    _, report = built(spark, sf_dir, target, resume=True)
    return report.select("table_name", "status", "row_cnt")


def build_then_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written star read back: totals of each fact's periods, orphans, duplicate keys."""
    target, _ = built(spark, sf_dir)
    tables = {t: table_of(spark, target, t) for t in TABLES}
    none = F.lit(None)
    totals = [
        tables[fact]
        .groupBy(F.col("fiscal_year_period_nbr").alias("period_nbr"))
        .agg(
            F.count("*").alias("row_cnt"), F.sum("transaction_currency_amt").cast(SUM).alias("amt")
        )
        .select(F.lit("totals").alias("check_nm"), F.lit(fact).alias("subject_nm"), "*")
        for fact in FACTS
    ]
    empty = [none.cast("int").alias("period_nbr"), none.cast(SUM).alias("amt")]
    orphans = checks.orphan_report(tables, RELATIONS).select(
        F.lit("orphan rows").alias("check_nm"),
        F.col("relation").alias("subject_nm"),
        F.col("orphan_rows").alias("row_cnt"),
        *empty,
    )
    repeats = checks.key_uniqueness({t: (tables[t], [row_key(t)]) for t in TABLES}).select(
        F.lit("repeated keys").alias("check_nm"),
        F.col("table_name").alias("subject_nm"),
        F.col("surplus_rows").alias("row_cnt"),
        *empty,
    )
    return checks.union_all([*totals, orphans, repeats])


QUERIES: dict[str, Query] = {
    "orders_by_quarter_region": orders_by_quarter_region,
    "orders_fiscal_attribution": orders_fiscal_attribution,
    "cyclic_picks": cyclic_picks,
    "weighted_picks": weighted_picks,
    "threshold_picks": threshold_picks,
    "keyed_flags": keyed_flags,
    "formatted_codes": formatted_codes,
    "uniform_decimals": uniform_decimals,
    "lognormal_amounts": lognormal_amounts,
    "signed_amounts": signed_amounts,
    "random_dates": random_dates,
    "audit_columns": audit_columns,
    "hierarchy_levels": hierarchy_levels,
    "derived_columns": derived_columns,
    **{f"dim_{table}": dimension_query(table) for table in DIMENSION_ROWS},
    "dim_atscale_geo_security": geo_security,
    "dim_finance_foreign_currency_exchange_rate": exchange_rates,
    "dim_calendar_fiscal_period_v": orders_calendar,
    "ledger_from_orders": ledger,
    "income_statement": income_statement,
    "income_statement_signed": income_statement_signed,
    "balance_sheet": balance_sheet,
    "fk_dense": fk_dense,
    "fk_derived": fk_derived,
    "fk_ordinal_join": fk_ordinal_join,
    "fk_literal_table": fk_literal_table,
    "distinct_parts": distinct_parts,
    "fiscal_years_shipped": fiscal_years_shipped,
    "agg_ledger": aggregate,
    "agg_ledger_described": aggregate_described,
    "agg_ledger_quarter_region": aggregate_by_quarter_region,
    "agg_refresh": aggregate_refreshed,
    "measures_from_aggregate": measures_from_aggregate,
    "measures_by_quarter": measures_by_quarter,
    "measures_sql_view": measures_sql_view,
    "agg_reconcile": aggregate_reconciled,
    "fx_convert_ledger": ledger_in_dollars,
    "events_with_segment": events_with_segment,
    "events_with_segment_bucketed": events_with_segment_bucketed,
    "agg_bucketed": aggregate_bucketed,
    "row_counts": row_counts,
    "fk_orphans_all": orphans_all,
    "fk_orphans_ledger": orphans_ledger,
    "fk_orphans_filtered_part": orphans_filtered_part,
    "fk_orphans_bucketed": orphans_bucketed,
    "pk_duplicates_lineitem": duplicate_lines,
    "pk_uniqueness_all": key_uniqueness,
    "pk_income_statement": statement_keys,
    "pk_density": key_density,
    "not_null_profile": null_profile,
    "schema_conformance": schema_conformance,
    "schema_projection": conformed_customers,
    "amount_distribution": amount_distribution,
    "declared_weights_fit": declared_weights_fit,
    "declared_amounts_fit": declared_amounts_fit,
    "calendar_check": calendar_check,
    "hierarchy_nesting_check": hierarchy_nesting,
    "hierarchy_closure": hierarchy_closure,
    "ledger_rules": ledger_rules,
    "partitioned_write": partitioned_ledger,
    "replace_period": replaced_periods,
    "recluster_appended": reclustered_appends,
    "sized_append_write": sized_files,
    "files_by_bytes": files_by_bytes,
    "clustered_write_stats": clustered_files,
    "build_report": build_report,
    "build_resumed": build_resumed,
    "build_then_check": build_then_check,
    "ledger_cyclic": cyclic_ledger,
    "income_statement_cyclic": cyclic_income_statement,
    "dim_gl_account_dim_cyclic": cyclic_accounts,
    "dim_finance_customer_dim_v_cyclic": cyclic_customers,
    "ledger_weighted_periods": weighted_ledger,
}


def tuned(query: Query) -> Query:
    """The query on a session with the settings the jobs are written for."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    return run

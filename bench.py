"""Times the headline queries and the generators; prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the cores of the local session.
``value`` is the sum of the headline queries' seconds, each the better of two runs.
``rows_per_core_s`` is the rate at which each fact is generated, all columns computed and
discarded, and the ledger written as Parquet; ``ledger_job_s`` the seconds of the aggregate
and the checks over that written ledger.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession

from ledgerweave.operators import agg, checks
from ledgerweave.plans.queries import LEDGER, QUERIES, SPEC, tuned
from ledgerweave.sources.generate import Volumes, generate, generate_clustered
from ledgerweave.sources.schema import FACTS, RELATIONS
from ledgerweave.sources.tables import read_table, save_declared, scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
HEADLINE = (
    "orders_by_quarter_region",
    "orders_fiscal_attribution",
    "ledger_from_orders",
    "income_statement",
    "balance_sheet",
    "dim_finance_product_dim_v",
    "dim_finance_customer_dim_v",
    "fk_dense",
    "fk_ordinal_join",
    "agg_ledger",
    "agg_ledger_quarter_region",
    "measures_by_quarter",
    "fx_convert_ledger",
    "events_with_segment",
    "fk_orphans_all",
    "fk_orphans_filtered_part",
    "pk_duplicates_lineitem",
    "pk_uniqueness_all",
    "not_null_profile",
    "amount_distribution",
    "ledger_rules",
)
FACT_ROWS = 4_000_000
VOLUMES = Volumes(
    ledger_rows=FACT_ROWS,
    rows={"CIS_fact": FACT_ROWS, "consolidated_balance_sheet_fact": FACT_ROWS},
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        # No Python call site per column: plans of wide tables are built twice as fast.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    """Compute every column of every row and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def best(run, times: int = 2) -> float:
    seconds = []
    for _ in range(times):
        started = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - started)
    return round(min(seconds), 3)


def fact_rates(spark: SparkSession, path: str) -> dict[str, float]:
    """Rows per core and second for each fact, and for the ledger written to ``path``."""
    rates = {}
    for table in FACTS:
        seconds = best(lambda: drain(generate(spark, table, VOLUMES, SPEC)))
        rates[table] = round(FACT_ROWS / seconds / CPUS)
    ledger = generate_clustered(spark, LEDGER, VOLUMES, SPEC)
    seconds = best(lambda: save_declared(ledger, LEDGER, path, already_partitioned=True))
    rates[f"{LEDGER}_written"] = round(FACT_ROWS / seconds / CPUS)
    return rates


def rates_by_cores(spark: SparkSession) -> dict[str, float]:
    """Ledger rows per second from one task, four tasks, and one per core."""
    rates = {}
    for tasks in sorted({1, min(4, CPUS), CPUS}):
        rows = 250_000 * tasks
        ids = spark.range(0, rows, 1, tasks)
        seconds = best(lambda: drain(generate(spark, LEDGER, VOLUMES, SPEC, ids=ids)))
        rates[str(tasks)] = round(rows / seconds)
    return rates


def ledger_jobs(spark: SparkSession, path: str) -> dict[str, float]:
    """Seconds for the aggregate and the checks over the written ledger."""
    tables = {
        r.parent: generate(spark, r.parent, VOLUMES, SPEC) for r in RELATIONS
    } | {LEDGER: read_table(spark, path)}
    ledger, accounts = tables[LEDGER], tables["gl_account_dim"]
    jobs = {
        "aggregate": lambda: agg.ledger_aggregate(ledger, accounts),
        "orphans_14_relations": lambda: checks.orphan_report(tables, RELATIONS),
        "key_uniqueness": lambda: checks.key_uniqueness(
            {LEDGER: (ledger, ["general_ledger_fact_id"])}
        ),
        "null_counts": lambda: checks.null_counts(ledger, LEDGER),
    }
    return {name: best(lambda: drain(job())) for name, job in jobs.items()}


def main() -> None:
    with contextlib.redirect_stdout(sys.stderr):
        spark = session()
        queries = {
            name: best(lambda: drain(tuned(QUERIES[name])(spark, SF_DIR))) for name in HEADLINE
        }
        path = scratch_path(spark, "bench")
        rates = fact_rates(spark, path)
        by_cores = rates_by_cores(spark)
        jobs = ledger_jobs(spark, path)
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
                "fact_rows": FACT_ROWS,
                "rows_per_core_s": rates,
                "ledger_rows_per_s_by_tasks": by_cores,
                "ledger_job_s": jobs,
            }
        )
    )


if __name__ == "__main__":
    main()

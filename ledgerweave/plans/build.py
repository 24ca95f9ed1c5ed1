"""Building a chosen set of tables: parents before children, independent ones side by side."""

from __future__ import annotations

import hashlib
import logging
import time
from collections.abc import Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.session import tuned_for
from ledgerweave.sources.generate import Volumes, generate, generate_clustered
from ledgerweave.sources.schema import (
    DERIVATIONS,
    DIMENSIONS,
    FACTS,
    LAYOUTS,
    RELATIONS,
    TABLES,
    conform,
)
from ledgerweave.sources.spec import ID, Spec, id_range
from ledgerweave.sources.tables import read_table, save_declared, save_table

logger = logging.getLogger(__name__)

SCOPES = {"all": TABLES, "dimensions": DIMENSIONS, "facts": FACTS}
#: Tables written at a time.  Each is a set of jobs of its own, in a scheduler pool of its name.
TABLES_AT_ONCE = 4
#: Under a folder or database: what each finished table was made from, and its rows.
RECORDS = "build_records"
RECORD_SCHEMA = "table_name string, inputs string, row_cnt bigint"
REPORT_SCHEMA = (
    "table_name string, status string, row_cnt bigint, elapsed_s double, error string"
)


class Outcome(NamedTuple):
    table_name: str
    status: str  # OK, KEPT, FAILED or SKIPPED
    row_cnt: int | None
    elapsed_s: float
    error: str | None


def parents_of(table: str) -> set[str]:
    """The tables a table's keys refer to."""
    return {r.parent for r in (*RELATIONS, *DERIVATIONS) if r.child == table}


def build_order(tables: tuple[str, ...] = TABLES) -> list[str]:
    """The tables, each after its parents."""
    order = TopologicalSorter({t: sorted(parents_of(t)) for t in TABLES}).static_order()
    return [t for t in order if t in tables]


def resolve_scope(scope: str) -> list[str]:
    """The tables of ``all``, ``dimensions``, ``facts`` or one named table, in build order."""
    if scope in SCOPES:
        return build_order(SCOPES[scope])
    if scope in TABLES:
        return [scope]
    raise ValueError(f"unknown scope {scope!r}: not one of {', '.join(SCOPES)} or a table")


def build(
    spark: SparkSession,
    target: str,
    spec: Spec,
    volumes: Volumes = Volumes(),
    scope: str = "all",
    mode: str = "overwrite",
    ids: Mapping[str, DataFrame] | None = None,
    first_ids: Mapping[str, int] | None = None,
    resume: bool = False,
) -> DataFrame:
    """Generate and write the tables of ``scope``; one report row per table.

    ``target`` is a folder (with a slash) or a database.  A failed table is reported and
    the rest go on, except for the children of a failed parent, which are skipped.
    Parents outside the scope need not exist: keys follow from ``volumes`` alone.
    ``ids`` supplies the row ids of single tables; the others are ranges, which begin at
    ``first_ids`` where given.  An append needs ids that the table doesn't hold yet.  The
    report counts the rows that this build wrote.  Tables that don't depend on each other are
    written at the same time.  An overwrite leaves a table as it was if it fails.  With
    ``resume`` a table that was written from the same inputs, and still has the rows it was
    written with, is kept and not written again.
    """
    if resume and mode != "overwrite":
        raise ValueError("only an overwrite can be resumed: an append adds its rows again")
    supplied = dict(ids or {})
    for table, first in (first_ids or {}).items():
        supplied[table] = id_range(spark, volumes.of(table), start=first)
    with tuned_for(spark):
        return _build(spark, target, spec, volumes, scope, mode, supplied, resume)


def _build(
    spark: SparkSession,
    target: str,
    spec: Spec,
    volumes: Volumes,
    scope: str,
    mode: str,
    supplied: Mapping[str, DataFrame],
    resume: bool,
) -> DataFrame:
    tables = resolve_scope(scope)
    outcomes: dict[str, Outcome] = {}

    def run(table: str) -> Outcome:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
        started = time.monotonic()
        status, error = "OK", None
        try:
            inputs = fingerprint(table, spec, volumes, supplied.get(table))
            if resume and _recorded(spark, target, table) == (
                inputs, rows := _rows_of(spark, target, table)
            ):
                return Outcome(table, "KEPT", rows, round(time.monotonic() - started, 3), None)
            before = _rows_of(spark, target, table) if mode == "append" else 0
            _write(spark, table, target, spec, volumes, mode, supplied.get(table))
            rows = _rows_of(spark, target, table)
            _record(spark, target, table, inputs if mode == "overwrite" else None, rows)
            rows -= before
        except Exception as failure:  # one table's failure must not end the run
            logger.exception("table %s failed", table)
            status, rows = "FAILED", None
            error = f"{type(failure).__name__}: {failure}".splitlines()[0]
        return Outcome(table, status, rows, round(time.monotonic() - started, 3), error)

    graph = TopologicalSorter({t: parents_of(t) & set(tables) for t in tables})
    graph.prepare()
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        running: dict[Future, str] = {}
        while graph.is_active():
            for table in sorted(graph.get_ready(), key=tables.index):
                lost = sorted(
                    p
                    for p in parents_of(table)
                    if p in outcomes and outcomes[p].status not in ("OK", "KEPT")
                )
                if lost:
                    outcomes[table] = Outcome(
                        table, "SKIPPED", None, 0.0, f"parent not built: {', '.join(lost)}"
                    )
                    graph.done(table)
                else:
                    running[pool.submit(inheritable_thread_target(spark)(run), table)] = table
            if running:
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    table = running.pop(future)
                    outcomes[table] = future.result()
                    graph.done(table)
    return spark.createDataFrame([outcomes[t] for t in tables], REPORT_SCHEMA)


def fingerprint(table: str, spec: Spec, volumes: Volumes, ids: DataFrame | None) -> str:
    """What a table's contents follow from, as one digest: its rows follow from their ids."""
    given = "range"
    if ids is not None:
        mark = F.sum(F.xxhash64(ID).cast("decimal(20,0)"))
        given = str(tuple(ids.agg(F.count("*"), mark).first()))
    return hashlib.sha256("\n".join((table, repr(spec), repr(volumes), given)).encode()).hexdigest()


def _record(spark: SparkSession, target: str, table: str, inputs: str | None, rows: int) -> None:
    """Note what a finished table was made from; after an append nothing is known of it."""
    note = spark.createDataFrame([(table, inputs, rows)], RECORD_SCHEMA)
    save_table(note, _record_name(target, table))


def _recorded(spark: SparkSession, target: str, table: str) -> tuple[str, int] | None:
    """The inputs and rows of a table's last write."""
    try:
        found = read_table(spark, _record_name(target, table)).first()
    except AnalysisException:
        return None
    return found and (found["inputs"], found["row_cnt"])


def _record_name(target: str, table: str) -> str:
    return _name(target, f"{RECORDS}/{table}" if "/" in target else f"{RECORDS}_{table}")


def table_of(spark: SparkSession, target: str, table: str) -> DataFrame:
    """A table of a build, as written, in its declared schema."""
    return conform(read_table(spark, _name(target, table)), table)


def _write(
    spark: SparkSession,
    table: str,
    target: str,
    spec: Spec,
    volumes: Volumes,
    mode: str,
    ids: DataFrame | None,
) -> None:
    rows = volumes.of(table)
    if table in LAYOUTS:
        df = generate_clustered(spark, table, volumes, spec, ids)
    else:
        df = generate(spark, table, volumes, spec, ids=ids)
    save_declared(df, table, _name(target, table), rows, mode, already_partitioned=True)


def _rows_of(spark: SparkSession, target: str, table: str) -> int:
    """How many rows a table holds; none if it isn't there yet."""
    try:
        return table_of(spark, target, table).count()
    except AnalysisException:
        return 0


def _name(target: str, table: str) -> str:
    return f"{target.rstrip('/')}/{table}" if "/" in target else f"{target}.{table}"

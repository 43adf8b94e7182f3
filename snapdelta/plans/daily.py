"""The whole daily run, and DDL for tables not covered yet."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import coverage, register_table
from ..operators.ledger import SUCCESS, append_rows, finished_loads, now, read_ledger, read_rows, record_runs, run_row
from ..schemas import LINEAGE, SNAPSHOT_RAW, TABLE_METADATA
from ..sinks.buckets import BUCKETS
from ..sinks.ddl import catalog_to_ddl
from ..sources.tables import read_partition
from .bronze import Reader, ingest_envelope, ingest_tables, ledger_path, runs_path, snapshot_path
from .gold import GOLD_SCHEMA, GOLD_TABLE, build_gold, read_change_metrics
from .lake import check_contract, read_contract_results
from .silver import SILVER_SCHEMA, STATE_TABLE, process_silver
from .specs import TableSpec


def metadata_path(base: str) -> str:
    return f"{base.rstrip('/')}/control/table_metadata"


def lineage_path(base: str) -> str:
    return f"{base.rstrip('/')}/control/lineage"


def read_metadata(spark: SparkSession, base: str) -> DataFrame:
    """The newest record of every table the runs have loaded."""
    records = read_rows(spark, metadata_path(base), TABLE_METADATA)
    return register_table(records, records.limit(0))


def read_lineage(spark: SparkSession, base: str) -> DataFrame:
    """The edges the runs have recorded, each with its last time."""
    edges = read_rows(spark, lineage_path(base), LINEAGE)
    keys = ["source_table", "target_table", "transformation_type", "pipeline_name"]
    return edges.groupBy(*keys).agg(F.max("execution_timestamp").alias("execution_timestamp"))


def _metadata(spec: TableSpec, domain: str, rows: int | None, at: dt.datetime) -> dict:
    return {
        "domain": spec.domain or domain,
        "layer": "bronze",
        "name": spec.full_name,
        "source_system": spec.source_type,
        "owner": spec.owner,
        "description": None,
        "pii": spec.pii,
        "retention_days": spec.retention_days,
        "created_at": at,
        "updated_at": at,
        "row_count": rows,
        "size_mb": None,
    }


def _edges(tables: Sequence[str], pipeline: str, at: dt.datetime) -> list[dict]:
    """What a run made of each table, layer by layer."""
    steps = [
        ("{}", "bronze.{}", "snapshot"),
        ("bronze.{}", "silver.delta_events", "compare"),
        ("silver.delta_events", "silver.current_state", "apply"),
        ("silver.delta_events", "gold.daily_change_metrics", "aggregate"),
        ("bronze.{}", "gold.data_quality_metrics", "aggregate"),
    ]
    edges = {(a.format(t), b.format(t), kind) for t in tables for a, b, kind in steps}
    return [
        {"source_table": a, "target_table": b, "transformation_type": kind, "pipeline_name": pipeline, "execution_timestamp": at}
        for a, b, kind in sorted(edges)
    ]


def failing_contracts(
    spark: SparkSession, specs: Sequence[TableSpec], base: str, day: dt.date, checked_at: str | dt.datetime
) -> list[str]:
    """Check the envelopes of a day against their tables' contracts; the tables that fail."""
    failed = []
    for spec in specs:
        declared = replace(spec.contract(freshness_col="ingestion_timestamp"), key="primary_key" if spec.primary_keys else None)
        rows = read_partition(spark, snapshot_path(base), SNAPSHOT_RAW, {"ref_date": day, "table_name": spec.full_name})
        if not check_contract(spark, spec, rows, base, day, checked_at, declared):
            failed.append(spec.full_name)
    return failed


def run_day(
    spark: SparkSession,
    reader: Reader,
    specs: Sequence[TableSpec],
    base: str,
    ref_date: str | dt.date,
    force: bool = False,
    parallel: int = 4,
    domain: str = "default",
    buckets: int = BUCKETS,
    gate: bool = False,
    checked_at: str | dt.datetime | None = None,
) -> DataFrame:
    """Load all tables, derive events and state, write the metrics; returns the
    day's change metrics.

    Only tables whose load succeeded take part, with ``gate`` only those that keep their
    contract (results are stored; a table that does not is treated as missing that day). Repeating a day replaces its
    partitions; steps the ledger shows as done are not repeated unless something
    new was loaded or ``force`` is set. Each layer that ran leaves a row of run
    metrics, each table loaded a metadata record, and what was made of it lineage.
    """
    day = dt.date.fromisoformat(str(ref_date))
    runs, started = [], now()
    days = [day, day - dt.timedelta(days=1)]
    finished = finished_loads(read_ledger(spark, ledger_path(base), days), days)
    rows = ingest_tables(spark, reader, specs, base, day, ingest_envelope, force, parallel, finished)
    failed = {(r["schema_name"], r["table_name"]) for r in rows if r["status"] != SUCCESS}
    usable = [s for s in specs if (s.schema or "", s.table) not in failed]
    changed = len(rows) > len(failed)
    if rows:
        errors = [f"{r['table_name']}: {r['error_message']}" for r in rows if r["status"] != SUCCESS]
        counts = {(r["schema_name"], r["table_name"]): r["row_count"] for r in rows if r["status"] == SUCCESS}
        if gate and changed:
            broken = set(failing_contracts(spark, usable, base, day, checked_at or now()))
            errors += [f"{t}: contract failed" for t in sorted(broken)]
            usable = [s for s in usable if s.full_name not in broken]
        runs.append(run_row(domain, "bronze", started, sum(r["row_count"] or 0 for r in rows), errors=errors))
        loaded = [(s, counts[s.schema or "", s.table]) for s in specs if (s.schema or "", s.table) in counts]
        if loaded:
            records = [_metadata(s, domain, n, started) for s, n in loaded]
            append_rows(spark, metadata_path(base), TABLE_METADATA, records, "CAST(updated_at AS DATE)")
    elif gate:
        known = read_contract_results(spark, base, day).filter("NOT passed").select("table_name").distinct()
        broken = {r["table_name"] for r in known.collect()}
        usable = [s for s in usable if s.name not in broken]
    tables = [s.full_name for s in usable]
    made = False
    if tables and (changed or (day, SILVER_SCHEMA, STATE_TABLE) not in finished):
        started = now()
        n = process_silver(spark, base, day, tables, finished, buckets)
        runs.append(run_row(domain, "silver", started, n))
        changed = made = True
    if tables and (changed or (day, GOLD_SCHEMA, GOLD_TABLE) not in finished):
        started = now()
        runs.append(run_row(domain, "gold", started, build_gold(spark, base, day)))
        made = True
    if made:
        append_rows(spark, lineage_path(base), LINEAGE, _edges(tables, domain, started), "CAST(execution_timestamp AS DATE)")
    if runs:
        record_runs(spark, runs_path(base), runs)
    return read_change_metrics(spark, base, day)


def run_as_of(
    spark: SparkSession, reader: Reader, specs: Sequence[TableSpec], base: str, as_of: str | dt.date, **options
) -> list[dt.date]:
    """:func:`run_day` for every table's own reference date (``D-n`` before ``as_of``), oldest day
    first; returns the days."""
    by_day: dict[dt.date, list[TableSpec]] = defaultdict(list)
    for spec in specs:
        by_day[spec.ref_date(as_of)].append(spec)
    for day, of_day in sorted(by_day.items()):
        run_day(spark, reader, of_day, base, day, **options)
    return sorted(by_day)


def ddl_for_missing(
    source_columns: DataFrame, existing: DataFrame, database: str = "bronze", sized_types: bool = False
) -> DataFrame:
    """DDL of every source table that ``existing`` (its ``table_name``) lacks."""
    gaps = coverage(source_columns.select("table_name"), existing).filter("status = 'missing'").select("table_name")
    return catalog_to_ddl(
        source_columns.join(gaps, "table_name", "left_semi"), database=database, sized_types=sized_types
    )

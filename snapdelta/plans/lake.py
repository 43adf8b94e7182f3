"""The lake path as one job from a config: typed bronze, contracts, silver, gold metrics."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import SUCCESS, finished_loads, read_ledger
from ..operators.metrics import customer_ltv
from ..operators.quality import Contract, run_contract
from ..sinks.layers import expire_partitions, overwrite_partition
from ..sources.tables import layer_path, read_layer, read_partition
from .bronze import Reader, ingest_table, ingest_tables, ledger_path, write_counted
from .gold import gold_path, metric_from_config
from .silver import silver_dedupe, silver_transform
from .specs import TableSpec, load_specs, select_specs, transformation_steps

CONTRACT_RESULTS = "table_name STRING, check STRING, actual DOUBLE, expected DOUBLE, passed BOOLEAN"

#: Metrics that are more than declared aggregates, by the ``type`` a config names them with.
METRICS = {"customer_ltv": customer_ltv}


def silver_entity(spec: TableSpec) -> tuple[str, str]:
    """Folder names of a table's silver rows: its domain (or source) and its name."""
    return spec.domain or spec.source_type, spec.name


def check_contract(
    spark: SparkSession,
    spec: TableSpec,
    rows: DataFrame,
    base: str,
    day: dt.date,
    as_of: str | dt.datetime,
    contract: Contract | None = None,
) -> bool:
    """Store a table's contract results of a day; whether all checks passed. A table that
    declares nothing passes without a row."""
    contract = contract or spec.contract()
    if contract.row_count_min is None and contract.freshness_hours is None and contract.key is None:
        return True
    results = run_contract(rows, contract, as_of)
    path = gold_path(base, "contract_results")
    overwrite_partition(results.drop("table_name"), path, {"ref_date": day, "table_name": spec.name})
    stored = read_contract_results(spark, base, day).filter(F.col("table_name") == spec.name)
    return stored.filter(~F.col("passed")).isEmpty()


def read_contract_results(spark: SparkSession, base: str, ref_date: str | dt.date) -> DataFrame:
    """Contract results of all tables of a day."""
    return read_partition(spark, gold_path(base, "contract_results"), CONTRACT_RESULTS, {"ref_date": ref_date})


def write_silver(
    spark: SparkSession, spec: TableSpec, rows: DataFrame, steps: Sequence[Mapping], base: str, day: dt.date
) -> int:
    """Deduplicated rows with the declared transformations, instead of the day's silver rows."""
    cleaned, _ = silver_transform(silver_dedupe(rows), steps, order_by=["row_hash"])
    path = layer_path(base, "silver", *silver_entity(spec))
    return write_counted(
        cleaned, f"silver_{spec.name}", lambda d: overwrite_partition(d, path, {"reference_date": str(day)})
    )


def write_metric(spark: SparkSession, config: Mapping, name: str, base: str, day: dt.date) -> int:
    """One declared gold metric of a day from the silver table it names as its source."""
    declared = config["gold_metrics"][name]
    _, source, entity = declared["source"].split(".")
    rows = read_layer(spark, base, "silver", source, entity, day)
    kind = declared.get("type")
    metric = METRICS[kind](rows) if kind else metric_from_config(config, name, rows)
    return write_counted(
        metric, f"gold_{name}", lambda d: overwrite_partition(d, gold_path(base, name), {"ref_date": str(day)})
    )


def run_lake(
    spark: SparkSession,
    reader: Reader,
    config: Mapping,
    base: str,
    as_of: str | dt.date,
    source_type: str | None = None,
    gate: bool = True,
    force: bool = False,
    checked_at: str | dt.datetime | None = None,
) -> dict[str, int]:
    """Load every declared table for its own reference date (``D-n`` before ``as_of``), check
    its contract, write its silver rows and then the gold metrics; returns rows per target.

    A table that fails to load, or (with ``gate``) its contract, stays out of silver; the
    metrics that need it are left as they are. Partitions past a table's retention go.
    """
    specs = load_specs(config)
    specs = select_specs(specs, source_type) if source_type else specs
    by_day: dict[dt.date, list[TableSpec]] = defaultdict(list)
    for spec in specs:
        by_day[spec.ref_date(as_of)].append(spec)
    written: dict[str, int] = {}
    days: dict[tuple[str, str], dt.date] = {}
    for day, of_day in by_day.items():
        tried = ingest_tables(spark, reader, of_day, base, day, ingest_table, force)
        failed = {(r["schema_name"], r["table_name"]) for r in tried if r["status"] != SUCCESS}
        done = finished_loads(read_ledger(spark, ledger_path(base), [day]), [day])
        for spec in of_day:
            load = (spec.schema or "", spec.table)
            if load in failed or (day, *load) not in done:
                continue
            rows = read_layer(spark, base, "bronze", spec.source_type, spec.entity, day)
            if not check_contract(spark, spec, rows, base, day, checked_at or dt.datetime.now(dt.timezone.utc)) and gate:
                continue
            declared = spec.name in config.get("silver_transformations", {})
            steps = transformation_steps(config, spec.name) if declared else []
            written[f"silver.{spec.name}"] = write_silver(spark, spec, rows, steps, base, day)
            days[silver_entity(spec)] = day
            bronze = layer_path(base, "bronze", spec.source_type, spec.entity)
            expire_partitions(spark, bronze, "reference_date", as_of, spec.retention_days)
    for name, declared in config.get("gold_metrics", {}).items():
        _, source, entity = declared["source"].split(".")
        if (source, entity) in days:
            written[f"gold.{name}"] = write_metric(spark, config, name, base, days[source, entity])
    return written

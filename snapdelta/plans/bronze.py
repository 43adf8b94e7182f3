"""Bronze loads: typed snapshots, envelopes and staging copies."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..functions import build_schema, error_text, primary_key
from ..operators.aggregates import observed_count
from ..operators.envelope import to_envelope, with_ingestion_metadata, with_snapshot_hash
from ..operators.ledger import (
    FAILED,
    STARTED,
    SUCCESS,
    Load,
    finished_loads,
    ledger_row,
    now,
    read_ledger,
    record_ingestion,
)
from ..schemas import BRONZE_METADATA
from ..sinks.ddl import schema_to_ddl
from ..sinks.jdbc import write_jdbc
from ..sinks.layers import overwrite_partition
from ..sources.jdbc import JdbcSource, read_declared, read_table
from ..sources.tables import layer_path, read_layer
from .specs import TableSpec

Reader = Callable[[TableSpec], DataFrame]


def ledger_path(base: str) -> str:
    return f"{base.rstrip('/')}/control/ingestion_control"


def runs_path(base: str) -> str:
    return f"{base.rstrip('/')}/control/run_metrics"


def snapshot_path(base: str) -> str:
    return f"{base.rstrip('/')}/bronze/snapshot_raw"


def jdbc_reader(source: JdbcSource) -> Reader:
    """Reads a spec's table in as many ranges as it declares."""

    def read(spec: TableSpec) -> DataFrame:
        return read_table(
            source, spec.table, spec.schema, spec.partition_column, spec.num_partitions, spec.fetch_size
        )

    return read


def write_counted(df: DataFrame, name: str, write: Callable[[DataFrame], object]) -> int:
    """Write and count in one pass over the source."""
    counted, observation = observed_count(df, name)
    write(counted)
    return int(observation.get["row_count"])


def ingest_table(reader: Reader, spec: TableSpec, base: str, ref_date: str | dt.date) -> int:
    """One table's typed snapshot of a day into the bronze layer; returns its rows.

    The day's partition is replaced, so a rerun does not add rows.
    """
    df = with_ingestion_metadata(reader(spec), spec.source_type, spec.full_name, ref_date)
    path = layer_path(base, "bronze", spec.source_type, spec.entity)
    return write_counted(
        df, f"ingest_{spec.name}", lambda d: overwrite_partition(d, path, {"reference_date": str(ref_date)})
    )


def ingest_envelope(
    reader: Reader, spec: TableSpec, base: str, ref_date: str | dt.date, null_safe: bool | None = None
) -> int:
    """One table's snapshot of a day as key, hash and JSON payload; returns its rows. The
    hash sees a value move between NULL columns unless the spec (or ``null_safe``) says no.

    Rows of a task are stored in the order of their key, the declared order within a day and table. They are
    sorted as the source has them: hash and payload would make them several times as wide."""
    safe = spec.null_safe if null_safe is None else null_safe
    ordered = reader(spec).sortWithinPartitions(primary_key(spec.primary_keys))
    rows = to_envelope(ordered, spec.full_name, spec.primary_keys, ref_date, safe)
    values = {"ref_date": str(ref_date), "table_name": spec.full_name}
    return write_counted(
        rows,
        f"envelope_{spec.name}",
        lambda d: overwrite_partition(d, snapshot_path(base), values),
    )


def load_envelope(
    spark: SparkSession,
    spec: TableSpec,
    base: str,
    ref_date: str | dt.date,
    target: JdbcSource | None = None,
    target_table: str = "bronze.snapshot_raw",
    chunk_rows: int = 500000,
) -> int:
    """Envelopes from the typed bronze snapshot of a day, business columns only.

    They go to the envelope layer, or in batches of ``chunk_rows`` to a
    relational target.
    """
    typed = read_layer(spark, base, "bronze", spec.source_type, spec.entity, ref_date)
    business = typed.drop(*BRONZE_METADATA)
    if target is None:
        return ingest_envelope(lambda _: business, spec, base, ref_date)
    rows = to_envelope(business, spec.full_name, spec.primary_keys, ref_date, spec.null_safe)
    return write_counted(rows, f"load_{spec.name}", lambda d: write_jdbc(d, target, target_table, chunk_rows))


def ingest_tables(
    spark: SparkSession,
    reader: Reader,
    specs: Iterable[TableSpec],
    base: str,
    ref_date: str | dt.date,
    load: Callable[..., int] = ingest_table,
    force: bool = False,
    parallel: int = 4,
    finished: set[Load] | None = None,
) -> list[dict]:
    """Load several tables; a failing one is recorded and does not stop the rest.

    Tables already loaded for the day are left alone unless ``force``. Up to
    ``parallel`` tables are submitted at a time so small ones fill idle cores.
    ``finished`` saves reading the ledger again. Returns one ledger row per table
    tried.
    """
    day = dt.date.fromisoformat(str(ref_date))
    if finished is None:
        finished = finished_loads(read_ledger(spark, ledger_path(base), [day]), [day])
    todo = [s for s in specs if force or (day, s.schema or "", s.table) not in finished]

    started = now()

    def row(spec: TableSpec, status: str, **result) -> dict:
        return ledger_row(day, spec.schema or "", spec.table, status, started, **result)

    def run(spec: TableSpec) -> dict:
        try:
            return row(spec, SUCCESS, row_count=load(reader, spec, base, day))
        except Exception as e:
            return row(spec, FAILED, error=error_text(e))

    if not todo:
        return []
    record_ingestion(spark, ledger_path(base), [row(s, STARTED) for s in todo])
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(run), todo))
    record_ingestion(spark, ledger_path(base), rows)
    return rows


def copy_table(
    source: JdbcSource,
    query: str,
    definition: Iterable[Mapping],
    snapshot_date: str | dt.date,
    write: Callable[[DataFrame], object],
    ddl_table: str,
    order_by: Sequence[str],
    create: Callable[[str], object] | None = None,
    **ranges,
) -> int:
    """Copy a query's result with a declared schema, snapshot date and record hash.

    ``write`` stores the rows (for instance a JDBC append with bounded
    connections); ``create`` receives the target's DDL first. Returns the rows.
    """
    definition = list(definition)
    if create is not None:
        create(schema_to_ddl(build_schema(definition), ddl_table, order_by))
    rows = with_snapshot_hash(read_declared(source, query, definition, **ranges), snapshot_date)
    return write_counted(rows, f"copy_{ddl_table.replace('.', '_')}", write)

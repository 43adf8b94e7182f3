"""Load ledger and run reports."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Collection, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import as_date
from ..schemas import INGESTION_CONTROL, RUN_METRICS, struct_of
from ..session import delete_path
from ..sinks.versions import drop_unnamed, drop_versions, list_names, next_name, read_version, version_names, write_version
from .state import latest_by_key

STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"
RUN_DAY = "CAST(start_time AS DATE)"
LOAD_KEYS = ["ref_date", "schema_name", "table_name"]
Load = tuple[dt.date, str, str]


def ledger_row(
    ref_date: dt.date,
    schema_name: str,
    table_name: str,
    status: str,
    started: dt.datetime,
    row_count: int | None = None,
    error: str | None = None,
) -> dict:
    """One ledger row; a finished step also gets its end time."""
    return {
        "ref_date": ref_date,
        "schema_name": schema_name,
        "table_name": table_name,
        "row_count": row_count,
        "ingestion_start": started,
        "ingestion_end": None if status == STARTED else now(),
        "status": status,
        "error_message": error,
    }


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


TAIL = "tail"
#: Files the tail may have before they are merged into the days.
TAIL_FILES = 24


def append_rows(spark: SparkSession, path: str, ddl: str, rows: Sequence[Mapping], day: str) -> None:
    """Add rows to a stored log: a file in its tail, which is merged into one file per
    ``day`` (an expression) before it grows long, so reading never lists old runs."""
    schema = struct_of(ddl)
    table = pa.Table.from_pylist([dict(r) for r in rows], schema=to_arrow_schema(schema))
    spark.createDataFrame(table, schema).coalesce(1).write.mode("append").parquet(f"{path}/{TAIL}")
    if len(_tail(spark, path)) > TAIL_FILES:
        compact_rows(spark, path, ddl, day)


def _tail(spark: SparkSession, path: str) -> list[str]:
    return [n for n in list_names(spark, f"{path}/{TAIL}") if n.endswith(".parquet") and not n.startswith(("_", "."))]


def _days_of(version: Mapping, days: Sequence[dt.date] | None) -> dict[str, str]:
    wanted = None if days is None else {str(d) for d in days}
    return {d: f for d, f in version["days"].items() if wanted is None or d in wanted}


def log_paths(spark: SparkSession, path: str, days: Sequence[dt.date] | None = None) -> list[str]:
    """What a read of a stored log goes through: a folder per day and the files of the tail."""
    version = read_version(spark, path) or {"days": {}, "absorbed": []}
    absorbed = set(version["absorbed"])
    tail = [f"{path}/{TAIL}/{n}" for n in _tail(spark, path) if n not in absorbed]
    return [f"{path}/{f}/day={d}" for d, f in sorted(_days_of(version, days).items())] + tail


def read_rows(spark: SparkSession, path: str, ddl: str, days: Sequence[dt.date] | None = None) -> DataFrame:
    """A stored log, empty if nothing was recorded yet; ``days`` leaves out the merged rows of others."""
    schema = struct_of(ddl)
    paths = log_paths(spark, path, days)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def compact_rows(spark: SparkSession, path: str, ddl: str, day: str) -> None:
    """Merge the tail into the days it belongs to. The new folders and the files they took in
    are named by one version file: until then readers see the tail, from then on the days,
    and whatever a run that dies leaves behind is never read twice."""
    _tidy(spark, path)  # what an earlier run took in and had no time to remove
    before = read_version(spark, path) or {"days": {}}
    tail = _tail(spark, path)
    days = {d: f for d, f in before["days"].items()}
    if tail:
        schema = struct_of(ddl)
        new = spark.read.schema(schema).parquet(*[f"{path}/{TAIL}/{n}" for n in tail]).withColumn("day", F.expr(day))
        touched = [str(r["day"]) for r in new.select("day").distinct().collect()]
        old = [f"{path}/{days[d]}/day={d}" for d in touched if d in days]
        if old:
            known = spark.read.schema(schema).parquet(*old).withColumn("day", F.expr(day))
            new = known.unionByName(new)
        name = next_name(spark, path)
        folder = f"version={uuid.uuid4().hex}"
        new.coalesce(1).sortWithinPartitions("day").write.partitionBy("day").parquet(f"{path}/{folder}")
        write_version(spark, path, name, {"days": {**days, **dict.fromkeys(touched, folder)}, "absorbed": tail})
    _tidy(spark, path)


def _tidy(spark: SparkSession, path: str) -> None:
    """Remove what the newest version took in or replaced."""
    version = read_version(spark, path)
    if version is None:
        return
    for n in set(_tail(spark, path)) & set(version["absorbed"]):
        delete_path(spark, f"{path}/{TAIL}/{n}")
    drop_versions(spark, path, version_names(spark, path)[:-1])
    drop_unnamed(spark, path, version["days"].values())


def forget_days(spark: SparkSession, path: str, before: dt.date, keep: Collection[dt.date] = ()) -> list[str]:
    """Drop the merged rows of days before ``before``, but for those to ``keep``; returns the days."""
    version = read_version(spark, path)
    kept = {str(d) for d in keep}
    gone = sorted(d for d in (version or {}).get("days", {}) if d < str(before) and d not in kept)
    if gone:
        kept = {d: f for d, f in version["days"].items() if d not in set(gone)}
        write_version(spark, path, next_name(spark, path), {"days": kept, "absorbed": version["absorbed"]})
        _tidy(spark, path)
    return gone


def record_ingestion(spark: SparkSession, ledger_path: str, rows: Sequence[Mapping]) -> None:
    """Append ledger rows, one per load step; columns left out are NULL."""
    append_rows(spark, ledger_path, INGESTION_CONTROL, rows, "ref_date")


def read_ledger(spark: SparkSession, ledger_path: str, days: Sequence[dt.date] | None = None) -> DataFrame:
    """The ledger, empty if nothing was recorded yet; ``days`` are those it must be complete for."""
    return read_rows(spark, ledger_path, INGESTION_CONTROL, days)


def run_row(
    domain: str,
    layer: str,
    started: dt.datetime,
    rows_processed: int = 0,
    rows_failed: int = 0,
    errors: Sequence[str] = (),
    status: str | None = None,
) -> dict:
    """Metrics of a run that ends now; it is an ``error`` if it had any, unless told otherwise."""
    ended = now()
    return {
        "domain": domain,
        "layer": layer,
        "start_time": started,
        "end_time": ended,
        "status": status or ("error" if errors else "success"),
        "rows_processed": rows_processed,
        "rows_failed": rows_failed,
        "errors": [{"timestamp": ended, "error": e} for e in errors],
        "duration_seconds": (ended - started).total_seconds(),
    }


def record_runs(spark: SparkSession, path: str, rows: Sequence[Mapping]) -> None:
    append_rows(spark, path, RUN_METRICS, rows, RUN_DAY)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Recorded run metrics, empty if there are none yet."""
    return read_rows(spark, path, RUN_METRICS)


def load_status(ledger: DataFrame) -> DataFrame:
    """The last ledger row of every load."""
    at = F.coalesce("ingestion_end", "ingestion_start")
    return latest_by_key(ledger.withColumn("_at", at), LOAD_KEYS, ["_at", "status"]).drop("_at")


def successful_loads(ledger: DataFrame) -> DataFrame:
    """Loads whose last attempt succeeded."""
    return load_status(ledger).filter(F.col("status") == SUCCESS).select(*LOAD_KEYS)


def finished_loads(
    ledger: DataFrame, days: Sequence[dt.date], always: Sequence[str] = ()
) -> set[Load]:
    """Successful loads of some days as a set, read once to steer a run: a few rows per
    table. Of the ``always`` tables it also has the newest load up to the first of the
    days; how many there were before does not matter."""
    listed = F.col("ref_date").isin(*days)
    steering = F.col("table_name").isin(*always) & (F.col("ref_date") <= F.lit(min(days)))
    done = successful_loads(ledger.filter(listed | steering))
    newest = done.filter(steering).groupBy("schema_name", "table_name").agg(F.max("ref_date").alias("ref_date"))
    return {tuple(r) for r in done.filter(listed).unionByName(newest.select(*LOAD_KEYS)).collect()}


def pending_loads(ledger: DataFrame, wanted: DataFrame, force: bool = False) -> DataFrame:
    """Loads ``(ref_date, schema_name, table_name)`` not yet done; all with ``force``."""
    wanted = wanted.select(*LOAD_KEYS).distinct()
    return wanted if force else wanted.join(successful_loads(ledger), LOAD_KEYS, "left_anti")


def already_loaded(
    ledger: DataFrame, ref_date: str | dt.date, schema_name: str, table_name: str, force: bool = False
) -> bool:
    """Whether the last attempt at this load succeeded; ``force`` says no."""
    if force:
        return False
    rows = ledger.filter(
        (F.col("ref_date") == as_date(ref_date))
        & (F.col("schema_name") == schema_name)
        & (F.col("table_name") == table_name)
    )
    return not successful_loads(rows).isEmpty()


def run_report(runs: DataFrame, sla_hours: DataFrame | Mapping[str, float] | None = None) -> DataFrame:
    """Runs, failures, rows, errors and durations per domain and layer, and whether
    the longest run kept within the layer's hours."""
    report = runs.groupBy("domain", "layer").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") != "success").alias("failed_runs"),
        F.sum("rows_processed").alias("rows_processed"),
        F.sum("rows_failed").alias("rows_failed"),
        F.sum(F.coalesce(F.size("errors"), F.lit(0))).alias("error_count"),
        F.min("start_time").alias("first_start"),
        F.max("end_time").alias("last_end"),
        F.max("duration_seconds").alias("max_duration_seconds"),
    )
    if sla_hours is None:
        return report
    if isinstance(sla_hours, DataFrame):
        report = report.join(sla_hours.select("layer", F.col("sla_hours").cast("double")), "layer", "left")
    else:
        limits = F.create_map(*[F.lit(x) for layer, h in sla_hours.items() for x in (layer, float(h))])
        report = report.withColumn("sla_hours", F.try_element_at(limits, F.col("layer")))
    return report.withColumn("within_sla", F.col("max_duration_seconds") <= F.col("sla_hours") * 3600)


def with_duration(runs: DataFrame) -> DataFrame:
    """Adds ``duration_seconds`` from start and end."""
    seconds = F.col("end_time").cast("timestamp").cast("double") - F.col("start_time").cast("timestamp").cast("double")
    return runs.withColumn("duration_seconds", seconds)

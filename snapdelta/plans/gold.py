"""Gold jobs: change and quality metrics of a day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import STARTED, SUCCESS, ledger_row, now, record_ingestion
from ..operators.metrics import aggregate_spec, daily_change_metrics, data_quality_metrics, historical_trends
from ..schemas import DAILY_CHANGE_METRICS, DATA_QUALITY_METRICS
from ..sinks.layers import align, in_stored_order, overwrite_partition
from ..sources.tables import read_partition
from .bronze import ledger_path, write_counted
from .silver import read_events, read_snapshots, read_state

GOLD_SCHEMA = "gold"
GOLD_TABLE = "daily_metrics"


def gold_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/gold/{table}"


def metric_from_config(config: Mapping, name: str, df: DataFrame) -> DataFrame:
    """A metric declared under ``gold_metrics``: its groups and its aggregates."""
    spec = config["gold_metrics"][name]["aggregations"]
    return aggregate_spec(df, spec["group_by"], spec["metrics"])


def build_gold(spark: SparkSession, base: str, ref_date: str | dt.date) -> int:
    """Write both metric tables of a day; each replaces the day's partition. Returns
    the rows written."""
    started = now()
    day = dt.date.fromisoformat(str(ref_date))
    record_ingestion(spark, ledger_path(base), [ledger_row(day, GOLD_SCHEMA, GOLD_TABLE, STARTED, started)])
    changes = daily_change_metrics(read_events(spark, base, day), read_state(spark, base, day), day)
    quality = data_quality_metrics(read_snapshots(spark, base, day), day)
    written = 0
    for table, rows, schema in (
        ("daily_change_metrics", changes, DAILY_CHANGE_METRICS),
        ("data_quality_metrics", quality, DATA_QUALITY_METRICS),
    ):
        stamped = rows.withColumn("calculated_at", F.current_timestamp())
        path = gold_path(base, table)
        written += write_counted(
            in_stored_order(align(stamped, schema), "gold", table),
            table,
            lambda d, p=path: overwrite_partition(d, p, {"ref_date": day}),
        )
    record_ingestion(spark, ledger_path(base), [ledger_row(day, GOLD_SCHEMA, GOLD_TABLE, SUCCESS, started)])
    return written


def read_change_metrics(spark: SparkSession, base: str, ref_date: str | dt.date | None = None) -> DataFrame:
    return _read_gold(spark, gold_path(base, "daily_change_metrics"), DAILY_CHANGE_METRICS, ref_date)


def read_quality_metrics(spark: SparkSession, base: str, ref_date: str | dt.date | None = None) -> DataFrame:
    return _read_gold(spark, gold_path(base, "data_quality_metrics"), DATA_QUALITY_METRICS, ref_date)


def _read_gold(spark: SparkSession, path: str, schema: str, ref_date: str | dt.date | None) -> DataFrame:
    """A metric table, one day of it if given."""
    if ref_date is None:
        return spark.read.schema(schema).parquet(path)
    return read_partition(spark, path, schema, {"ref_date": ref_date})


def trends(spark: SparkSession, base: str, n: int = 50) -> DataFrame:
    return historical_trends(read_change_metrics(spark, base), n)

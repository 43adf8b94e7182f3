"""Contract checks, schema validation and retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_date
from ..functions.types import CONFIG_TYPES

# Days a layer keeps its partitions; None keeps them for good.
LAYER_RETENTION_DAYS: dict[str, int | None] = {"bronze": 90, "silver": 365, "gold": None}
DEFAULT_RETENTION_DAYS = 365

# What a silver table must reach.
QUALITY_SCORE_MIN = 95.0
DUPLICATES_MAX = 0


@dataclass(frozen=True)
class Contract:
    """What a table must satisfy; a limit left at None is not checked."""

    table_name: str
    row_count_min: int | None = None
    freshness_hours: float | None = None
    freshness_col: str | None = None
    key: str | tuple[str, ...] | None = None
    duplicates_max: int | None = None
    quality_score_min: float | None = None
    schema: Mapping[str, str] = field(default_factory=dict)


# Forms Spark accepts as text of a number, blanks around it included.
INTEGER_TEXT = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"
DECIMAL_TEXT = r"^[\x00-\x20]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[\x00-\x20]*$"


def _data_type(name: str) -> T.DataType:
    """Spark type of a name used in table configs."""
    return T.StructType.fromDDL(f"c {CONFIG_TYPES.get(name.lower(), name.lower())}")["c"].dataType


def _hours_old(ts_col: str, as_of: str | dt.datetime) -> Column:
    latest = F.max(F.col(ts_col)).cast("timestamp").cast("double")
    return (F.lit(str(as_of)).cast("timestamp").cast("double") - latest) / 3600.0


def _unparsable(df: DataFrame, name: str, type_name: str) -> Column:
    """Number of values that cannot be cast. A failing cast of text to a number costs
    an exception per value, so text that cannot be one is told by its form."""
    c, wanted = F.col(name), _data_type(type_name)
    failed = c.try_cast(wanted).isNull()
    if isinstance(df.schema[name].dataType, T.StringType) and isinstance(wanted, T.IntegralType | T.DecimalType):
        form = INTEGER_TEXT if isinstance(wanted, T.IntegralType) else DECIMAL_TEXT
        failed = F.when(c.rlike(form), failed).otherwise(True)
    return F.count_if(c.isNotNull() & failed)


def _check(check: str, actual: Column, expected: float, passed: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        actual.cast("double").alias("actual"),
        F.lit(float(expected)).alias("expected"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def run_contract(df: DataFrame, contract: Contract, as_of: str | dt.datetime) -> DataFrame:
    """All checks of one table as rows ``table_name, check, actual, expected, passed``.

    The table is read once: every check is a column of the same aggregation. A
    check whose value is unknown (an empty table has no freshness) fails.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    checks = []
    if contract.row_count_min is not None:
        checks.append(
            _check("row_count_min", F.col("rows"), contract.row_count_min, F.col("rows") >= contract.row_count_min)
        )
    if contract.freshness_hours is not None:
        aggs.append(_hours_old(contract.freshness_col, as_of).alias("hours"))
        checks.append(
            _check(
                "freshness_hours", F.col("hours"), contract.freshness_hours, F.col("hours") <= contract.freshness_hours
            )
        )
    if contract.key is not None:
        key = (contract.key,) if isinstance(contract.key, str) else contract.key
        aggs.append(F.count_distinct(F.struct(*key)).alias("keys"))
        duplicates = F.col("rows") - F.col("keys")
        if contract.duplicates_max is not None:
            checks.append(
                _check("duplicates_max", duplicates, contract.duplicates_max, duplicates <= contract.duplicates_max)
            )
        if contract.quality_score_min is not None:
            score = F.lit(100.0) * (F.lit(1.0) - duplicates / F.nullif(F.col("rows"), F.lit(0)))
            checks.append(
                _check("quality_score_min", score, contract.quality_score_min, score >= contract.quality_score_min)
            )
    present = {c.lower() for c in df.columns}
    for i, (name, type_name) in enumerate(contract.schema.items()):
        if name.lower() in present:
            aggs.append(_unparsable(df, name, type_name).alias(f"bad_{i}"))
            bad = F.col(f"bad_{i}")
        else:
            bad = F.col("rows")
            checks.append(_check(f"column:{name}", F.lit(0), 1, F.lit(False)))
        checks.append(_check(f"schema:{name}", bad, 0, bad == 0))
    if not checks:
        raise ValueError(f"contract of {contract.table_name} has no checks")
    return df.agg(*aggs).select(F.lit(contract.table_name).alias("table_name"), F.inline(F.array(*checks)))


def check_min_rows(df: DataFrame, n: int, table_name: str = "") -> DataFrame:
    return run_contract(df, Contract(table_name, row_count_min=n), as_of="1970-01-01")


def check_freshness(
    df: DataFrame, ts_col: str, hours: float, as_of: str | dt.datetime, table_name: str = ""
) -> DataFrame:
    return run_contract(df, Contract(table_name, freshness_hours=hours, freshness_col=ts_col), as_of)


def default_limits(tables: DataFrame) -> DataFrame:
    """The contract's limits for every ``table_name``."""
    return tables.select(
        "table_name",
        F.lit(QUALITY_SCORE_MIN).alias("quality_score_min"),
        F.lit(DUPLICATES_MAX).cast("bigint").alias("duplicates_max"),
    ).distinct()


def check_quality(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Quality metrics against per-table limits: ``quality_score_min, duplicates_max``. A
    table without limits, or without a value to compare, fails."""
    return metrics.join(thresholds, "table_name", "left").select(
        "ref_date",
        "table_name",
        "quality_score",
        "quality_score_min",
        "duplicate_count",
        "duplicates_max",
        F.coalesce(
            (F.col("quality_score") >= F.col("quality_score_min"))
            & (F.col("duplicate_count") <= F.col("duplicates_max")),
            F.lit(False),
        ).alias("passed"),
    )


def validate_schema(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Per expected column: declared and actual type, whether it is present, and how
    many values cannot be cast."""
    actual = {f.name.lower(): f for f in df.schema.fields}
    aggs, rows = [], []
    for i, (name, type_name) in enumerate(expected.items()):
        found = actual.get(name.lower())
        wanted = _data_type(type_name)
        if found is not None:
            aggs.append(_unparsable(df, found.name, type_name).alias(f"bad_{i}"))
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(wanted.simpleString()).alias("expected_type"),
                F.lit(found.dataType.simpleString() if found else None).cast("string").alias("actual_type"),
                F.lit(found is not None).alias("present"),
                F.lit(found is not None and found.dataType == wanted).alias("type_matches"),
                (F.col(f"bad_{i}") if found else F.lit(None)).cast("bigint").alias("invalid_count"),
            )
        )
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    return counted.select(F.inline(F.array(*rows)))


def _cutoff(as_of: str | dt.date, days: int) -> Column:
    return F.date_sub(as_date(as_of), days)


def retained(
    df: DataFrame, date_col: str, as_of: str | dt.date, days: int | None = DEFAULT_RETENTION_DAYS
) -> DataFrame:
    """Rows no older than ``days``; None keeps everything. Prunes partitions when
    ``date_col`` is one."""
    return df if days is None else df.filter(F.col(date_col) >= _cutoff(as_of, days))


def expired_partitions(
    df: DataFrame, date_col: str, as_of: str | dt.date, days: int | None = DEFAULT_RETENTION_DAYS
) -> DataFrame:
    """Days past their retention, with the rows each still holds."""
    expired = df.filter(F.lit(False)) if days is None else df.filter(F.col(date_col) < _cutoff(as_of, days))
    return expired.groupBy(date_col).agg(F.count(F.lit(1)).alias("row_count"))

"""Reads from layers, catalogs, client rows and candidates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_date, error_text
from ..operators.envelope import has_columns, rename_project
from ..session import CODEC, new_path, path_exists


def layer_path(base: str, layer: str, source: str, entity: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{source}/{entity}"


def read_layer(
    spark: SparkSession,
    base: str,
    layer: str,
    source: str,
    entity: str,
    ref_date: str | dt.date | None = None,
    date_col: str = "reference_date",
) -> DataFrame:
    """One entity of a layer; only the partitions of ``ref_date`` if given."""
    path = layer_path(base, layer, source, entity)
    if ref_date is None:
        return spark.read.parquet(path)
    day = partition_path(path, {date_col: ref_date})
    if not path_exists(spark, day):
        return spark.read.parquet(path).filter(F.col(date_col) == as_date(ref_date))
    return spark.read.option("basePath", path).parquet(day)


def partition_path(path: str, values: Mapping[str, object]) -> str:
    """Folder of one partition; names are escaped as the writer escapes them."""
    return path.rstrip("/") + "".join(f"/{k}={quote(str(v), safe=' .-_')}" for k, v in values.items())


def read_partition(
    spark: SparkSession, path: str, schema: str | T.StructType, values: Mapping[str, object]
) -> DataFrame:
    """One partition of a table, empty if it does not exist.

    Only its folder is listed, so the read does not slow down as days pile up.
    """
    target = partition_path(path, values)
    if not path_exists(spark, target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(target)


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` and read it back: decouples the target from the source and cuts
    the plan. Without a path a new one in the shared folder is used, which
    survives the loss of executors."""
    spark = df.sparkSession
    target = new_path(spark, "stage") if path is None else path
    df.write.mode("overwrite").parquet(target, compression=CODEC)
    return spark.read.schema(df.schema).parquet(target)


def from_rows(spark: SparkSession, rows: Iterable[Sequence], columns: Sequence[str] | str | T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), columns)


def read_page(
    df: DataFrame,
    order_by: Sequence[str],
    limit: int,
    offset: int = 0,
    after: Sequence | None = None,
) -> DataFrame:
    """One page in key order. ``after`` (the last key of the previous page) filters
    at the scan instead of sorting past ``offset`` rows: use it for deep pages."""
    if after is not None:
        passed = F.struct(*order_by) > F.struct(*[F.lit(v).alias(c) for c, v in zip(order_by, after, strict=True)])
        # The leading column alone is a plain comparison the scan can use.
        df = df.filter(F.col(order_by[0]) >= F.lit(after[0])).filter(passed)
    ordered = df.orderBy(*order_by)
    return (ordered.offset(offset) if offset else ordered).limit(limit)


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """``catalog.database.table``; catalogs are plugged in by session config."""
    return spark.table(name)


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES").orderBy("namespace")


def list_catalog_tables(spark: SparkSession, database: str, like: str | None = None) -> DataFrame:
    """Tables of a session catalog database, optionally by LIKE pattern, sorted."""
    rows = [(database, t.name) for t in spark.catalog.listTables(database) if not t.isTemporary]
    tables = spark.createDataFrame(rows, "owner STRING, table_name STRING")
    if like:
        tables = tables.filter(F.upper("table_name").like(like.upper()))
    return tables.orderBy("table_name")


def first_available(
    candidates: Iterable[Callable[[], DataFrame]], errors: list[str] | None = None
) -> DataFrame | None:
    """The first candidate that can be read and has rows; None if there is none. Why the
    others could not be read is added to ``errors``."""
    for candidate in candidates:
        try:
            df = candidate()
            if not df.isEmpty():
                return df
        except Exception as e:  # an unreadable candidate is skipped
            if errors is not None:
                errors.append(error_text(e))
    return None


@dataclass(frozen=True)
class ScannedTable:
    owner: str
    table_name: str
    status: str
    df: DataFrame | None = None
    error: str | None = None


def scan_catalog(
    read: Callable[[str, str], DataFrame],
    tables: Iterable[tuple[str, str]],
    required_cols: Sequence[str],
    mapping: Mapping[str, str],
    loaded_at_col: str | None = None,
) -> list[ScannedTable]:
    """Plan the mapped read of every listed table; nothing is read but schemas.

    Tables without the required columns are ``SKIPPED``, unreadable ones
    ``FAILED``; neither stops the rest.
    """
    found = []
    for owner, name in tables:
        try:
            df = read(owner, name)
            if not has_columns(df, required_cols):
                found.append(ScannedTable(owner, name, "SKIPPED"))
                continue
            found.append(ScannedTable(owner, name, "MAPPED", rename_project(df, mapping, loaded_at_col)))
        except Exception as e:
            found.append(ScannedTable(owner, name, "FAILED", error=error_text(e)))
    return found

"""Parquet layers: appends, idempotent partition writes and clustering."""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MEDALLION, struct_of
from ..session import CODEC, delete_path, path_exists, replace_path
from ..sources.tables import layer_path, partition_path


def write_layer(
    df: DataFrame,
    base: str,
    layer: str,
    source: str,
    entity: str,
    partition_by: Sequence[str] = (),
    mode: str = "append",
    format: str = "parquet",
) -> str:
    """Rows of an entity in a layer; returns its folder. ``append`` adds files. ``overwrite``
    replaces the partitions ``df`` has rows for, or the whole entity if it has no
    partitions, once the new rows are complete."""
    path = layer_path(base, layer, source, entity)
    if mode == "append":
        df.write.format(format).mode("append").partitionBy(*partition_by).save(path)
    elif mode != "overwrite":
        raise ValueError(f"unknown mode {mode!r}")
    elif partition_by:
        overwrite_partitions(df, path, partition_by, format)
    else:
        overwrite_partition(df, path, {}, format)
    return path


def write_staging(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], format: str = "parquet") -> str:
    """Replace exactly the partitions ``df`` has rows for; others stay, so a rerun
    adds nothing.

    Rows are rebalanced by partition first: AQE cuts large partitions into files of
    its advisory size and no task writes a sliver of every partition.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .format(format)
        .save(path)
    )
    return path


def overwrite_partition(df: DataFrame, path: str, values: dict[str, str | dt.date], format: str = "parquet") -> str:
    """Replace one partition as a whole, also when ``df`` is empty now.

    Rows are written beside it, under a name readers skip, and take the partition's
    place once they are complete: a write that fails leaves the old rows.
    """
    target = partition_path(path, values)
    beside = f"{path.rstrip('/')}{'/_new' if values else '_new'}-{uuid.uuid4().hex}"
    try:
        codec = {"compression": CODEC} if format == "parquet" else {}
        df.drop(*values).write.format(format).options(**codec).save(beside)
        replace_path(df.sparkSession, beside, target)
    finally:
        delete_path(df.sparkSession, beside)
    return target


def expire_partitions(
    spark: SparkSession, path: str, date_col: str, as_of: str | dt.date, days: int | None
) -> list[dt.date]:
    """Remove day partitions older than ``days`` before ``as_of``; returns their days. Only
    folders are listed; None keeps everything."""
    if days is None or not path_exists(spark, path):
        return []
    limit = dt.date.fromisoformat(str(as_of)) - dt.timedelta(days=days)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    found = []
    for name in names:
        with contextlib.suppress(ValueError):  # a folder of another kind, or of rows without a day
            if name.startswith(f"{date_col}="):
                found.append(dt.date.fromisoformat(name.removeprefix(f"{date_col}=")))
    expired = sorted(d for d in found if d < limit)
    for day in expired:
        delete_path(spark, partition_path(path, {date_col: day}))
    return expired


def in_stored_order(df: DataFrame, layer: str, table: str) -> DataFrame:
    """Rows of a task in the order declared for a stored table, so that the ranges of its row groups
    are narrow. Nothing is shuffled; see :func:`clustered` for narrow files."""
    _, order = MEDALLION[layer][table]
    return df.sortWithinPartitions(*[c for c in order if c in df.columns])


def align(df: DataFrame, target: str | T.StructType) -> DataFrame:
    """``df`` with the target's columns, order and types; missing ones are NULL."""
    schema = struct_of(target) if isinstance(target, str) else target
    present = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def append_aligned(df: DataFrame, target: str | T.StructType, path: str, partition_by=None) -> str:
    writer = align(df, target).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def clustered(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Order rows for writing so that files cover narrow ranges of the sort key.

    Ranges are cut over partition *and* sort columns, so a large day is written
    by many tasks. Rows equal in all of them are told apart by the input
    partition they come from, so one very frequent key splits as well.
    """
    order = [*partition_by, *[c for c in sort_by if c not in partition_by]]
    return (
        df.withColumn("_slot", F.spark_partition_id())
        .repartitionByRange(*order, "_slot")
        .sortWithinPartitions(*order)
        .drop("_slot")
    )

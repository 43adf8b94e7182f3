"""Appends to a relational target over Spark's JDBC writer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.jdbc import JdbcSource

BATCH_SIZE = 500000


def writer_options(
    target: JdbcSource, table: str, batch_size: int = BATCH_SIZE, num_partitions: int | None = None
) -> dict[str, str]:
    return target.reader_options(dbtable=table, batchsize=batch_size, numPartitions=num_partitions)


def write_jdbc(
    df: DataFrame, target: JdbcSource, table: str, batch_size: int = BATCH_SIZE, num_partitions: int | None = None
) -> None:
    """Append in batches straight from the executors; ``num_partitions`` caps how
    many connections write at a time.

    Appends are not idempotent: a task whose executor is lost after its commit runs
    again. Where that matters, give rows a key and a load time and read the
    target through ``collapse_latest``, or reload a staging table.
    """
    options = writer_options(target, table, batch_size, num_partitions)
    df.write.format("jdbc").options(**options).mode("append").save()

"""Incremental refresh of the sales metrics.

Each micro-batch is reduced to partial results per day and customer, written
under the query's id and its batch number. Reading combines the partials. Both metrics come from
the same partials, exactly (distinct customers included), and the stream keeps no
state: there is no watermark to choose and nothing to lose with an executor. A
batch that is repeated replaces its own partials.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sinks.layers import overwrite_partition
from ..sources.tables import partition_path

PARTIAL_KEYS = ["order_date", "customer_id"]


def read_order_stream(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New Parquet files of a folder (or of a path pattern) as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def sales_partials(orders: DataFrame) -> DataFrame:
    """Orders reduced to one row per day and customer."""
    return orders.groupBy(*PARTIAL_KEYS).agg(
        F.sum("total_amount").alias("amount"),
        F.max("total_amount").alias("largest"),
        F.count("total_amount").alias("amounts"),
        F.count("order_id").alias("orders"),
        F.count(F.lit(1)).alias("rows"),
    )


def stream_daily_sales(orders: DataFrame, partials_path: str, checkpoint: str) -> StreamingQuery:
    """Start adding the stream's new orders to the partials; stops when all
    available input is processed, ready to be started again. A new checkpoint is a new
    query that begins at the start; its partials do not mix with those of another."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        own = {"query_id": query_id(batch.sparkSession, checkpoint), "batch_id": batch_id}
        overwrite_partition(sales_partials(batch), partials_path, own)

    return (
        orders.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id that a streaming query keeps as long as it has its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def read_partials(spark: SparkSession, partials_path: str, checkpoint: str) -> DataFrame:
    """All partials of the query that has this checkpoint."""
    own = partition_path(partials_path, {"query_id": query_id(spark, checkpoint)})
    return spark.read.option("basePath", partials_path).parquet(own)


def daily_sales_from_partials(partials: DataFrame) -> DataFrame:
    """``daily_sales_summary`` over everything streamed so far."""
    return partials.groupBy("order_date").agg(
        F.sum("amount").alias("total_amount_sum"),
        (F.sum("amount").cast("double") / F.nullif(F.sum("amounts"), F.lit(0))).alias("total_amount_avg"),
        F.max("largest").alias("total_amount_max"),
        F.sum("orders").alias("order_id_count"),
        F.count_distinct("customer_id").alias("customer_id_countDistinct"),
    )


def customer_ltv_from_partials(partials: DataFrame) -> DataFrame:
    """``customer_ltv`` over everything streamed so far."""
    return partials.groupBy("customer_id").agg(
        F.sum("amount").alias("lifetime_value"),
        F.sum("rows").alias("order_count"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def compact_partials(partials: DataFrame) -> DataFrame:
    """The same partials with one row per day and customer, to be written anew when
    many small batches have piled up."""
    return partials.groupBy(*PARTIAL_KEYS).agg(
        F.sum("amount").alias("amount"),
        F.max("largest").alias("largest"),
        F.sum("amounts").alias("amounts"),
        F.sum("orders").alias("orders"),
        F.sum("rows").alias("rows"),
    )

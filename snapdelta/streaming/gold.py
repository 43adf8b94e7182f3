"""Gold tables kept current by a stream: only the partitions a batch touches are made anew.

Three tables hang together: partial results per day and customer, the daily sales made
from them (both in partitions of a month), and the customers' lifetime values (in buckets of
a hash of the customer, so a busy customer base spreads). A batch is reduced to a row
per day and customer; the months and buckets it touches are read, merged with it and written
to new folders; one version file then names, for all three tables, the folder of each
partition, and the batch. So readers see a batch in all tables or in none, a repeated
batch finds its number and changes nothing, and neither a refresh nor a read ever goes
through the partials of earlier batches.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import delete_path, new_path
from ..sinks.versions import drop_unnamed, drop_versions, read_version, version_names, write_version
from ..sources.tables import stage
from .sales import compact_partials, customer_ltv_from_partials, daily_sales_from_partials, query_id, sales_partials

PARTIALS, DAILY, CUSTOMERS = "sales_partials", "daily_sales_summary", "customer_ltv"
#: Table and the column that partitions it.
PARTITIONS = {PARTIALS: "month", DAILY: "month", CUSTOMERS: "bucket"}
BUCKETS = 16
#: Versions kept for readers that have planned already.
KEPT = 2


def _month():
    return F.date_format("order_date", "yyyyMM").cast("int")


def _bucket(buckets: int):
    return F.pmod(F.hash("customer_id"), F.lit(buckets))


def _settled(df: DataFrame) -> DataFrame:
    """Decimals in their widest type: sums of sums would widen from batch to batch."""
    wide = {f.name: T.DecimalType(38, f.dataType.scale) for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in wide.items()}) if wide else df


def merge_customers(*parts: DataFrame) -> DataFrame:
    """Lifetime values of several parts as one row per customer."""
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("customer_id").agg(
        F.sum("lifetime_value").alias("lifetime_value"),
        F.sum("order_count").alias("order_count"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    )


def read_partitions(
    spark: SparkSession, base: str, table: str, version: dict | None, only: list[int] | None = None
) -> DataFrame | None:
    """The partitions of a table that a version names, or some of them; None if it has none."""
    folders = (version or {}).get("tables", {}).get(table, {})
    column = PARTITIONS[table]
    wanted = folders if only is None else {p: f for p, f in folders.items() if int(p) in set(only)}
    if not wanted:
        return None
    root = f"{base.rstrip('/')}/{table}"
    paths = [f"{root}/{folder}/{column}={p}" for p, folder in sorted(wanted.items())]
    return spark.read.option("basePath", root).parquet(*paths).drop("version", column)


def read_gold(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A gold table as of the newest committed batch."""
    rows = read_partitions(spark, base, table, read_version(spark, base))
    if rows is None:
        raise ValueError(f"no batch has been committed below {base}")
    return rows


def refresh(batch: DataFrame, base: str, query: str, batch_id: int, buckets: int = BUCKETS) -> dict[str, list[int]]:
    """Merge one batch of orders into the gold tables; returns the partitions written per table."""
    spark = batch.sparkSession
    old = read_version(spark, base)
    if old is not None:
        if old["query"] != query:
            raise ValueError(f"{base} belongs to another query: a new checkpoint needs a new folder")
        if old["batch"] >= batch_id:
            return {}
        buckets = old["buckets"]
    staged = new_path(spark, "sales-batch")
    name = f"version={batch_id:012d}-{uuid.uuid4().hex[:8]}"
    try:
        new = stage(sales_partials(batch).withColumn("month", _month()).withColumn("bucket", _bucket(buckets)), staged)
        months = sorted(r[0] for r in new.select("month").distinct().collect())
        touched = sorted(r[0] for r in new.select("bucket").distinct().collect())
        if not months:
            return {}

        def write(rows: DataFrame, table: str) -> None:
            column = PARTITIONS[table]
            _settled(rows).hint("rebalance", column).sortWithinPartitions(column).write.partitionBy(column).parquet(f"{base.rstrip('/')}/{table}/{name}")

        known = read_partitions(spark, base, PARTIALS, old, months)
        own = new.drop("month", "bucket")
        partials = own if known is None else compact_partials(own.unionByName(known))
        write(partials.withColumn("month", _month()), PARTIALS)
        made = {PARTIALS: {str(m): name for m in months}}
        merged = read_partitions(spark, base, PARTIALS, {"tables": made}, months)
        write(daily_sales_from_partials(merged).withColumn("month", _month()), DAILY)
        values, known = customer_ltv_from_partials(own), read_partitions(spark, base, CUSTOMERS, old, touched)
        values = values if known is None else merge_customers(values, known)
        write(values.withColumn("bucket", _bucket(buckets)), CUSTOMERS)
        tables = {t: dict(f) for t, f in (old or {}).get("tables", {}).items()}
        for table, parts in ((PARTIALS, months), (DAILY, months), (CUSTOMERS, touched)):
            tables.setdefault(table, {}).update({str(p): name for p in parts})
        write_version(spark, base, f"{batch_id:012d}", {"query": query, "batch": batch_id, "buckets": buckets, "tables": tables})
    finally:
        delete_path(spark, staged)
    _tidy(spark, base)
    return {PARTIALS: months, DAILY: months, CUSTOMERS: touched}


def _tidy(spark: SparkSession, base: str) -> None:
    """Remove versions but the last ones, and folders that none of these names."""
    names = version_names(spark, base)
    drop_versions(spark, base, names[:-KEPT])
    kept = [read_version(spark, base, n) for n in names[-KEPT:]]
    for table in PARTITIONS:
        named = {f for v in kept for f in v["tables"].get(table, {}).values()}
        drop_unnamed(spark, f"{base.rstrip('/')}/{table}", named)


def stream_gold_sales(orders: DataFrame, base: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Start refreshing the gold tables with the stream's new orders; stops when all available
    input is processed, ready to be started again."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        refresh(batch, base, query_id(batch.sparkSession, checkpoint), batch_id, buckets)

    return orders.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

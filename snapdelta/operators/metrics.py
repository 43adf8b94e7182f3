"""Change, quality and business metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_date, is_blank, quality_score


def mean_of(df: DataFrame, name: str) -> Column:
    """Mean as DOUBLE. Decimals are summed exactly first, so the result does not
    depend on how rows were partitioned."""
    if isinstance(df.schema[name].dataType, T.DecimalType):
        return F.sum(name).cast("double") / F.nullif(F.count(name), F.lit(0))
    return F.mean(name)


def with_active_counts(metrics: DataFrame, state: DataFrame) -> DataFrame:
    """Adds the number of active keys per table; 0 for a table without state."""
    active = (
        state.filter(F.col("is_active") == 1)
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("total_active_records"))
    )
    return metrics.join(active, "table_name", "left").withColumn(
        "total_active_records", F.coalesce("total_active_records", F.lit(0))
    )


def change_counts(events: DataFrame) -> DataFrame:
    """Events per day, table and operation, one column each."""

    def count_of(operation: str) -> Column:
        return F.count_if(F.col("operation_type") == operation)

    return events.groupBy("ref_date", "table_name").agg(
        count_of("INSERT").alias("total_inserts"),
        count_of("UPDATE").alias("total_updates"),
        count_of("DELETE").alias("total_deletes"),
    )


def daily_change_metrics(events: DataFrame, state: DataFrame, ref_date: str | dt.date) -> DataFrame:
    """Change counts and active keys per table for one day; a table without events
    that day has no row. Both sides are aggregated before they meet."""
    day = events.filter(F.col("ref_date") == as_date(ref_date))
    return with_active_counts(change_counts(day), state).select(
        "ref_date", "table_name", "total_inserts", "total_updates", "total_deletes", "total_active_records"
    )


def blank_count(data_col: str = "data") -> Column:
    return F.count_if(is_blank(data_col))


def duplicate_count(key_col: str = "primary_key", approx: bool = False) -> Column:
    """Rows beyond the first of each key."""
    distinct = F.approx_count_distinct(key_col) if approx else F.count_distinct(key_col)
    return F.count(F.lit(1)) - distinct


def data_quality_metrics(snapshot: DataFrame, ref_date: str | dt.date, approx: bool = False) -> DataFrame:
    """Blank payloads, duplicate keys and a score per table for one day.

    The exact distinct count first groups by table *and* key, so a table with
    most of the rows is still spread out; ``approx`` saves that shuffle.
    """
    rows = snapshot.filter(F.col("ref_date") == as_date(ref_date))
    counted = rows.groupBy("table_name").agg(
        blank_count().alias("null_count"),
        duplicate_count(approx=approx).alias("duplicate_count"),
        F.count(F.lit(1)).alias("total_records"),
    )
    return counted.select(
        as_date(ref_date).alias("ref_date"),
        "table_name",
        "null_count",
        "duplicate_count",
        "total_records",
        quality_score("null_count", "duplicate_count", "total_records").alias("quality_score"),
    )


def historical_trends(metrics: DataFrame, n: int = 50) -> DataFrame:
    """The newest ``n`` metric rows, newest day first, then by table."""
    return (
        metrics.select(
            "ref_date", "table_name", "total_inserts", "total_updates", "total_deletes", "total_active_records"
        )
        .orderBy(F.desc("ref_date"), F.asc("table_name"))
        .limit(n)
    )


def aggregate_spec(df: DataFrame, group_by: Sequence[str], metrics: Mapping[str, Sequence[str]]) -> DataFrame:
    """Aggregates declared as ``{column: [sum, avg, max, min, count, countDistinct]}``,
    named ``{column}_{function}``."""
    functions = {
        "sum": F.sum,
        "avg": lambda c: mean_of(df, c),
        "max": F.max,
        "min": F.min,
        "count": F.count,
        "countDistinct": F.count_distinct,
    }
    aggs = [functions[fn](c).alias(f"{c}_{fn}") for c, fns in metrics.items() for fn in fns]
    return df.groupBy(*group_by).agg(*aggs)


# The configured sales metric.
DAILY_SALES_GROUP = ["order_date"]
DAILY_SALES_METRICS = {
    "total_amount": ["sum", "avg", "max"],
    "order_id": ["count"],
    "customer_id": ["countDistinct"],
}


def daily_sales_summary(orders: DataFrame) -> DataFrame:
    """Sales per day from ``order_id, customer_id, order_date, total_amount``."""
    return aggregate_spec(orders, DAILY_SALES_GROUP, DAILY_SALES_METRICS)


def customer_ltv(orders: DataFrame) -> DataFrame:
    """Lifetime value per customer: amount and number of orders, first and last day."""
    return orders.groupBy("customer_id").agg(
        F.sum("total_amount").alias("lifetime_value"),
        F.count(F.lit(1)).alias("order_count"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )

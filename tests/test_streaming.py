import datetime as dt
from decimal import Decimal

from snapdelta.operators.metrics import customer_ltv, daily_sales_summary
from snapdelta.streaming import sales

SCHEMA = "order_id BIGINT, customer_id BIGINT, order_date DATE, total_amount DECIMAL(18,2)"


def batch(spark, start, n):
    rows = [(i, i % 5, dt.date(2024, 1, 1 + i % 3), Decimal(i) / 4 if i % 7 else None) for i in range(start, start + n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_stream_equals_batch(spark, tmp_path, rows):
    src, out, offsets = (str(tmp_path / p) for p in ("src", "out", "offsets"))

    def refresh():
        orders = sales.read_order_stream(spark, src, SCHEMA, files_per_batch=1)
        sales.stream_daily_sales(orders, out, offsets).awaitTermination()

    batch(spark, 0, 20).coalesce(2).write.parquet(src)
    refresh()
    batch(spark, 20, 15).coalesce(1).write.mode("append").parquet(src)
    refresh()
    refresh()  # nothing new
    everything = spark.read.parquet(src)
    partials = sales.read_partials(spark, out, offsets)
    for p in (partials, sales.compact_partials(partials)):
        assert rows(sales.daily_sales_from_partials(p)) == rows(daily_sales_summary(everything))
        assert rows(sales.customer_ltv_from_partials(p)) == rows(customer_ltv(everything))


def test_new_checkpoint_on_the_same_target(spark, tmp_path, rows):
    """A query that starts again with a new checkpoint does not add to the old one's totals."""
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    batch(spark, 0, 20).coalesce(2).write.parquet(src)
    for offsets in ("first", "second"):
        orders = sales.read_order_stream(spark, src, SCHEMA, files_per_batch=1)
        sales.stream_daily_sales(orders, out, str(tmp_path / offsets)).awaitTermination()
        got = sales.daily_sales_from_partials(sales.read_partials(spark, out, str(tmp_path / offsets)))
        assert rows(got) == rows(daily_sales_summary(spark.read.parquet(src)))


def test_repeated_batch_replaces_its_partials(spark, tmp_path, rows):
    from snapdelta.sinks.layers import overwrite_partition

    out = str(tmp_path / "out")
    for _ in range(2):
        overwrite_partition(sales.sales_partials(batch(spark, 0, 10)), out, {"query_id": "q", "batch_id": 0})
    assert rows(sales.daily_sales_from_partials(spark.read.parquet(out))) == rows(
        daily_sales_summary(batch(spark, 0, 10)))

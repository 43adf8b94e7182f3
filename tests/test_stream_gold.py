"""Gold tables refreshed by a stream."""

import datetime as dt
import re
from decimal import Decimal

import pytest

from snapdelta.operators.metrics import customer_ltv, daily_sales_summary
from snapdelta.sinks.versions import read_version, version_names
from snapdelta.streaming import gold, sales

SCHEMA = "order_id BIGINT, customer_id BIGINT, order_date DATE, total_amount DECIMAL(18,2)"


def batch(spark, start, n, months=(1, 2, 3), customers=40):
    rows = [
        (i, i % customers, dt.date(2024, months[i % len(months)], 1 + i % 5), Decimal(i) / 4 if i % 7 else None)
        for i in range(start, start + n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def same(spark, base, everything, rows):
    assert rows(gold.read_gold(spark, base, gold.DAILY)) == rows(daily_sales_summary(everything))
    assert rows(gold.read_gold(spark, base, gold.CUSTOMERS)) == rows(customer_ltv(everything))


def test_stream_equals_batch(spark, tmp_path, rows):
    src, base, offsets = (str(tmp_path / p) for p in ("src", "gold", "offsets"))

    def run():
        gold.stream_gold_sales(sales.read_order_stream(spark, src, SCHEMA, files_per_batch=1), base, offsets).awaitTermination()

    batch(spark, 0, 60).coalesce(2).write.parquet(src)
    run()
    same(spark, base, spark.read.parquet(src), rows)
    batch(spark, 60, 25, months=(3, 4)).coalesce(1).write.mode("append").parquet(src)
    run()
    run()  # nothing new
    same(spark, base, spark.read.parquet(src), rows)


def test_only_touched_partitions_are_read_and_written(spark, tmp_path, rows, monkeypatch):
    base = str(tmp_path / "gold")
    first, second = batch(spark, 0, 60), batch(spark, 60, 6, months=(2,), customers=2)
    gold.refresh(first, base, "q", 0)
    before = read_version(spark, base)["tables"]
    read = []
    real = gold.read_partitions

    def spy(*args, **kw):
        df = real(*args, **kw)
        read.extend([] if df is None else df.inputFiles())
        return df

    monkeypatch.setattr(gold, "read_partitions", spy)
    touched = gold.refresh(second, base, "q", 1)
    monkeypatch.undo()
    assert touched[gold.DAILY] == [202402] and 1 <= len(touched[gold.CUSTOMERS]) <= 2
    assert {m for f in read for m in re.findall(r"month=(\d+)", f)} == {"202402"}
    assert {int(b) for f in read for b in re.findall(r"bucket=(\d+)", f)} == set(touched[gold.CUSTOMERS])
    after = read_version(spark, base)["tables"]
    for table, parts in touched.items():
        assert {int(p) for p in after[table] if after[table][p] != before[table].get(p)} == set(parts)
    same(spark, base, first.unionByName(second), rows)


def test_a_repeated_batch_changes_nothing(spark, tmp_path, rows):
    base = str(tmp_path / "gold")
    orders = batch(spark, 0, 30)
    gold.refresh(orders, base, "q", 0)
    names = version_names(spark, base)
    assert gold.refresh(orders, base, "q", 0) == {} and version_names(spark, base) == names
    same(spark, base, orders, rows)
    with pytest.raises(ValueError, match="another query"):
        gold.refresh(orders, base, "other", 1)


@pytest.mark.parametrize("step", ["write_version", "daily_sales_from_partials", "merge_customers"])
def test_a_batch_that_dies_shows_in_no_table(spark, tmp_path, rows, monkeypatch, step):
    base = str(tmp_path / "gold")
    first, second = batch(spark, 0, 30), batch(spark, 30, 12)
    gold.refresh(first, base, "q", 0)
    with monkeypatch.context() as m:
        m.setattr(gold, step, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            gold.refresh(second, base, "q", 1)
    same(spark, base, first, rows)
    gold.refresh(second, base, "q", 1)
    same(spark, base, first.unionByName(second), rows)
    # What the dead run wrote is gone, and so are versions no reader needs.
    for i in range(2, 5):
        gold.refresh(batch(spark, 30 + 12 * i, 12), base, "q", i)
    assert len(version_names(spark, base)) == gold.KEPT
    kept = [read_version(spark, base, n) for n in version_names(spark, base)]
    for table in gold.PARTITIONS:
        on_disk = {p.name for p in (tmp_path / "gold" / table).iterdir() if p.name.startswith("version=")}
        assert on_disk == {f for v in kept for f in v["tables"][table].values()}


def test_empty_batch(spark, tmp_path):
    base = str(tmp_path / "gold")
    assert gold.refresh(batch(spark, 0, 5).limit(0), base, "q", 0) == {}
    with pytest.raises(ValueError, match="no batch"):
        gold.read_gold(spark, base, gold.DAILY)

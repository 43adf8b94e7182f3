"""Bucketed indexes, state by reference and the merged ledger."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from snapdelta.operators import ledger as L
from snapdelta.operators.envelope import to_envelope
from snapdelta.plans import bronze, daily, silver
from snapdelta.plans.specs import TableSpec
from snapdelta.schemas import KEYS, SNAPSHOT_KEYS
from snapdelta.sinks import versions
from snapdelta.sinks.buckets import bucket_of, read_buckets, write_buckets

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))
ORDERS, ITEMS = TableSpec("o", "ORDERS", None, "files", ("id",)), TableSpec("i", "ITEMS", None, "files", ("id",))


def table(spark, n, changed=()):
    v = F.when(F.col("id").isin(*changed), "new").otherwise("old") if changed else F.lit("old")
    return spark.range(n).select(F.col("id"), v.alias("v"))


def run(spark, base, day, specs=(ORDERS, ITEMS), **tables):
    return daily.run_day(spark, lambda s: tables[s.name], specs, base, day, buckets=16)


def files_below(path):
    return {str(p.relative_to(path)): p.stat().st_size for p in path.rglob("*.parquet")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_versions_commit_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.read_version(spark, path) is None and versions.next_name(spark, path, "2024-01-02") == "2024-01-02-000000000"
    for n in range(12):
        versions.write_version(spark, path, versions.next_name(spark, path), {"n": n, "text": "é"})
    assert versions.read_version(spark, path) == {"n": 11, "text": "é"} and len(versions.version_names(spark, path)) == 12
    with pytest.raises(OSError):
        versions.write_version(spark, path, versions.version_names(spark, path)[0], {})
    assert not [p for p in (tmp_path / "t" / "_versions").iterdir() if p.name.startswith(".new")]


def test_days_are_compared_without_moving_a_row(spark, tmp_path, no_broadcast):
    base = str(tmp_path)
    run(spark, base, D1, [ORDERS], o=table(spark, 2000))
    run(spark, base, D2, [ORDERS], o=table(spark, 2000, range(0, 2000, 3)))
    cur, prev = (silver.key_index(spark, base, d) for d in (D2, D1))
    found = silver.indexed_delta(spark, base, cur, prev, ["ORDERS"], D2)
    text = plan(found)
    assert "SortMergeJoin" in text and "Exchange" not in text and not re.search(r"\bSort \[", text)
    assert found.count() == 667
    # Another number of buckets still compares, with a shuffle.
    silver.write_key_index(spark, base, D2, 8)
    other = silver.indexed_delta(spark, base, silver.key_index(spark, base, D2), prev, ["ORDERS"], D2)
    assert "Exchange" in plan(other) and other.exceptAll(found).isEmpty() and other.count() == 667


def test_only_buckets_that_differ_are_read(spark, tmp_path, rows):
    base = str(tmp_path)
    ids = [r["id"] for r in spark.range(3000).withColumn("primary_key", F.col("id").cast("string")).withColumn("table_name", F.lit("ORDERS"))
           .withColumn("b", bucket_of(KEYS, 16)).filter("b = 5").limit(4).collect()]
    run(spark, base, D1, o=table(spark, 3000), i=table(spark, 500))
    run(spark, base, D2, o=table(spark, 3000, ids), i=table(spark, 500))
    cur, prev = (silver.key_index(spark, base, d) for d in (D2, D1))
    found = silver.indexed_delta(spark, base, cur, prev, ["ORDERS", "ITEMS"], D2)
    # Files of other buckets are junk from here on: whoever reads one fails.
    for index in (cur, prev):
        for path in (tmp_path / "bronze" / "snapshot_keys" / index["folder"] / "rows").glob("*.parquet"):
            if "_00005.c000" not in path.name:
                path.write_bytes(b"junk" * 100)
                path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    found = silver.indexed_delta(spark, base, cur, prev, ["ORDERS", "ITEMS"], D2)
    assert found.count() == 4
    with pytest.raises(Exception, match="parquet|Parquet|FAILED_READ"):
        silver.read_key_index(spark, base, cur).collect()
    read = silver.read_key_index(spark, base, cur, [5])
    assert read.select(bucket_of(KEYS, 16).alias("b")).distinct().collect() == [(5,)]
    assert rows(silver.read_events(spark, base, D2), "primary_key", "operation_type") == sorted((str(i), "UPDATE") for i in ids)
    assert silver.indexed_delta(spark, base, cur, prev, ["ITEMS"], D2) is None


def test_keys_with_many_rows(spark, tmp_path, rows):
    """A key that a third of all rows share is one row of the index; its newest hash counts."""
    base = str(tmp_path)
    one = spark.range(300).selectExpr("IF(id < 100, 0, id) AS id", "CAST(id AS STRING) AS v")
    run(spark, base, D1, [ORDERS], o=one)
    index = silver.key_index(spark, base, D1)
    got = silver.read_key_index(spark, base, index)
    assert rows(got.filter("copies > 1"), "primary_key", "copies") == [("0", 100)] and got.count() == 201
    assert silver.read_events(spark, base, D1).count() == 201 == silver.read_state(spark, base, D1).count()
    run(spark, base, D2, [ORDERS], o=one)
    assert silver.read_events(spark, base, D2).isEmpty()


def test_state_is_named_not_copied(spark, tmp_path, rows):
    base = str(tmp_path)
    state = tmp_path / "silver" / "current_state"
    run(spark, base, D1, o=table(spark, 100), i=table(spark, 50))
    first = files_below(state)
    # Items are not loaded, orders have no change: nothing is written.
    run(spark, base, D2, [ORDERS], o=table(spark, 100))
    assert files_below(state) == first
    got = silver.read_state(spark, base, D2)
    assert rows(got.groupBy("table_name", "last_seen_date", "is_active").count()) == [("ITEMS", D1, 1, 50), ("ORDERS", D2, 1, 100)]
    # Orders change: only their rows are written, and the older day reads as before.
    run(spark, base, D3, [ORDERS], o=table(spark, 90, [3]))
    added = set(files_below(state)) - set(first)
    assert added and all("table_name=ORDERS" in f for f in added)
    got = silver.read_state(spark, base, D3).filter("table_name = 'ORDERS'")
    assert rows(got.groupBy("last_seen_date", "is_active").count()) == [(D2, 0, 10), (D3, 1, 90)]
    assert silver.read_state(spark, base, D2).filter("is_active = 1").count() == 150


def test_the_state_is_scanned_once_and_its_inactive_rows_again(spark, tmp_path):
    base = str(tmp_path)
    run(spark, base, D1, [ORDERS], o=table(spark, 100))
    entries = silver.state_version(spark, base)["tables"]
    from snapdelta.operators.state import apply_delta

    events = silver.read_events(spark, base, D1)
    text = plan(apply_delta(silver.read_state_tables(spark, base, entries), events, D2))
    scans = [line for line in re.findall(r"FileScan parquet.*", text) if "first_seen_date" in line or "is_active" in line]
    assert len(scans) == 2 and sum("EqualTo(is_active,0)" in s for s in scans) == 1


def test_a_state_that_dies_is_not_read(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    run(spark, base, D1, [ORDERS], o=table(spark, 10))
    with monkeypatch.context() as m:
        m.setattr(silver, "write_version", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run(spark, base, D2, [ORDERS], o=table(spark, 5))
    assert silver.state_version(spark, base)["date"] == str(D1) and silver.read_state(spark, base, D2).isEmpty()
    run(spark, base, D2, [ORDERS], o=table(spark, 5))
    assert silver.read_state(spark, base, D2).filter("is_active = 0").count() == 5


def test_buckets_hold_what_was_written(spark, tmp_path, rows):
    df = spark.range(200).selectExpr("IF(id % 2 = 0, 'a', 'b') AS table_name", "CAST(id AS STRING) AS primary_key", "'h' AS row_hash", "id AS copies")
    path = str(tmp_path / "x")
    write_buckets(df, path, KEYS, 7)
    back = read_buckets(spark, path, SNAPSHOT_KEYS, KEYS, 7)
    assert rows(back) == rows(df)
    parts = [read_buckets(spark, path, SNAPSHOT_KEYS, KEYS, 7, [b]) for b in range(7)]
    assert sum(p.count() for p in parts) == 200
    assert read_buckets(spark, path, SNAPSHOT_KEYS, KEYS, 7, []).isEmpty()


# --- ledger --------------------------------------------------------------------------------


def load(day, n, status=L.SUCCESS):
    return L.ledger_row(day, "s", f"t{n % 3}", status, L.now(), row_count=n)


def test_reading_the_ledger_does_not_slow_down(spark, tmp_path):
    path = str(tmp_path / "ledger")
    longest, recorded = 0, []
    for n in range(100):
        day = D1 + dt.timedelta(days=n // 4)
        recorded.append((day, f"t{n % 3}", n))
        L.record_ingestion(spark, path, [load(day, n)])
        if n % 20 == 19 or n > 90:
            longest = max(longest, len(L.log_paths(spark, path, [day, day - dt.timedelta(days=1)])))
    assert longest <= L.TAIL_FILES + 2
    got = L.read_ledger(spark, path)
    assert sorted((r.ref_date, r.table_name, r.row_count) for r in got.collect()) == sorted(recorded)
    some = L.read_ledger(spark, path, [D1]).filter(F.col("ref_date") == D1)
    assert some.count() == 4
    assert len(versions.version_names(spark, path)) == 1


@pytest.mark.parametrize("step", ["write_version", "_tidy"])
def test_a_merge_that_dies_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "ledger")
    monkeypatch.setattr(L, "TAIL_FILES", 3)
    n = 0
    for _ in range(3):
        L.record_ingestion(spark, path, [load(D1, n := n + 1), load(D2, n := n + 1)])
    with monkeypatch.context() as m:
        m.setattr(L, step, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            L.record_ingestion(spark, path, [load(D1, n := n + 1)])
    assert sorted(r.row_count for r in L.read_ledger(spark, path).collect()) == list(range(1, n + 1))
    for _ in range(6):
        L.record_ingestion(spark, path, [load(D2, n := n + 1)])
    assert sorted(r.row_count for r in L.read_ledger(spark, path).collect()) == list(range(1, n + 1))
    assert L.forget_days(spark, path, D2) == [str(D1)]
    assert {r.ref_date for r in L.read_ledger(spark, path).collect()} == {D2}

"""Physical plans: how often data moves and what is read."""

import re

import pytest
from pyspark.sql import functions as F

from snapdelta.operators import delta, metrics, state
from snapdelta.sources.tables import stage

DAY, BEFORE = "2024-01-02", "2024-01-01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return text.count("Exchange hashpartitioning") + text.count("Exchange SinglePartition")


def scans(text):
    return re.findall(r"ReadSchema: struct<(.*?)>", text)


@pytest.fixture(scope="module")
def stored(spark):
    """Snapshots of two days and the state after the first, read from files."""
    from snapdelta.operators.envelope import to_envelope

    df = spark.range(500).selectExpr("CAST(id AS STRING) AS id", "CAST(id % 7 AS STRING) AS a")
    prev = stage(to_envelope(df, "t", ["id"], BEFORE))
    cur = stage(to_envelope(df.withColumn("a", F.when(F.col("id") < "2", "x").otherwise(F.col("a"))), "t", ["id"], DAY))
    return cur, prev, stage(state.state_from_history(prev, BEFORE))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_detect_delta_shuffles_each_snapshot_once(stored, no_broadcast):
    cur, prev, _ = stored
    merged = plan(delta.detect_delta(cur, prev, DAY))
    assert shuffles(merged) == 1 and "Join" not in merged
    joined = plan(delta.detect_delta(cur, prev, DAY, unique_keys=True))
    assert shuffles(joined) == 2 and "FullOuter" in joined


def test_counting_events_reads_no_payload(stored):
    cur, prev, _ = stored
    for unique in (True, False):
        text = plan(delta.delta_summary(delta.detect_delta(cur, prev, DAY, unique), DAY))
        assert len(scans(text)) == 2 and not any("data:" in s for s in scans(text))


def test_small_events_do_not_move_the_state(stored):
    cur, prev, old = stored
    events = stage(delta.detect_delta(cur, prev, DAY))
    text = plan(state.apply_delta(old, events, DAY))
    assert shuffles(text) == 0 and "SortMergeJoin" not in text


def test_small_events_fetch_payloads_without_moving_the_rest(stored):
    cur, prev, _ = stored
    events = stage(delta.detect_delta(cur.drop("data"), prev.drop("data"), DAY))
    text = plan(delta.attach_payload(events, cur, prev))
    # The only shuffle brings the two payloads of an event together, after the join.
    assert shuffles(text) == 1 and text.index("Exchange hashpartitioning") < text.index("BroadcastHashJoin")
    assert "SortMergeJoin" not in text


def test_large_events_and_payloads_meet_in_two_shuffles(stored, no_broadcast):
    cur, prev, _ = stored
    events = stage(delta.detect_delta(cur.drop("data"), prev.drop("data"), DAY))
    filled = delta.attach_payload(events, cur, prev)
    # The events and both days' payloads; the aggregation after the join adds none.
    assert shuffles(plan(filled)) == 2 and "SortMergeJoin" in plan(filled)
    assert sorted(filled.collect()) == sorted(delta.detect_delta(cur, prev, DAY).collect())


def test_envelopes_are_sorted_as_the_source_has_them_and_stored_small(spark, tmp_path, monkeypatch):
    from snapdelta.plans import bronze
    from snapdelta.plans.specs import TableSpec

    written = []
    write = bronze.overwrite_partition
    monkeypatch.setattr(bronze, "overwrite_partition", lambda df, *a: written.append(df) or write(df, *a))
    source = spark.range(300).selectExpr("CAST(299 - id AS STRING) AS id", "CAST(id AS STRING) AS a").coalesce(1)
    spec = TableSpec("t", "t", source_type="files", primary_keys=("id",))
    assert bronze.ingest_envelope(lambda _: source, spec, str(tmp_path), DAY) == 300
    text = plan(written[0])
    assert 0 <= text.index("sha2(") < text.index("Sort [")
    files = list(tmp_path.rglob("*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
    keys = [r.primary_key for r in spark.read.parquet(*map(str, files)).collect()]
    assert keys == sorted(keys) and len(keys) == 300


def test_maintaining_state_shares_the_partitioning(stored, no_broadcast):
    cur, _, old = stored
    assert shuffles(plan(state.maintain_current_state(old, cur, DAY))) == 2


def test_distinct_keys_spread_over_table_and_key(stored):
    text = plan(metrics.data_quality_metrics(stored[0], DAY))
    assert re.search(r"Exchange hashpartitioning\(table_name#\d+, primary_key#\d+", text)


def test_latest_by_key_has_no_window(stored):
    text = plan(state.latest_by_key(stored[0], ["table_name", "primary_key"], ["ingestion_timestamp"]))
    assert "Window" not in text and shuffles(text) == 1


def test_filters_and_columns_reach_the_scan(spark):
    import __spark_entry__ as entry

    text = plan(entry.queries()["retained_rows"](spark, "/root/testdata/sf0.001"))
    assert scans(text) == ["o_orderkey:bigint,o_orderdate:timestamp_ntz"] and "PushedFilters: [" in text
    text = plan(entry.queries()["count_distinct"](spark, "/root/testdata/sf0.001"))
    assert scans(text) == ["l_partkey:bigint"]

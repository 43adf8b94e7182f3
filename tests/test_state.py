import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapdelta.operators import delta, state
from snapdelta.schemas import CURRENT_STATE
from test_delta import random_days

COLS = ["table_name", "primary_key", "row_hash", "data", "first_seen_date", "last_seen_date", "is_active"]


def stamp(day):
    return F.lit(f"{day} 12:00:00").cast("timestamp")


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_folding_days_equals_history(spark, rows, seed):
    history = random_days(spark, seed, dup=seed != 12).cache()
    folded = by_events = spark.createDataFrame([], CURRENT_STATE)
    prev = history.filter("false")
    for i in range(1, 5):
        day = f"2024-01-{i:02d}"
        cur = history.filter(F.col("ref_date") == F.lit(day).cast("date"))
        folded = state.maintain_current_state(folded, cur, day, stamp(day))
        by_events = state.apply_delta(by_events, delta.detect_delta(cur, prev, day), day, stamp(day))
        folded = spark.createDataFrame(folded.collect(), CURRENT_STATE)
        by_events = spark.createDataFrame(by_events.collect(), CURRENT_STATE)
        assert rows(folded) == rows(by_events)
        assert rows(folded, *COLS) == rows(state.state_from_history(history, day), *COLS)
        prev = cur


def test_reappearing_key(spark, snap, rows):
    st = spark.createDataFrame([], CURRENT_STATE)
    for day, data in (("2024-01-01", [("1", "a", "")]), ("2024-01-02", []), ("2024-01-03", [("1", "b", "")])):
        st = state.maintain_current_state(st, snap(data, day), day, stamp(day))
        if day == "2024-01-02":
            assert rows(st, "is_active", "last_seen_date") == [(0, dt.date(2024, 1, 1))]
    assert rows(st, "is_active", "first_seen_date", "last_seen_date") == [
        (1, dt.date(2024, 1, 1), dt.date(2024, 1, 3))]


def test_append_keeps_deleted_keys_active(snap, rows):
    first = state.append_current_state(snap([("1", "a", ""), ("2", "a", "")], "2024-01-01"), stamp("2024-01-01"))
    second = state.append_current_state(snap([("1", "b", "")], "2024-01-02"), stamp("2024-01-02"))
    got = state.collapse_latest(first.unionByName(second), ["table_name", "primary_key"], "updated_at")
    assert rows(got, "primary_key", "first_seen_date", "is_active") == [
        ("1", dt.date(2024, 1, 2), 1), ("2", dt.date(2024, 1, 1), 1)]


def test_collapse_sum_doubles_on_rerun(spark, rows):
    df = spark.createDataFrame([("d", "t", 1, 2)], "ref_date STRING, table_name STRING, a BIGINT, b BIGINT")
    for runs in (1, 2, 3):
        again = df
        for _ in range(runs - 1):
            again = again.unionByName(df)
        assert rows(state.collapse_sum(again, ["ref_date", "table_name"], ["a", "b"])) == [("d", "t", runs, 2 * runs)]


def test_latest_by_key_is_deterministic(spark, rows):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (1, 4, "z"), (2, None, "n")], "k INT, v INT, p STRING")
    assert rows(state.latest_by_key(df, ["k"], ["v"])) == [(1, 5, "y"), (2, None, "n")]
    assert rows(state.latest_by_key(df, ["k"], ["v"], latest=False)) == [(1, 4, "z"), (2, None, "n")]
    assert state.latest_by_key(df, ["k"], ["v"]).columns == df.columns


def test_latest_by_key_carries_maps(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1, map('a', 1)), (1, 2, map('b', 2)), (2, 5, map('c', 3)) AS t(k, v, m)")
    got = {r["k"]: (r["v"], r["m"]) for r in state.latest_by_key(df, ["k"], ["v"]).collect()}
    assert got == {1: (2, {"b": 2}), 2: (5, {"c": 3})}
    assert state.latest_by_key(df, ["k"], ["v"], latest=False).filter("k = 1").first()["v"] == 1

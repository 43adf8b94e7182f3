import random

import pytest
from pyspark.sql import functions as F

from snapdelta.operators import delta
from snapdelta.operators.envelope import to_envelope

DAY, BEFORE = "2024-01-02", "2024-01-01"


def ops(df):
    return sorted((r.operation_type, r.primary_key) for r in df.collect())


def test_insert_update_delete_unchanged(snap):
    cur = snap([("1", "x", "y"), ("2", "x", "z"), ("4", "n", "n")], DAY)
    prev = snap([("1", "x", "y"), ("2", "x", "y"), ("3", "x", "y")], BEFORE)
    events = delta.detect_delta(cur, prev, DAY)
    assert events.columns == delta.EVENT_COLUMNS
    assert ops(events) == [("DELETE", "3"), ("INSERT", "4"), ("UPDATE", "2")]
    by_op = {r.operation_type: r for r in events.collect()}
    assert by_op["INSERT"].row_hash_before is None and by_op["INSERT"].data_before is None
    assert by_op["INSERT"].data_after == '{"id":"4","a":"n","b":"n"}'
    assert by_op["DELETE"].row_hash_after is None and by_op["DELETE"].data_after is None
    assert by_op["DELETE"].data_before == '{"id":"3","a":"x","b":"y"}'
    assert by_op["UPDATE"].data_before != by_op["UPDATE"].data_after
    assert {str(r.ref_date) for r in by_op.values()} == {DAY}


def test_null_shift(snap):
    before, after = [("1", None, "y")], [("1", "y", None)]
    assert delta.detect_delta(snap(after), snap(before, BEFORE), DAY).isEmpty()
    safe = delta.detect_delta(snap(after, null_safe=True), snap(before, BEFORE, null_safe=True), DAY)
    assert ops(safe) == [("UPDATE", "1")]


def test_missed_day_inserts_everything(snap):
    cur = snap([("1", "a", "b"), ("2", "a", "b"), ("3", "a", "b")])
    assert [o for o, _ in ops(delta.detect_delta(cur, cur.filter("false"), DAY))] == ["INSERT"] * 3
    assert [o for o, _ in ops(delta.detect_delta(cur.filter("false"), cur, DAY))] == ["DELETE"] * 3


def test_composite_key(snap):
    cur, prev = snap([("A", "2", "x")], keys=("id", "a")), snap([("A", "1", "x")], BEFORE, keys=("id", "a"))
    assert ops(delta.detect_delta(cur, prev, DAY)) == [("DELETE", "A|||1"), ("INSERT", "A|||2")]


def test_same_key_in_two_tables(snap):
    events = delta.detect_delta(snap([("1", "x", "y")], table="t2"), snap([("1", "x", "y")], BEFORE, "t1"), DAY)
    assert sorted((r.table_name, r.operation_type) for r in events.collect()) == [("t1", "DELETE"), ("t2", "INSERT")]


def test_duplicate_keys_give_one_event_per_key(snap):
    cur = snap([("1", "c", ""), ("1", "d", ""), ("2", "s", "")])
    prev = snap([("1", "a", ""), ("1", "b", ""), ("2", "s", ""), ("2", "s", "")], BEFORE)
    assert ops(delta.detect_delta(cur, prev, DAY)) == [("UPDATE", "1")]
    # Counts of a row-by-row comparison, without its pairs.
    assert tuple(delta.row_pair_counts(cur, prev).first()) == ("t", 0, 4, 0)


def test_versions_are_lossless(snap, rows):
    cur = snap([("1", "a", ""), ("1", "a", ""), ("1", "b", "")])
    prev = snap([("1", "a", "")], BEFORE)
    got = rows(delta.delta_versions(cur, prev), "primary_key", "rows_before", "rows_after")
    assert got == [("1", 0, 1), ("1", 1, 2)]


def test_newest_load_wins(spark, snap):
    early = snap([("1", "z", "")]).withColumn("ingestion_timestamp", F.lit("2024-01-02 01:00:00").cast("timestamp"))
    late = snap([("1", "a", "")]).withColumn("ingestion_timestamp", F.lit("2024-01-02 02:00:00").cast("timestamp"))
    kept = delta.one_row_per_key(early.unionByName(late)).first()
    assert kept.data == '{"id":"1","a":"a","b":""}'


def random_days(spark, seed, n_days=4, n_keys=12, dup=True):
    rng = random.Random(seed)
    data = []
    for day in range(n_days):
        for key in range(n_keys):
            if rng.random() < 0.6:
                for _ in range(rng.choice([1, 1, 1, 2]) if dup else 1):
                    data.append((f"2024-01-{day + 1:02d}", f"t{key % 2}", str(key), rng.choice("abc")))
    df = spark.createDataFrame(data, "ref_date STRING, table_name STRING, primary_key STRING, v STRING")
    return df.select(
        F.col("ref_date").cast("date").alias("ref_date"), "table_name", "primary_key",
        F.sha2("v", 256).alias("row_hash"), F.to_json(F.struct("v")).alias("data"),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_all_forms_agree(spark, rows, seed):
    history = random_days(spark, seed).cache()
    days = [f"2024-01-{d:02d}" for d in (2, 3, 4)]
    pick = lambda d: history.filter(F.col("ref_date") == F.lit(d).cast("date"))
    one_pass, late = [], []
    for before, day in zip(["2024-01-01", *days], days, strict=False):
        cur, prev = pick(day), pick(before)
        events = delta.detect_delta(cur, prev, day)
        one_pass += rows(events)
        assert rows(delta.split_delta(cur, prev, day)) == rows(events)
        found = delta.detect_delta(cur.drop("data"), prev.drop("data"), day)
        late += rows(delta.attach_payload(found, cur, prev))
    assert sorted(late, key=str) == sorted(one_pass, key=str)
    assert rows(delta.detect_delta_range(history, days[0], days[-1])) == sorted(one_pass, key=str)


@pytest.mark.parametrize("seed", [3, 4])
def test_pair_counts_equal_brute_force(spark, rows, seed):
    history = random_days(spark, seed)
    cur, prev = history.filter("ref_date = '2024-01-02'"), history.filter("ref_date = '2024-01-01'")
    cur.createOrReplaceTempView("c")
    prev.createOrReplaceTempView("p")
    want = spark.sql("""
        SELECT coalesce(c.table_name, p.table_name), count_if(p.primary_key IS NULL),
               count_if(c.row_hash <> p.row_hash), count_if(c.primary_key IS NULL)
        FROM c FULL JOIN p ON c.table_name = p.table_name AND c.primary_key = p.primary_key GROUP BY 1""")
    assert rows(delta.row_pair_counts(cur, prev)) == rows(want)


def test_invariants_for_unique_keys(spark):
    history = random_days(spark, 7, dup=False)
    cur, prev = history.filter("ref_date = '2024-01-02'"), history.filter("ref_date = '2024-01-01'")
    events = delta.detect_delta(cur, prev, DAY, unique_keys=True)
    n = {r.operation_type: r.total for r in delta.delta_summary(events, DAY).collect()}
    same = cur.join(prev, ["table_name", "primary_key", "row_hash"], "left_semi").count()
    assert n.get("INSERT", 0) + n.get("UPDATE", 0) + same == cur.count()
    assert prev.count() - n.get("DELETE", 0) + n.get("INSERT", 0) == cur.count()
    assert delta.operation_count(events, DAY, "t0", "INSERT").first().total == events.filter(
        "table_name = 't0' AND operation_type = 'INSERT'").count()


def test_range_skips_days_without_snapshot(spark):
    df = spark.createDataFrame([("2024-01-01", "1"), ("2024-01-03", "1")], "d STRING, id STRING")
    history = to_envelope(df.select(F.col("d").cast("date").alias("ref_date"), "id"), "t", ["id"], F.col("ref_date"))
    listed = delta.detect_delta_range(history).collect()
    assert sorted((str(r.ref_date), r.operation_type) for r in listed) == [
        ("2024-01-01", "INSERT"), ("2024-01-03", "INSERT")]
    full = delta.detect_delta_range(history, "2024-01-01", "2024-01-03").collect()
    assert sorted((str(r.ref_date), r.operation_type) for r in full) == [
        ("2024-01-01", "INSERT"), ("2024-01-02", "DELETE"), ("2024-01-03", "INSERT")]


def test_hot_key_reaches_the_join_once(spark):
    """A third of the rows share a key; neither side sends more than one row of it."""
    df = spark.range(3000).select(
        F.lit("t").alias("table_name"),
        F.when(F.col("id") < 1000, "hot").otherwise(F.col("id").cast("string")).alias("primary_key"),
        F.sha2(F.col("id").cast("string"), 256).alias("row_hash"),
    )
    events = delta.detect_delta(df, df.withColumn("row_hash", F.sha2("row_hash", 256)), DAY)
    assert events.count() == 2001
    assert events.filter("primary_key = 'hot'").count() == 1


def test_union_events_fills_missing_columns(snap):
    a = snap([("1", "a", "b")]).select("table_name", "primary_key")
    b = snap([("2", "a", "b")]).select("table_name", "primary_key", "row_hash")
    assert delta.union_events(a, b).columns == ["table_name", "primary_key", "row_hash"]


@pytest.mark.parametrize("unique", [True, False])
def test_missing_hash_is_a_value_not_an_absence(spark, unique):
    schema = "table_name STRING, primary_key STRING, row_hash STRING"
    cur = spark.createDataFrame([("t", "1", None), ("t", "2", "h"), ("t", "3", None)], schema)
    prev = spark.createDataFrame([("t", "1", None), ("t", "2", None)], schema)
    assert ops(delta.detect_delta(cur, prev, DAY, unique)) == [("INSERT", "3"), ("UPDATE", "2")]


def test_payloads_leave_no_event_behind(spark, snap):
    """A missing hash is a value; an event whose payload is gone stays without one."""
    cur = snap([("1", "a", "x"), ("2", "b", "x")], DAY).withColumn("row_hash", F.expr("IF(primary_key = '1', NULL, row_hash)"))
    prev = snap([("1", "z", "x"), ("3", "c", "x")], BEFORE)
    found = delta.detect_delta(cur.drop("data"), prev.drop("data"), DAY)
    got = delta.attach_payload(found, cur, prev.filter("primary_key <> '3'"))
    data = {r["primary_key"]: (r["operation_type"], r["data_before"], r["data_after"]) for r in got.collect()}
    assert data["1"] == ("UPDATE", '{"id":"1","a":"z","b":"x"}', '{"id":"1","a":"a","b":"x"}')
    assert data["2"][0] == "INSERT" and data["2"][1] is None and data["2"][2] is not None
    assert data["3"] == ("DELETE", None, None)

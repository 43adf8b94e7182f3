import datetime as dt
from decimal import Decimal

from snapdelta.operators import aggregates, metrics, profile
from snapdelta.schemas import CURRENT_STATE, DELTA_EVENTS

DAY = "2024-01-02"


def events(spark, ops):
    data = [(dt.date(2024, 1, 2), t, str(i), o) for i, (t, o) in enumerate(ops)]
    return spark.createDataFrame(data, "ref_date DATE, table_name STRING, primary_key STRING, operation_type STRING")


def test_change_metrics(spark, rows):
    ev = events(spark, [("a", "INSERT"), ("a", "INSERT"), ("a", "DELETE"), ("b", "UPDATE")])
    st = spark.createDataFrame([("a", "1", 1), ("a", "2", 0), ("c", "1", 1)],
                               "table_name STRING, primary_key STRING, is_active INT")
    got = rows(metrics.daily_change_metrics(ev, st, DAY), "table_name", "total_inserts", "total_updates",
               "total_deletes", "total_active_records")
    # c has no events and no row; b has no state and counts 0.
    assert got == [("a", 2, 0, 1, 1), ("b", 0, 1, 0, 0)]
    assert metrics.daily_change_metrics(ev, st, "2024-01-03").isEmpty()
    trends = metrics.historical_trends(metrics.daily_change_metrics(ev, st, DAY), 1)
    assert [r.table_name for r in trends.collect()] == ["a"]


def test_quality_metrics(spark):
    data = [(dt.date(2024, 1, 2), "t", "1", "x"), (dt.date(2024, 1, 2), "t", "1", ""),
            (dt.date(2024, 1, 2), "t", "2", None), (dt.date(2024, 1, 1), "t", "9", "x")]
    df = spark.createDataFrame(data, "ref_date DATE, table_name STRING, primary_key STRING, data STRING")
    for approx in (False, True):
        r = metrics.data_quality_metrics(df, DAY, approx).first()
        assert (r.null_count, r.duplicate_count, r.total_records, r.quality_score) == (2, 1, 3, 0.0)


def test_approximate_duplicates_are_close(spark):
    df = spark.range(100000).selectExpr("DATE'2024-01-02' AS ref_date", "'t' AS table_name",
                                        "CAST(id % 50000 AS STRING) AS primary_key", "'x' AS data")
    r = metrics.data_quality_metrics(df, DAY, approx=True).first()
    assert abs(r.duplicate_count - 50000) < 50000 * 0.15


def test_sales_and_ltv(spark, rows):
    df = spark.createDataFrame(
        [(1, 7, dt.date(2024, 1, 1), Decimal("10.00")), (2, 7, dt.date(2024, 1, 1), Decimal("5.01")),
         (3, 8, dt.date(2024, 1, 2), None)],
        "order_id BIGINT, customer_id BIGINT, order_date DATE, total_amount DECIMAL(18,2)")
    daily = metrics.daily_sales_summary(df)
    assert daily.columns == ["order_date", "total_amount_sum", "total_amount_avg", "total_amount_max",
                             "order_id_count", "customer_id_countDistinct"]
    assert rows(daily) == [
        (dt.date(2024, 1, 1), Decimal("15.01"), 7.505, Decimal("10.00"), 2, 1),
        (dt.date(2024, 1, 2), None, None, None, 1, 1)]
    assert rows(metrics.customer_ltv(df)) == [
        (7, Decimal("15.01"), 2, dt.date(2024, 1, 1), dt.date(2024, 1, 1)),
        (8, None, 1, dt.date(2024, 1, 2), dt.date(2024, 1, 2))]


def test_counts(spark, rows):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), ("z", 1)], "g STRING, v INT")
    assert [tuple(r) for r in aggregates.group_count_desc(df, "g").collect()] == [("x", 2), ("y", 1), ("z", 1)]
    assert [tuple(r) for r in aggregates.top_groups(df, "g", 1).collect()] == [("x", 2)]
    assert aggregates.row_count(df).first()[0] == 4
    assert aggregates.count_distinct(df, "v").first()[0] == 2
    assert rows(aggregates.distinct_values(df, "v")) == [(1,), (2,)]
    assert [r.g for r in aggregates.sorted_names(df, "g").collect()] == ["x", "x", "y", "z"]
    assert aggregates.sample_rows(df, 3).count() == 3
    tables = spark.createDataFrame([("o", "t"), ("o", "t"), ("o", "u"), ("p", "t")], "owner STRING, table_name STRING")
    assert rows(aggregates.tables_per_owner(tables)) == [("o", 3, 2), ("p", 1, 1)]


def test_observed_count_fills_during_the_write(spark, tmp_path):
    df, seen = aggregates.observed_count(spark.range(10), "n")
    df.write.parquet(str(tmp_path / "x"))
    assert seen.get["row_count"] == 10


def test_deduplicate(spark, rows):
    df = spark.createDataFrame([("h", 1), ("h", 2), ("g", 3)], "row_hash STRING, v INT")
    assert aggregates.drop_duplicates_by_hash(df).count() == 2
    assert rows(aggregates.drop_duplicates_by_hash(df, order_by=["v"])) == [("g", 3), ("h", 2)]


def test_reconcile(spark, rows):
    a = spark.createDataFrame([(Decimal("1.10"),), (Decimal("2.20"),)], "x DECIMAL(10,2)")
    assert rows(aggregates.reconcile(a, a, ["x"])) == [("row_count", 2.0, 2.0, True), ("x_sum", 3.3, 3.3, True)]
    assert rows(aggregates.reconcile(a, a.limit(0), ["x"])) == [
        ("row_count", 2.0, 0.0, False), ("x_sum", 3.3, 0.0, False)]


def test_profile(spark):
    df = spark.range(1, 1002).selectExpr("id", "CAST(id AS DECIMAL(10,2)) AS d", "'s' AS s")
    wide = profile.column_statistics(df).first().asDict()
    assert wide["row_count"] == 1001 and wide["id_min"] == 1 and wide["id_max"] == 1001 and wide["id_mean"] == 501.0
    assert abs(wide["id_p50"] - 501) <= 1 and abs(wide["id_std"] - 289.1081) < 1e-3 and "s_p50" not in wide
    long = {r.column_name: r for r in profile.column_statistics_long(df).collect()}
    assert set(long) == {"id", "d"} and long["d"].mean == 501.0
    parts = profile.profile_table(df, 5)
    assert parts["sample"].count() == 5 and parts["columns"].count() == 3
    assert [r.column_name for r in parts["columns"].orderBy("column_id").collect()] == ["id", "d", "s"]
    texts = profile.profile_table(df.select("s"))
    assert texts["statistics"].first().asDict() == {"row_count": 1001}
    empty = profile.explore_table(df.limit(0))
    assert empty["row_count"].first()[0] == 0 and empty["sample"].isEmpty()


def test_median_error_is_bounded(spark):
    """The approximate median's rank is within 1/accuracy of the middle."""
    df = spark.range(200000).selectExpr("(id * 7919) % 200003 AS v")
    p50 = profile.column_statistics(df, ["v"], accuracy=1000).first()["v_p50"]
    assert abs(df.filter(df.v <= p50).count() / 200000 - 0.5) <= 1 / 1000


def test_schemas_parse(spark):
    from snapdelta.schemas import MEDALLION, RUN_METRICS, column_names, struct_of

    for layer in MEDALLION.values():
        for ddl, _ in layer.values():
            assert struct_of(ddl).names == column_names(ddl)
    assert struct_of(RUN_METRICS).names[-1] == "duration_seconds"
    assert struct_of(DELTA_EVENTS).names[3] == "operation_type" and "is_active" in struct_of(CURRENT_STATE).names


def test_reconcile_compares_exact_totals(spark, rows):
    side = lambda v: spark.sql(f"SELECT CAST('{v}' AS DECIMAL(20,2)) AS amount")
    got = aggregates.reconcile(side("9007199254740993.00"), side("9007199254740992.00"), ["amount"])
    assert rows(got, "metric", "matched") == [("amount_sum", False), ("row_count", True)]


def test_exact_median(spark):
    from snapdelta.operators.profile import exact_median

    for values in ([5], [4, 1, 3, 2], [7] * 50 + [1, 2, 9], [None, 3, None, 1, 2], list(range(1001))):
        got = sorted(v for v in values if v is not None)
        df = spark.createDataFrame([(v,) for v in values], "v BIGINT")
        assert exact_median(df, "v") == got[(len(got) - 1) // 2]
    assert exact_median(df.limit(0), "v") is None

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapdelta.operators import quality as Q


@pytest.fixture
def orders(spark):
    data = [(1, "a", "5", dt.datetime(2024, 1, 1, 0)), (2, "b", "x", dt.datetime(2024, 1, 1, 12)),
            (2, "c", None, dt.datetime(2024, 1, 1, 6))]
    return spark.createDataFrame(data, "id BIGINT, k STRING, n STRING, ts TIMESTAMP")


def test_contract(orders, rows):
    contract = Q.Contract("o", row_count_min=3, freshness_hours=24, freshness_col="ts", key="id", duplicates_max=0,
                          quality_score_min=50, schema={"id": "integer", "n": "integer", "gone": "string"})
    got = rows(Q.run_contract(orders, contract, "2024-01-02 00:00:00"), "check", "actual", "expected", "passed")
    assert got == sorted([
        ("row_count_min", 3.0, 3.0, True), ("freshness_hours", 12.0, 24.0, True), ("duplicates_max", 1.0, 0.0, False),
        ("quality_score_min", 100 * (1 - 1 / 3), 50.0, True), ("schema:id", 0.0, 0.0, True),
        ("schema:n", 1.0, 0.0, False), ("column:gone", 0.0, 1.0, False), ("schema:gone", 3.0, 0.0, False)], key=str)


def test_contract_of_an_empty_table_fails(orders):
    contract = Q.Contract("o", row_count_min=1, freshness_hours=24, freshness_col="ts")
    got = Q.run_contract(orders.limit(0), contract, "2024-01-02 00:00:00").collect()
    assert [r.passed for r in got] == [False, False]
    with pytest.raises(ValueError):
        Q.run_contract(orders, Q.Contract("o"), "2024-01-02")


def test_single_checks(orders):
    assert Q.check_min_rows(orders, 4).first().passed is False
    assert Q.check_freshness(orders, "ts", 6, "2024-01-01 18:00:00").first().passed is True
    assert Q.check_freshness(orders, "ts", 6, "2024-01-01 18:00:01").first().passed is False


def test_check_quality(spark, rows):
    m = spark.createDataFrame([("2024-01-01", "a", 99.0, 0), ("2024-01-01", "b", 99.0, 1), ("2024-01-01", "c", 94.9, 0)],
                              "ref_date STRING, table_name STRING, quality_score DOUBLE, duplicate_count BIGINT")
    limits = spark.createDataFrame([("a", 95.0, 0), ("b", 95.0, 0), ("c", 95.0, 0)],
                                   "table_name STRING, quality_score_min DOUBLE, duplicates_max BIGINT")
    assert rows(Q.check_quality(m, limits), "table_name", "passed") == [("a", True), ("b", False), ("c", False)]
    assert rows(Q.check_quality(m, Q.default_limits(m))) == rows(Q.check_quality(m, limits))


def test_validate_schema(orders, rows):
    got = rows(Q.validate_schema(orders, {"ID": "integer", "n": "integer", "ts": "timestamp", "zip": "string"}))
    assert got == sorted([
        ("ID", "int", "bigint", True, False, 0), ("n", "int", "string", True, False, 1),
        ("ts", "timestamp", "timestamp", True, True, 0), ("zip", "string", None, False, False, None)], key=str)


def test_retention(spark, rows):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 1, 5, 10)], "d DATE")
    assert Q.retained(df, "d", "2024-01-10", 5).count() == 2
    assert Q.retained(df, "d", "2024-01-10", None).count() == 4
    assert rows(Q.expired_partitions(df, "d", "2024-01-10", 5)) == [(dt.date(2024, 1, 1), 2)]
    assert Q.expired_partitions(df, "d", "2024-01-10", Q.LAYER_RETENTION_DAYS["gold"]).isEmpty()
    assert Q.LAYER_RETENTION_DAYS["bronze"] == 90


def test_retention_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(10).withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))).write.partitionBy(
        "d").parquet(path)
    plan = Q.retained(spark.read.parquet(path), "d", "2024-01-10", 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_unparsable_text_agrees_with_casting(spark):
    texts = ["1", " 7 ", "+3", "-4", "1.5", ".5", "5.", "1e3", "", " ", "abc", "12a", "99999999999", "NaN", None, "\t8\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    for kind in ("int", "bigint", "decimal(9,2)", "double", "date", "boolean"):
        want = df.filter(F.col("t").isNotNull() & F.col("t").try_cast(kind).isNull()).count()
        assert Q.validate_schema(df, {"t": kind}).first().invalid_count == want, kind


def test_table_without_limits_fails(spark, rows):
    metrics = spark.createDataFrame([("d", "a", 100.0, 0), ("d", "b", 10.0, 5)],
                                    "ref_date STRING, table_name STRING, quality_score DOUBLE, duplicate_count BIGINT")
    limits = Q.default_limits(metrics.filter("table_name = 'a'"))
    assert rows(Q.check_quality(metrics, limits), "table_name", "passed") == [("a", True), ("b", False)]

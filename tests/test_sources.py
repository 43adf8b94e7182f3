"""JDBC operators run against a stand-in source: the SQL they send is executed on
session views, so no database is involved. Options are checked as the reader gets
them."""

import datetime as dt
import re
from dataclasses import dataclass, field
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snapdelta.sinks.jdbc import writer_options
from snapdelta.sources import jdbc as J
from snapdelta.sources import tables as S


@dataclass(frozen=True)
class ViewSource(J.JdbcSource):
    seen: list = field(default_factory=list)

    def load(self, **extra):
        options = self.reader_options(**extra)
        self.seen.append(options)
        table = options.get("dbtable") or f"({options['query']}) q"
        return self.spark.sql(f"SELECT * FROM {table}")


@pytest.fixture
def source(spark):
    spark.range(1, 101).selectExpr("id", "id % 7 AS g", "DATE'2024-01-01' + INT(id) AS d").createOrReplaceTempView("tx")
    spark.createDataFrame(
        [("SALES", "ORDERS", "ts", 5, None), ("SALES", "CUSTOMERS", "ts", 9, None), ("HR", "ORDERS", "ts", 1, None)],
        "owner STRING, table_name STRING, tablespace_name STRING, num_rows BIGINT, last_analyzed TIMESTAMP",
    ).createOrReplaceTempView("all_tables")
    spark.createDataFrame(
        [("SALES", "ORDERS", 2, "TOTAL", "NUMBER", 22, 18, 2, "Y"), ("SALES", "ORDERS", 1, "ID", "NUMBER", 22, 10, 0, "N"),
         ("SALES", "CUSTOMERS", 1, "NAME", "VARCHAR2", 80, None, None, "Y")],
        "OWNER STRING, TABLE_NAME STRING, COLUMN_ID INT, COLUMN_NAME STRING, DATA_TYPE STRING, DATA_LENGTH INT, "
        "DATA_PRECISION INT, DATA_SCALE INT, NULLABLE STRING",
    ).createOrReplaceTempView("all_tab_columns")
    return ViewSource(spark, "jdbc:test:x", "me", "secret", options={"sessionInitStatement": "x"})


def test_options_and_secret(source):
    assert source.reader_options(dbtable="t", fetchsize=5, driver=None) == {
        "url": "jdbc:test:x", "user": "me", "password": "secret", "sessionInitStatement": "x", "dbtable": "t",
        "fetchsize": "5"}
    assert "secret" not in repr(source)
    assert writer_options(source, "t", 100, 4)["batchsize"] == "100"
    assert writer_options(source, "t", 100, 4)["numPartitions"] == "4"
    assert "numPartitions" not in writer_options(source, "t")


def test_read_table_asks_for_bounds(source):
    assert J.read_table(source, "tx", partition_column="id", num_partitions=4).count() == 100
    bounds, read = source.seen
    assert re.match(r"\(SELECT MIN\(id\) AS lo, MAX\(id\) AS hi FROM tx\)", bounds["dbtable"])
    assert (read["partitionColumn"], read["lowerBound"], read["upperBound"], read["numPartitions"]) == (
        "id", "1", "100", "4")
    assert read["fetchsize"] == "10000"


def test_read_table_without_ranges(spark, source):
    J.read_table(source, "tx")
    assert "partitionColumn" not in source.seen[-1]
    spark.range(0).createOrReplaceTempView("empty")
    J.read_table(source, "empty", partition_column="id", num_partitions=4)
    assert "partitionColumn" not in source.seen[-1]
    J.read_table(source, "tx", partition_column="id", num_partitions=4, lower="5", upper="9")
    assert len(source.seen) == 4 and source.seen[-1]["lowerBound"] == "5"


def test_bounds_as_text():
    assert J._bound(Decimal("12.7")) == "12"
    assert J._bound(dt.date(2024, 1, 2)) == "2024-01-02"
    assert J._bound(dt.datetime(2024, 1, 2, 3)) == "2024-01-02 03:00:00"


def test_queries(source):
    assert J.read_partitioned(source, "SELECT * FROM tx WHERE g = 1;", "id", 1, 100, 8, 50).count() == 15
    assert source.seen[-1]["upperBound"] == "100" and source.seen[-1]["fetchsize"] == "50"
    assert J.read_query(source, "SELECT id FROM tx").columns == ["id"]
    assert J.read_query(source, "SELECT id FROM tx", as_subquery=False).count() == 100
    assert source.seen[-1]["query"] == "SELECT id FROM tx"
    definition = [{"name": "g", "type": "string"}, {"name": "id", "type": "decimal(9,1)"}]
    assert J.read_declared(source, "SELECT * FROM tx", definition).dtypes == [("g", "string"), ("id", "decimal(9,1)")]
    ranges = dict(column="id", lower=1, upper=100, num_partitions=2)
    assert J.read_declared(source, "SELECT * FROM tx", definition, **ranges).count() == 100


def test_catalog_queries(source, rows):
    assert [r.table_name for r in J.list_tables(source, "sales").collect()] == ["CUSTOMERS", "ORDERS"]
    assert [r.table_name for r in J.list_tables(source, "sales", "ord%").collect()] == ["ORDERS"]
    assert J.list_tables(source, "o'x").isEmpty()
    assert rows(J.list_owners(source)) == [("HR",), ("SALES",)]
    assert rows(J.list_owners(source, ["hr", "none"])) == [("HR",)]
    assert rows(J.table_stats(source, "SALES", "%CUST%"), "table_name", "num_rows") == [("CUSTOMERS", 9)]
    assert [r.column_name for r in J.list_columns(source, "SALES", "orders").collect()] == ["ID", "TOTAL"]
    assert J.list_columns(source, "SALES").count() == 3


def test_probe(source):
    assert J.probe(source).first().reachable is True
    bad = J.probe(source, "SELECT * FROM no_such_table").first()
    assert bad.reachable is False and "no_such_table" in bad.error


def test_pages(spark):
    df = spark.range(100).selectExpr("id % 10 AS g", "id")
    page = [tuple(r) for r in S.read_page(df, ["g", "id"], 5, 12).collect()]
    assert page == sorted((i % 10, i) for i in range(100))[12:17]
    after = [tuple(r) for r in S.read_page(df, ["g", "id"], 5, after=(1, 11)).collect()]
    assert after == page
    assert S.read_page(df, ["id"], 5, 98).count() == 2


def test_stage_and_rows(spark, tmp_path, rows):
    df = S.from_rows(spark, [("a", 1), ("b", 2)], ["k", "v"])
    for path in (None, str(tmp_path / "s")):
        assert rows(S.stage(df, path)) == [("a", 1), ("b", 2)]
    assert S.stage(df.limit(0)).columns == ["k", "v"]


def test_shared_dir_comes_from_the_session(spark):
    from snapdelta.session import new_path, path_exists, shared_dir

    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x") != new_path(spark, "x")
    assert not path_exists(spark, new_path(spark, "x"))


def test_get_session_applies_settings(spark):
    from snapdelta.session import get_session

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        assert get_session(broadcast_threshold="1m").conf.get("spark.sql.autoBroadcastJoinThreshold") == "1m"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_session_catalog(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    spark.range(3).write.mode("overwrite").saveAsTable("shop.items")
    assert S.read_catalog_table(spark, "spark_catalog.shop.items").count() == 3
    assert ("shop",) in rows(S.list_databases(spark))
    assert rows(S.list_catalog_tables(spark, "shop")) == [("shop", "items")]
    assert S.list_catalog_tables(spark, "shop", "x%").isEmpty()


def test_first_available(spark):
    missing = lambda: spark.table("nope")
    assert S.first_available([missing, lambda: spark.range(0), lambda: spark.range(2)]).count() == 2
    assert S.first_available([missing, lambda: spark.range(0)]) is None


def test_scan_catalog(spark):
    tables = {"a": spark.createDataFrame([("1", 2, 3.0)], "transaction_id STRING, customer_id INT, amount DOUBLE"),
              "b": spark.range(1)}
    found = S.scan_catalog(
        lambda o, t: tables[t], [("s", "a"), ("s", "b"), ("s", "c")], ["transaction_id", "customer_id", "amount"],
        {"transaction_id": "id", "customer_id": "nome", "amount": "valor"}, "importado_em")
    assert [t.status for t in found] == ["MAPPED", "SKIPPED", "FAILED"]
    assert found[0].df.columns == ["id", "nome", "valor", "importado_em"] and found[2].error


def test_read_layer_prunes(spark, tmp_path):
    from snapdelta.sinks.layers import write_layer

    df = spark.range(4).withColumn("reference_date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")))
    path = write_layer(df, str(tmp_path), "bronze", "db", "t", ["reference_date"])
    assert path == f"{tmp_path}/bronze/db/t"
    one = S.read_layer(spark, str(tmp_path), "bronze", "db", "t", "2024-01-03")
    assert [r.id for r in one.collect()] == [2]
    assert all("/reference_date=2024-01-03/" in f for f in one.inputFiles())  # no other folder is listed
    assert S.read_layer(spark, str(tmp_path), "bronze", "db", "t", "2025-01-01").count() == 0
    assert S.read_layer(spark, str(tmp_path), "bronze", "db", "t").count() == 4

import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdelta.schemas import DELTA_EVENTS, MEDALLION
from snapdelta.sinks import ddl as D
from snapdelta.sinks import layers as K


def days(spark, n, rows_per_day=3):
    return spark.range(n * rows_per_day).selectExpr("id", f"DATE'2024-01-01' + INT(id DIV {rows_per_day}) AS day")


def test_layers(spark, tmp_path):
    base = str(tmp_path)
    for layer in ("bronze", "silver", "gold"):
        for _ in range(2):
            assert K.write_layer(spark.range(2), base, layer, "s", "e") == f"{base}/{layer}/s/e"
        assert spark.read.parquet(f"{base}/{layer}/s/e").count() == 4
    path = K.write_layer(spark.range(2), base, "x", "s", "e", mode="overwrite", format="json")
    assert spark.read.json(path).count() == 2
    for n in (3, 1):
        path = K.write_layer(spark.range(n), base, "silver", "s", "e", mode="overwrite")
        assert spark.read.parquet(path).count() == n
    for _ in range(2):
        path = K.write_layer(days(spark, 2), base, "gold", "s", "days", ["day"], mode="overwrite")
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError):
        K.write_layer(spark.range(1), base, "x", "s", "e", mode="ignore")
    assert spark.read.parquet(K.write_staging(spark.range(3), f"{base}/st")).count() == 3
    assert spark.read.parquet(K.write_staging(spark.range(2), f"{base}/st")).count() == 2


def test_rerun_replaces_its_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    K.overwrite_partitions(days(spark, 3), path, ["day"])
    for _ in range(2):
        K.overwrite_partitions(days(spark, 3).filter("id = 0"), path, ["day"])
    assert spark.read.parquet(path).count() == 1 + 3 + 3


def test_overwrite_partition_also_when_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3).withColumn("table_name", F.lit("a/b=c"))
    for _ in range(2):
        K.overwrite_partition(df, path, {"day": "2024-01-01", "table_name": "a/b=c"})
    got = spark.read.parquet(path)
    assert got.count() == 3 and got.first().table_name == "a/b=c"
    K.overwrite_partition(df.limit(0), path, {"day": "2024-01-01", "table_name": "a/b=c"})
    assert spark.read.schema(got.schema).parquet(path).isEmpty()


def test_append_aligned(spark, tmp_path):
    path = str(tmp_path / "e")
    df = spark.sql("SELECT 'k' AS primary_key, 't' AS table_name, DATE'2024-01-01' AS ref_date, 'INSERT' AS operation_type")
    K.append_aligned(df, DELTA_EVENTS, path, ["ref_date"])
    r = spark.read.parquet(path).first()
    assert r.primary_key == "k" and r.data_before is None
    assert K.align(df, T.StructType([T.StructField("x", T.IntegerType())])).dtypes == [("x", "int")]


def test_clustered_files_cover_narrow_ranges(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 4000, 1, 4).selectExpr("'d' AS day", "(id * 7919) % 4001 AS k")
        K.clustered(df, ["day"], ["k"]).write.parquet(path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = sorted(
        (r.lo, r.hi) for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(
            F.min("k").alias("lo"), F.max("k").alias("hi")).collect())
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert spark.read.parquet(path).count() == 4000


def test_clustered_splits_one_frequent_key(spark, tmp_path):
    path = str(tmp_path / "h")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        K.clustered(spark.range(0, 4000, 1, 4).selectExpr("'d' AS day", "1 AS k"), ["day"], ["k"]).write.parquet(path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(f"{path}/*.parquet")) > 1


def test_create_tables(spark):
    for layer in MEDALLION:
        for _ in range(2):
            names = D.create_tables(spark, layer, prefix="lake_")
        for name in names:
            assert spark.table(name).isEmpty()
    assert [f.name for f in spark.table("lake_silver.delta_events").schema][-1] == "ref_date"
    assert spark.table("lake_silver.current_state").columns[-2:] == ["version", "table_name"]


def test_created_tables_show_what_the_jobs_write(spark, tmp_path):
    from snapdelta.plans import daily
    from snapdelta.plans.specs import TableSpec

    base, rows = str(tmp_path), spark.range(3).selectExpr("id", "'a' AS v")
    daily.run_day(spark, lambda _: rows, [TableSpec("t", "T", "S", "files", ("id",))], base, "2024-01-01")
    for layer, table, n in (("bronze", "snapshot_raw", 3), ("silver", "delta_events", 3), ("silver", "current_state", 3),
                            ("gold", "daily_change_metrics", 1)):
        names = D.create_tables(spark, layer, prefix="job_", base=base)
        name = f"job_{layer}.{table}"
        assert name in names
        spark.sql(f"MSCK REPAIR TABLE {name}")
        assert spark.table(name).count() == n


# The expected text of warehouse definitions.


def test_schema_ddl(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DecimalType(18, 4))])
    assert D.schema_to_ddl(schema, "db.t", ["id"]) == (
        "CREATE TABLE IF NOT EXISTS db.t (id Int64, v Decimal(18,4), snapshot_date Date, record_hash FixedString(64)) "
        "ENGINE = MergeTree PARTITION BY snapshot_date ORDER BY (id) SETTINGS index_granularity = 8192")
    spark.sql("CREATE DATABASE IF NOT EXISTS ddl")
    spark.sql(D.schema_to_spark_ddl(schema, "ddl.t"))
    assert spark.table("ddl.t").columns == ["id", "v", "record_hash", "snapshot_date"]


def test_catalog_ddl(spark):
    cols = [("SALES", "ORDERS", 2, "Preço Médio", "NUMBER"), ("SALES", "ORDERS", 1, "ID-X", "VARCHAR2"),
            ("SALES", "ORDERS", 10, "AT", "TIMESTAMP(6)"), ("SALES", "ORDERS", 3, None, "NUMBER")]
    df = spark.createDataFrame(cols, "owner STRING, table_name STRING, column_id INT, column_name STRING, data_type STRING")
    r = D.catalog_to_ddl(df).first()
    assert r.target_table == "sales_orders"
    assert r.ddl.startswith(
        "CREATE TABLE IF NOT EXISTS bronze.sales_orders\n(\n    id_x String,\n    preco_medio Decimal64(2),\n"
        "    at String,\n    _ingestion_timestamp DateTime DEFAULT now(),\n")
    assert r.ddl.endswith("ORDER BY (reference_date, row_hash)\nSETTINGS index_granularity = 8192;\n")
    assert "at DateTime64(3)" in D.catalog_to_ddl(df, sized_types=True).first().ddl

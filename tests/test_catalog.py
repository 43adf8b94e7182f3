import datetime as dt

from pyspark.sql import functions as F

from snapdelta.operators import catalog as C
from snapdelta.operators import ledger as L
from snapdelta.schemas import LINEAGE, RUN_METRICS, TABLE_METADATA
from snapdelta.sinks.layers import align


def stamp(text):
    return F.lit(text).cast("timestamp")


def record(spark, name, rows_, created=None):
    df = spark.createDataFrame([("sales", "bronze", name, rows_)], "domain STRING, layer STRING, name STRING, row_count BIGINT")
    df = align(df, TABLE_METADATA)
    return df if created is None else df.withColumn("created_at", stamp(created))


def test_register_table_keeps_first_creation(spark):
    meta = C.empty_table(spark, TABLE_METADATA)
    meta = C.register_table(meta, record(spark, "orders", 1), stamp("2024-01-01"))
    meta = C.register_table(meta, record(spark, "orders", 2), stamp("2024-01-02"))
    meta = C.register_table(meta, record(spark, "items", 9), stamp("2024-01-03"))
    r = C.table_metadata(meta, "sales", "bronze", "orders").collect()
    assert len(r) == 1 and r[0].row_count == 2 and r[0].retention_days == 365 and r[0].pii is False
    assert r[0].created_at == dt.datetime(2024, 1, 1) and r[0].updated_at == dt.datetime(2024, 1, 2)
    assert C.table_metadata(meta, "sales", "silver", "orders").isEmpty()
    assert meta.columns == [c.split()[0] for c in TABLE_METADATA.split(", ")]
    assert C.generate_catalog(meta, "2024-01-02").count() == 1
    assert C.generate_catalog(meta, "2024-01-03").count() == 2


def test_reregistering_at_the_same_time_takes_the_new_record(spark):
    meta = C.register_table(C.empty_table(spark, TABLE_METADATA), record(spark, "t", 5), stamp("2024-01-01"))
    meta = C.register_table(meta, record(spark, "t", 3), stamp("2024-01-01"))
    assert meta.first().row_count == 3


def test_lineage(spark, rows):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "source_table STRING, target_table STRING")
    lineage = C.register_lineage(C.empty_table(spark, LINEAGE), align(edges, LINEAGE))
    assert rows(C.lineage_of(lineage, "b"), "source_table", "target_table") == [("a", "b"), ("b", "c")]


def test_coverage_and_missing(spark, rows):
    src = spark.createDataFrame([("a",), ("b",), ("b",)], "table_name STRING")
    tgt = spark.createDataFrame([("b",), ("c",)], "table_name STRING")
    assert rows(C.coverage(src, tgt)) == [("a", "missing"), ("c", "extra")]
    assert rows(C.missing(src, tgt)) == [("a",)]


def test_list_columns_and_counts(spark, rows):
    df = spark.sql("SELECT 1 AS a, CAST(2 AS DECIMAL(9,3)) AS b, CAST(NULL AS STRING) AS c")
    assert rows(C.list_columns(df, "t"), "column_id", "column_name", "data_type", "data_precision", "nullable") == [
        (1, "a", "int", None, "N"), (2, "b", "decimal(9,3)", 9, "Y"), (3, "c", "string", None, "Y")]
    counts = C.table_counts({"x": spark.range(3), "y": spark.range(0)}, "me")
    assert rows(counts, "owner", "table_name", "num_rows") == [("me", "x", 3), ("me", "y", 0)]


def ledger_of(spark, data):
    schema = "ref_date DATE, schema_name STRING, table_name STRING, status STRING, h INT"
    df = spark.createDataFrame([(dt.date(2024, 1, d), "s", t, st, h) for d, t, st, h in data], schema)
    at = F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), F.col("h"), F.lit(0), F.lit(0))
    return df.withColumn("ingestion_start", at).withColumn("ingestion_end", F.lit(None).cast("timestamp"))


def test_ledger(spark, rows):
    ledger = ledger_of(spark, [
        (1, "a", "STARTED", 1), (1, "a", "SUCCESS", 2),
        (1, "b", "STARTED", 1), (1, "b", "FAILED", 2),
        (2, "a", "STARTED", 3),
        (2, "b", "SUCCESS", 4), (2, "b", "FAILED", 5),
    ])
    assert L.already_loaded(ledger, "2024-01-01", "s", "a")
    assert not L.already_loaded(ledger, "2024-01-01", "s", "a", force=True)
    assert not L.already_loaded(ledger, "2024-01-01", "s", "b")
    assert not L.already_loaded(ledger, "2024-01-02", "s", "a")
    assert not L.already_loaded(ledger, "2024-01-02", "s", "b")  # the later attempt failed
    wanted = ledger.select("ref_date", "schema_name", "table_name")
    assert rows(L.pending_loads(ledger, wanted), "ref_date", "table_name") == [
        (dt.date(2024, 1, 1), "b"), (dt.date(2024, 1, 2), "a"), (dt.date(2024, 1, 2), "b")]
    assert L.pending_loads(ledger, wanted, force=True).count() == 4
    assert L.finished_loads(ledger, [dt.date(2024, 1, 1)]) == {(dt.date(2024, 1, 1), "s", "a")}


def test_ledger_file(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert L.read_ledger(spark, path).isEmpty()
    day = dt.date(2024, 1, 1)
    L.record_ingestion(spark, path, [L.ledger_row(day, "s", "t", L.STARTED, L.now())])
    L.record_ingestion(spark, path, [L.ledger_row(day, "s", "t", L.SUCCESS, L.now(), row_count=4)])
    assert L.already_loaded(L.read_ledger(spark, path), day, "s", "t")
    assert L.load_status(L.read_ledger(spark, path)).first().row_count == 4


def test_run_report(spark, rows):
    t0 = dt.datetime(2024, 1, 1)
    data = [("d", "bronze", t0, t0 + dt.timedelta(hours=1), "success", 10, 0, [], None),
            ("d", "bronze", t0, t0 + dt.timedelta(hours=3), "error", 5, 2, [(t0, "boom"), (t0, "bang")], None),
            ("d", "gold", t0, t0 + dt.timedelta(minutes=5), "success", 1, 0, None, None)]
    runs = L.with_duration(spark.createDataFrame(data, RUN_METRICS))
    got = L.run_report(runs, {"bronze": 2, "gold": 1})
    assert rows(got, "layer", "runs", "failed_runs", "rows_processed", "rows_failed", "error_count",
                "max_duration_seconds", "within_sla") == [
        ("bronze", 2, 1, 15, 2, 2, 10800.0, False), ("gold", 1, 0, 1, 0, 0, 300.0, True)]
    limits = spark.createDataFrame([("bronze", 4)], "layer STRING, sla_hours INT")
    assert rows(L.run_report(runs, limits), "layer", "within_sla") == [("bronze", True), ("gold", None)]
    assert "within_sla" not in L.run_report(runs).columns

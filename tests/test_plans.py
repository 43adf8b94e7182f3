import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapdelta.operators.envelope import parse_payload, to_envelope
from snapdelta.operators.ledger import finished_loads, read_ledger, read_runs, run_report
from snapdelta.plans import bronze, daily, gold, lake, silver
from snapdelta.plans.specs import TableSpec, load_specs, select_specs, transformation_steps
from snapdelta.sources.jdbc import JdbcSource
from snapdelta.sources.tables import read_layer

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def entry(**over):
    base = {
        "name": "orders",
        "source": {"type": "oracle", "schema": "SALES", "table": "ORDERS"},
        "ingestion": {"mode": "snapshot_full", "reference_date": "D-1", "partition_column": "ORDER_ID",
                      "num_partitions": 20, "fetch_size": 10000},
        "quality": {"row_count_min": 5000, "freshness_hours": 6},
        "metadata": {"domain": "sales", "owner": "data-team", "pii": False, "retention_days": 2555},
    }
    return {**base, **over}


def test_specs():
    spec, other = load_specs({"bronze_tables": [entry(), entry(name="x", source={"type": "files"})]})
    assert (spec.full_name, spec.num_partitions, spec.retention_days) == ("SALES.ORDERS", 20, 2555)
    assert spec.ref_date("2024-01-02") == D1
    assert spec.contract().row_count_min == 5000
    assert select_specs([spec, other], "oracle") == [spec]
    for bad in (entry(ingestion={"mode": "incremental"}), entry(source={}), entry(metadata={"domain": "d"})):
        with pytest.raises(ValueError):
            load_specs({"bronze_tables": [bad]})


SPECS = [TableSpec("orders", "ORDERS", "SALES", "files", ("id",)), TableSpec("items", "ITEMS", None, "files", ("id", "n"))]


def reader(tables):
    def read(spec):
        df = tables[spec.table]
        if df is None:
            raise RuntimeError("source is down")
        return df

    return read


def orders(spark, data):
    return spark.createDataFrame(data, "id INT, v STRING")


def items(spark, data):
    return spark.createDataFrame(data, "id INT, n INT, v STRING")


def test_typed_ingest_is_repeatable(spark, tmp_path, rows):
    base = str(tmp_path)
    read = reader({"ORDERS": orders(spark, [(1, "a"), (2, "b")]), "ITEMS": None})
    result = bronze.ingest_tables(spark, read, SPECS, base, D1)
    assert sorted((r["table_name"], r["status"], r["row_count"]) for r in result) == [
        ("ITEMS", "FAILED", None), ("ORDERS", "SUCCESS", 2)]
    assert "source is down" in next(r for r in result if r["table_name"] == "ITEMS")["error_message"]
    # Done loads are skipped, failed ones tried again; force repeats without adding rows.
    assert [r["table_name"] for r in bronze.ingest_tables(spark, read, SPECS, base, D1)] == ["ITEMS"]
    assert len(bronze.ingest_tables(spark, read, SPECS, base, D1, force=True)) == 2
    got = read_layer(spark, base, "bronze", "files", "sales.orders", D1)
    assert rows(got, "id", "v", "_source", "_source_table") == [
        (1, "a", "files", "SALES.ORDERS"), (2, "b", "files", "SALES.ORDERS")]
    # Envelopes from the typed snapshot hold business columns only.
    assert bronze.load_envelope(spark, SPECS[0], base, D1) == 2
    assert rows(silver.read_snapshots(spark, base, D1), "data") == [('{"id":1,"v":"a"}',), ('{"id":2,"v":"b"}',)]


def test_days(spark, tmp_path, rows):
    base = str(tmp_path)

    def run(day, o, i, **kw):
        read = reader({"ORDERS": o and orders(spark, o), "ITEMS": i and items(spark, i)})
        return rows(daily.run_day(spark, read, SPECS, base, day, **kw), "table_name", "total_inserts", "total_updates",
                    "total_deletes", "total_active_records")

    assert run(D1, [(1, "a"), (2, "b")], [(1, 1, "x")]) == [("ITEMS", 1, 0, 0, 1), ("SALES.ORDERS", 2, 0, 0, 2)]
    # Items fail on the second day: no events, state untouched.
    second = [(1, "A"), (3, "c")]
    assert run(D2, second, None) == [("SALES.ORDERS", 1, 1, 1, 2)]
    state = silver.read_state(spark, base, D2)
    assert rows(state, "table_name", "primary_key", "is_active", "first_seen_date", "last_seen_date") == [
        ("ITEMS", "1|||1", 1, D1, D1), ("SALES.ORDERS", "1", 1, D1, D2), ("SALES.ORDERS", "2", 0, D1, D1),
        ("SALES.ORDERS", "3", 1, D2, D2)]
    # The retry adds them; orders are not loaded again and nothing doubles.
    both = [("ITEMS", 0, 1, 0, 1), ("SALES.ORDERS", 1, 1, 1, 2)]
    assert run(D2, None, [(1, 1, "y")]) == both
    assert run(D2, None, None) == both
    assert run(D2, second, [(1, 1, "y")], force=True) == both
    # Third day: key 2 is back.
    assert run(D3, [(1, "A"), (2, "b")], [(1, 1, "y")]) == [("SALES.ORDERS", 1, 0, 1, 2)]
    state = silver.read_state(spark, base, D3).filter("primary_key = '2'")
    assert rows(state, "is_active", "first_seen_date", "last_seen_date") == [(1, D1, D3)]
    assert silver.read_state(spark, base, D2).count() == 4
    assert silver.read_snapshots(spark, base, D1 - dt.timedelta(days=1)).isEmpty()
    assert silver.read_events(spark, base, D2).filter("detected_at IS NULL").isEmpty()
    quality = gold.read_quality_metrics(spark, base, D3)
    assert rows(quality, "table_name", "total_records", "quality_score") == [("ITEMS", 1, 100.0), ("SALES.ORDERS", 2, 100.0)]
    assert [str(r.ref_date) for r in gold.trends(spark, base, 2).collect()] == ["2024-01-03", "2024-01-02"]
    runs = read_runs(spark, bronze.runs_path(base))
    failed = runs.filter("status = 'error'").collect()
    assert failed and all(r.layer == "bronze" and "source is down" in r.errors[0].error for r in failed)
    report = run_report(runs, {"bronze": 2, "silver": 2, "gold": 1})
    # Four runs changed something after the first; the one that found nothing to do left no row.
    assert rows(report, "layer", "runs", "rows_failed", "within_sla") == [
        ("bronze", 5, 0, True), ("gold", 5, 0, True), ("silver", 5, 0, True)]


def test_missed_day(spark, tmp_path, rows):
    base = str(tmp_path)
    spec = SPECS[:1]
    daily.run_day(spark, reader({"ORDERS": orders(spark, [(1, "a"), (2, "b")])}), spec, base, D1)
    got = daily.run_day(spark, reader({"ORDERS": orders(spark, [(1, "a")])}), spec, base, D3)
    # Compared with the calendar day before, everything is new; the state still knows better.
    assert rows(got, "total_inserts", "total_deletes", "total_active_records") == [(1, 0, 1)]
    assert rows(silver.read_state(spark, base, D3), "primary_key", "is_active", "first_seen_date") == [
        ("1", 1, D1), ("2", 0, D1)]


def test_silver_dedupe(spark, rows):
    df = spark.createDataFrame(
        [("2024-01-01", 1, "x", 1), ("2024-01-01", 1, "x", 2), ("2024-01-02", 1, "x", 3), ("2024-01-02", 2, "x", 4)],
        "reference_date STRING, id INT, v STRING, _ingestion_timestamp INT")
    assert silver.silver_dedupe(df).count() == 3
    assert rows(silver.silver_dedupe(df, scope="all"), "reference_date", "id", "_ingestion_timestamp") == [
        ("2024-01-01", 1, 1), ("2024-01-02", 2, 4)]
    assert silver.silver_dedupe(df, exclude=["reference_date"], scope="all").count() == 4
    with pytest.raises(ValueError):
        silver.silver_dedupe(df, scope="week")


def test_silver_transform(spark, rows):
    config = {"silver_transformations": {"customers": {"transformations": [
        {"type": "clean_strings", "columns": ["name", "phone"], "trim_spaces": True, "upper_case": False},
        {"type": "deduplicate", "subset": ["id"]},
        {"type": "validate_schema", "schema": {"id": "integer", "name": "string"}}]}}}
    df = spark.createDataFrame([(1, " a "), (1, " b"), (2, "c")], "id INT, name STRING")
    out, report = silver.silver_transform(df, transformation_steps(config, "customers"), order_by=["name"])
    assert rows(out) == [(1, "b"), (2, "c")]
    assert rows(report, "column_name", "type_matches", "invalid_count") == [("id", True, 0), ("name", True, 0)]
    with pytest.raises(ValueError):
        silver.silver_transform(df, [{"type": "sort"}])


def test_typed_silver(spark, rows):
    df = spark.createDataFrame([(1, " a ", "5.25"), (2, "b", "bad")], "id INT, name STRING, amount STRING")
    snaps = to_envelope(df, "t", ["id"], D1).unionByName(to_envelope(df, "u", ["id"], D1))
    got = silver.typed_silver(snaps, D1, "t", "id INT, name STRING, amount DECIMAL(9,2)", ["id"], ["name"])
    assert [(i, n, a and float(a)) for i, n, a in rows(got, "id", "name", "amount")] == [(1, "a", 5.25), (2, "b", None)]


def test_copy_table(spark, tmp_path):
    class Views(JdbcSource):
        def load(self, **extra):
            return self.spark.sql(f"SELECT * FROM {extra['dbtable']}")

    spark.range(1, 6).selectExpr("id", "CAST(id AS STRING) AS v").createOrReplaceTempView("src_t")
    ddl, path = [], str(tmp_path / "copy")
    n = bronze.copy_table(
        Views(spark, "jdbc:x"), "SELECT * FROM src_t", [{"name": "id", "type": "long"}, {"name": "v", "type": "string"}],
        D1, lambda df: df.write.parquet(path), "stage.t", ["id"], ddl.append,
        column="id", lower=1, upper=5, num_partitions=2)
    got = spark.read.parquet(path)
    assert n == 5 and got.columns == ["id", "v", "snapshot_date", "record_hash"]
    assert got.filter("id = 3").first().record_hash == spark.sql("SELECT sha2('3||3', 256)").first()[0]
    assert ddl[0].startswith("CREATE TABLE IF NOT EXISTS stage.t (id Int64, v String, snapshot_date Date")


def test_ddl_for_missing(spark, rows):
    cols = spark.createDataFrame([("S", "A", 1, "X", "NUMBER"), ("S", "B", 1, "Y", "DATE")],
                                 "owner STRING, table_name STRING, column_id INT, column_name STRING, data_type STRING")
    have = spark.createDataFrame([("A",), ("Z",)], "table_name STRING")
    assert rows(daily.ddl_for_missing(cols, have), "table_name") == [("B",)]


def test_envelope_of_several_days(spark, rows):
    df = spark.createDataFrame([("2024-01-01", 1)], "d STRING, id INT").select(F.col("d").cast("date").alias("ref_date"), "id")
    assert rows(to_envelope(df, "t", ["id"], F.col("ref_date")), "ref_date", "primary_key", "data") == [(D1, "1", '{"id":1}')]


def test_silver_day_is_repeatable(spark, tmp_path, rows):
    base = str(tmp_path)
    read = reader({"ORDERS": orders(spark, [(1, "a"), (1, "a"), (2, "b")])})
    bronze.ingest_tables(spark, read, SPECS[:1], base, D1)
    for _ in range(2):
        assert silver.write_silver_day(spark, base, "files", "sales.orders", D1) == 2
    got = read_layer(spark, base, "silver", "files", "sales.orders", D1)
    assert rows(got, "id", "v") == [(1, "a"), (2, "b")] and "row_hash" in got.columns


def test_metric_from_config(spark, rows):
    config = {"gold_metrics": {"by_v": {"aggregations": {"group_by": ["v"], "metrics": {"id": ["sum", "countDistinct"]}}}}}
    df = orders(spark, [(1, "a"), (1, "a"), (2, "b")])
    assert rows(gold.metric_from_config(config, "by_v", df)) == [("a", 2, 1), ("b", 2, 1)]


def test_interrupted_day_is_repeated(spark, tmp_path, rows, monkeypatch):
    base, spec = str(tmp_path), SPECS[:1]
    first = reader({"ORDERS": orders(spark, [(1, "a")])})
    daily.run_day(spark, first, spec, base, D1)
    second = reader({"ORDERS": orders(spark, [(1, "b")])})
    with monkeypatch.context() as m:
        m.setattr(silver, "align", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            daily.run_day(spark, second, spec, base, D2)
    # The load is done, silver and gold are not: the same call finishes them.
    got = daily.run_day(spark, reader({"ORDERS": None}), spec, base, D2)
    assert rows(got, "total_inserts", "total_updates") == [(0, 1)]
    # A forced run that dies takes the day's state back to unfinished.
    with monkeypatch.context() as m:
        m.setattr(silver, "align", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            daily.run_day(spark, second, spec, base, D2, force=True)
    finished = finished_loads(read_ledger(spark, bronze.ledger_path(base)), [D1, D2])
    assert (D2, "silver", "current_state") not in finished and (D1, "silver", "current_state") in finished
    assert rows(daily.run_day(spark, second, spec, base, D2), "total_updates") == [(1,)]


def test_two_schemas_with_one_table_name(spark, tmp_path, rows):
    base = str(tmp_path)
    specs = [TableSpec("a", "ORDERS", "S1", "files", ("id",)), TableSpec("b", "ORDERS", "S2", "files", ("id",))]
    tables = {"S1": orders(spark, [(1, "a"), (2, "b"), (3, "c")]), "S2": orders(spark, [(1, "x"), (9, "y")])}
    result = bronze.ingest_tables(spark, lambda s: tables[s.schema], specs, base, D1)
    assert sorted(r["row_count"] for r in result) == [2, 3]
    for spec, n in zip(specs, (3, 2), strict=True):
        assert read_layer(spark, base, "bronze", "files", spec.entity, D1).count() == n
        assert bronze.load_envelope(spark, spec, base, D1) == n


def test_failed_reload_keeps_the_rows(spark, tmp_path, rows):
    base, spec = str(tmp_path), SPECS[:1]
    bronze.ingest_tables(spark, reader({"ORDERS": orders(spark, [(1, "a"), (2, "b")])}), spec, base, D1)
    dying = orders(spark, [(1, "a"), (0, "b")]).withColumn("id", F.expr("IF(id = 0, raise_error('gone'), id)").cast("int"))
    result = bronze.ingest_tables(spark, reader({"ORDERS": dying}), spec, base, D1, force=True)
    assert [r["status"] for r in result] == ["FAILED"] and "gone" in result[0]["error_message"]
    assert read_layer(spark, base, "bronze", "files", "sales.orders", D1).count() == 2
    # An empty load still replaces the day.
    bronze.ingest_tables(spark, reader({"ORDERS": orders(spark, [(1, "a")]).limit(0)}), spec, base, D1, force=True)
    assert read_layer(spark, base, "bronze", "files", "sales.orders", D1).count() == 0


@pytest.mark.parametrize("error", [AssertionError(), RuntimeError("x" * 5000 + "\nsecond line")])
def test_errors_are_kept_whole(spark, tmp_path, error):
    def read(spec):
        if spec.table == "ITEMS":
            raise error
        return orders(spark, [(1, "a")])

    result = bronze.ingest_tables(spark, read, SPECS, str(tmp_path), D1)
    assert sorted((r["table_name"], r["status"]) for r in result) == [("ITEMS", "FAILED"), ("ORDERS", "SUCCESS")]
    message = next(r["error_message"] for r in result if r["status"] == "FAILED")
    assert message == f"{type(error).__name__}: {error}"


def test_value_moving_between_null_columns(spark, tmp_path, rows):
    base, spec = str(tmp_path), [TableSpec("t", "T", None, "files", ("id",))]
    one, two = (spark.createDataFrame([r], "id INT, a STRING, b STRING") for r in ((1, "x", None), (1, None, "x")))
    daily.run_day(spark, lambda _: one, spec, base, D1)
    assert rows(daily.run_day(spark, lambda _: two, spec, base, D2), "total_updates") == [(1,)]
    assert rows(silver.read_state(spark, base, D2), "data") == [('{"id":1,"b":"x"}',)]


def test_rows_a_microsecond_apart(spark, rows):
    df = spark.sql("SELECT DATE '2024-01-01' AS reference_date, 1 AS id, t FROM VALUES "
                   "(TIMESTAMP '2024-01-01 00:00:00.000001'), (TIMESTAMP '2024-01-01 00:00:00.000002') AS v(t)")
    assert silver.silver_dedupe(df).count() == 2
    snaps = to_envelope(df.drop("reference_date").withColumn("n", F.col("t").cast("timestamp_ntz")), "t", ["t"], D1)
    assert snaps.select("row_hash", "data").distinct().count() == 2
    back = silver.typed_silver(snaps, D1, "t", "id INT, t TIMESTAMP, n TIMESTAMP_NTZ", ["t"])
    assert rows(back.select(F.col("t").cast("string"), F.col("n").cast("string"))) == [
        ("2024-01-01 00:00:00.000001",) * 2, ("2024-01-01 00:00:00.000002",) * 2]
    old = spark.createDataFrame([('{"t":"2024-01-01T00:00:00.123Z"}',)], "data STRING")
    assert rows(parse_payload(old, "t TIMESTAMP").select(F.col("t").cast("string"))) == [("2024-01-01 00:00:00.123",)]


def test_each_table_takes_its_own_way_after_a_failure(spark, tmp_path, rows, monkeypatch):
    """Items miss a day; on the next one orders still go by their events alone."""
    base = str(tmp_path)
    run = lambda day, o, i: daily.run_day(
        spark, reader({"ORDERS": orders(spark, o), "ITEMS": i and items(spark, i)}), SPECS, base, day)
    run(D1, [(1, "a"), (2, "b")], [(1, 1, "x")])
    run(D2, [(1, "a"), (2, "c")], None)
    seen = {}
    for name in ("apply_delta", "maintain_current_state"):
        real = getattr(silver, name)

        def spy(old, changes, *args, _name=name, _real=real, **kw):
            seen[_name] = {r[0] for r in old.select("table_name").distinct().collect()}
            return _real(old, changes, *args, **kw)

        monkeypatch.setattr(silver, name, spy)
    run(D3, [(1, "a"), (3, "d")], [(1, 1, "y"), (2, 1, "z")])
    assert seen == {"apply_delta": {"SALES.ORDERS"}, "maintain_current_state": {"ITEMS"}}
    state = silver.read_state(spark, base, D3)
    assert rows(state, "table_name", "primary_key", "is_active", "first_seen_date", "last_seen_date") == [
        ("ITEMS", "1|||1", 1, D1, D3), ("ITEMS", "2|||1", 1, D3, D3), ("SALES.ORDERS", "1", 1, D1, D3),
        ("SALES.ORDERS", "2", 0, D1, D2), ("SALES.ORDERS", "3", 1, D3, D3)]


def test_newest_state_is_one_ledger_row(spark, tmp_path):
    from snapdelta.operators.ledger import SUCCESS, ledger_row, now, record_ingestion

    path = str(tmp_path / "ledger")
    days = [D1 - dt.timedelta(days=i) for i in range(20)]
    record_ingestion(spark, path, [ledger_row(d, "silver", "current_state", SUCCESS, now()) for d in days])
    got = finished_loads(read_ledger(spark, path), [D3, D2], ["current_state"])
    assert got == {(D1, "silver", "current_state")}


def lake_config(limit):
    table = {"source": {"type": "files", "schema": "SALES", "table": "ORDERS"}, "primary_keys": ["id"],
             "ingestion": {"mode": "snapshot_full", "reference_date": "D-1"}, "quality": {"row_count_min": limit},
             "metadata": {"domain": "sales", "owner": "data", "retention_days": 30}}
    return {"bronze_tables": [{"name": "orders", **table}],
            "silver_transformations": {"orders": {"transformations": [{"type": "clean_strings", "columns": ["v"]}]}},
            "gold_metrics": {"by_v": {"source": "silver.sales.orders",
                                      "aggregations": {"group_by": ["v"], "metrics": {"id": ["count"]}}}}}


def test_lake_run(spark, tmp_path, rows):
    base = str(tmp_path)
    old = D1 - dt.timedelta(days=40)
    read = reader({"ORDERS": orders(spark, [(1, " a"), (2, "a "), (3, "b")])})
    bronze.ingest_tables(spark, read, lake.load_specs(lake_config(2)), base, old)
    assert lake.run_lake(spark, read, lake_config(2), base, D2) == {"silver.orders": 3, "gold.by_v": 2}
    # D-1: the rows belong to the day before, and the load past its retention is gone.
    assert rows(spark.read.parquet(gold.gold_path(base, "by_v")), "ref_date", "v", "id_count") == [(D1, "a", 2), (D1, "b", 1)]
    assert rows(spark.read.parquet(f"{base}/bronze/files/sales.orders"), "reference_date") == [(D1,)] * 3
    # Too few rows the next day: recorded, and neither silver nor gold has the day.
    few = reader({"ORDERS": orders(spark, [(1, "a")])})
    assert lake.run_lake(spark, few, lake_config(2), base, D3) == {}
    assert rows(lake.read_contract_results(spark, base, D2), "table_name", "check", "passed") == [
        ("orders", "duplicates_max", True), ("orders", "row_count_min", False)]
    assert lake.run_lake(spark, few, lake_config(2), base, D3, gate=False) == {"silver.orders": 1, "gold.by_v": 1}
    # A table that cannot be read stops nothing.
    assert lake.run_lake(spark, reader({"ORDERS": None}), lake_config(2), base, D3, force=True) == {}

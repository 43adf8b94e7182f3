"""What outlives a run: retention by what is named, scopes, gates, pages, sketches, compaction."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from snapdelta.operators import sketches
from snapdelta.operators.ledger import read_ledger
from snapdelta.operators.state import collapse_sum
from snapdelta.plans import bronze, daily, lake, retention, silver
from snapdelta.plans.specs import TableSpec
from snapdelta.session import RunScope, new_path, shared_dir
from snapdelta.sinks import compaction
from snapdelta.sources import pages
from snapdelta.sources.tables import stage

D = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(12)]
ORDERS, ITEMS = TableSpec("o", "ORDERS", "S", "files", ("id",)), TableSpec("i", "ITEMS", None, "files", ("id",))


def names(path):
    return sorted(p.name for p in pathlib.Path(path).iterdir() if not p.name.startswith(("_", "."))) if pathlib.Path(path).exists() else []


def test_ten_days_with_a_failed_one(spark, tmp_path, rows, monkeypatch):
    """Items are loaded on the first day only; the sixth day dies in silver."""
    base = str(tmp_path)
    read = lambda day: lambda s: spark.range(5 + day).selectExpr("id", f"IF(id = {day}, 'x{day}', 'a') AS v")
    for n in range(10):
        specs = [ORDERS, ITEMS] if n == 0 else [ORDERS]
        if n == 5:
            with monkeypatch.context() as m:
                m.setattr(silver, "write_version", _dies_on(silver.write_version, "current_state"))
                with pytest.raises(RuntimeError):
                    daily.run_day(spark, read(n), specs, base, D[n], buckets=4)
        else:
            daily.run_day(spark, read(n), specs, base, D[n], buckets=4)
    before = {d: silver.read_state(spark, base, d).drop("updated_at").collect() for d in (D[8], D[9])}
    gone = retention.expire_runs(spark, base, D[9], {"bronze": 3, "silver": 3, "gold": 3})
    # Days 6 to 9 stay; of the first day the items, which nothing newer has.
    assert names(f"{base}/bronze/snapshot_raw") == [f"ref_date={d}" for d in (D[0], *D[6:10])]
    assert names(f"{base}/bronze/snapshot_raw/ref_date={D[0]}") == ["table_name=ITEMS"]
    assert names(f"{base}/silver/delta_events") == [f"ref_date={d}" for d in D[6:10]]
    assert names(f"{base}/gold/daily_change_metrics") == [f"ref_date={d}" for d in D[6:10]]
    assert retention.last_loads(spark, base) == {"S.ORDERS": D[9], "ITEMS": D[0]}
    kept = {r.ref_date for r in read_ledger(spark, bronze.ledger_path(base)).collect()}
    assert kept == {D[0], *D[6:10]} and set(gone["ledger"]) == {str(d) for d in D[1:6]}
    # The newest state still names the items' folder of the first day; the dead run's folder is gone.
    folders = names(f"{base}/silver/current_state")
    named = {e["folder"] for d in D[6:10] for e in silver.state_version(spark, base, day=d)["tables"].values()}
    assert set(folders) == named and any(f.startswith(f"version={D[0]}") for f in folders)
    assert not any(f.startswith(f"version={D[5]}") for f in folders)
    for d, state in before.items():
        assert sorted(silver.read_state(spark, base, d).drop("updated_at").collect()) == sorted(state)
    # The next day goes on from what is left; a second time nothing more goes.
    assert rows(daily.run_day(spark, read(10), [ORDERS], base, D[10], buckets=4), "total_inserts", "total_updates") == [(1, 2)]
    again = retention.expire_runs(spark, base, D[9], {"bronze": 3, "silver": 3, "gold": 3})
    assert not any(again.values())


def _dies_on(real, word):
    def write(spark, path, *args):
        if word in path:
            raise RuntimeError("lost")
        return real(spark, path, *args)

    return write


def test_gate_and_reference_dates(spark, tmp_path, rows):
    base = str(tmp_path)
    few = TableSpec("few", "FEW", "S", "files", ("id",), row_count_min=10, reference_date="D-2")
    twice = TableSpec("twice", "TWICE", "S", "files", ("id",), reference_date="D-1")
    tables = {"ORDERS": spark.range(20).selectExpr("id", "'a' AS v"), "FEW": spark.range(3).selectExpr("id", "'a' AS v"),
              "TWICE": spark.range(6).selectExpr("id % 3 AS id", "'a' AS v")}
    fine = TableSpec("o", "ORDERS", "S", "files", ("id",), row_count_min=10, reference_date="D-1")
    read = lambda s: tables[s.table]
    assert daily.run_as_of(spark, read, [fine, few, twice], base, D[3], gate=True, buckets=4) == [D[1], D[2]]
    assert rows(silver.read_state(spark, base, D[2]).select("table_name").distinct()) == [("S.ORDERS",)]
    assert silver.read_state(spark, base, D[1]).isEmpty()
    failed = lake.read_contract_results(spark, base, D[2]).unionByName(lake.read_contract_results(spark, base, D[1])).filter("NOT passed")
    assert rows(failed, "table_name", "check") == [("few", "row_count_min"), ("twice", "duplicates_max")]
    # Nothing was loaded anew: what failed stays out.
    daily.run_day(spark, read, [fine, twice], base, D[2], gate=True, buckets=4)
    assert rows(silver.read_state(spark, base, D[2]).select("table_name").distinct()) == [("S.ORDERS",)]
    # A better load of the next day is all new, since the day before does not count.
    tables["TWICE"] = spark.range(3).selectExpr("id", "'a' AS v")
    got = daily.run_day(spark, read, [fine, twice], base, D[3], gate=True, buckets=4)
    assert rows(got, "table_name", "total_inserts", "total_active_records") == [("S.TWICE", 3, 3)]
    assert {r["name"] for r in daily.read_metadata(spark, base).collect()} == {"S.ORDERS", "S.FEW", "S.TWICE"}
    edges = {(r.source_table, r.target_table) for r in daily.read_lineage(spark, base).collect()}
    assert ("S.ORDERS", "bronze.S.ORDERS") in edges and ("S.FEW", "bronze.S.FEW") not in edges


def test_run_scope(spark):
    shared = pathlib.Path(shared_dir(spark))
    before = names(shared)
    with RunScope(spark):
        stage(spark.range(3))
        with RunScope(spark):
            stage(spark.range(3))
        assert len(names(shared)) == len(before) + 1
    assert names(shared) == before
    with pytest.raises(RuntimeError), RunScope(spark):
        stage(spark.range(3))
        raise RuntimeError("lost")
    assert names(shared) == before
    with RunScope(spark) as scope:
        rows = stage(spark.range(3))
        scope.detach()
    assert rows.count() == 3
    scope.close()
    assert names(shared) == before
    path = new_path(spark, "free")  # outside a scope nobody owns it
    assert path not in scope.paths


@pytest.mark.parametrize("offset", [0, 7, 4321, 9990, 9999, 10_000, 20_000])
def test_deep_pages(spark, rows, offset, monkeypatch):
    df = spark.range(10_000).selectExpr("CAST(id DIV 7 AS INT) AS a", "IF(id % 5 = 0, NULL, CAST(id % 7 AS STRING)) AS b", "id AS c").repartition(5)
    sorted_rows = []
    real = type(df).orderBy

    def spy(self, *cols, **kw):
        if "c" in cols:
            sorted_rows.append(self.count())
        return real(self, *cols, **kw)

    monkeypatch.setattr(type(df), "orderBy", spy)
    got = pages.read_deep_page(df, ["a", "b", "c"], 25, offset, ranges=8, most=50)
    monkeypatch.undo()
    want = real(df, "a", "b", "c").collect()[offset : offset + 25]
    assert got.collect() == want
    # What is sorted at last is a small range and the page, however deep the page lies.
    assert all(n <= 50 + 25 for n in sorted_rows)


def test_a_page_inside_one_key(spark):
    df = spark.range(500).selectExpr("id", "1 AS k")
    assert pages.read_deep_page(df, ["k"], 10, 250, ranges=4, most=5).count() == 10
    assert pages.read_deep_page(df.limit(0), ["k"], 10, 0).isEmpty()


def test_sketches_merge_to_what_one_pass_gives(spark):
    df = spark.range(30_000).selectExpr("id % 10 AS day", "id % 2000 AS user", "CAST(id AS DOUBLE) AS value")
    daily_rows = stage(sketches.daily_sketches(df, ["day"], ["user"], ["value"]))
    assert daily_rows.count() == 10
    week = sketches.read_sketches(sketches.merge_sketches(daily_rows.filter("day < 7")), [0.25, 0.5]).first()
    exact = df.filter("day < 7")
    assert week.row_count == exact.count() == 21_000
    users = exact.select("user").distinct().count()
    assert abs(week.user_distinct - users) <= 5 * 1.04 / 2 ** (sketches.LG_K / 2) * users
    for q, found in ((0.25, week.value_p25), (0.5, week.value_p50)):
        assert abs(exact.filter(F.col("value") <= found).count() / 21_000 - q) <= 0.03
    assert sketches.merge_sketches(daily_rows.limit(0), ["day"]).isEmpty()


SCHEMA = "k STRING, n BIGINT"


def test_repeated_appends_count_once(spark, tmp_path, rows, monkeypatch):
    path, part = str(tmp_path / "m"), "day=2024-01-01"
    one, two = (spark.createDataFrame([("a", n), ("b", n)], SCHEMA) for n in (1, 10))
    collapse = lambda df: collapse_sum(df, ["k"], ["n"])
    total = lambda: rows(collapse(compaction.read_runs_of(spark, path, part, SCHEMA)), "k", "n")
    assert total() == []
    for _ in range(2):
        assert compaction.append_run(one, path, part, "r1") and compaction.append_run(two, path, part, "r2")
    assert total() == [("a", 11), ("b", 11)]
    for step in ("write_version", "delete_path"):
        with monkeypatch.context() as m:
            m.setattr(compaction, step, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                compaction.compact_partition(spark, path, part, SCHEMA, collapse)
        assert total() == [("a", 11), ("b", 11)]
    compaction.compact_partition(spark, path, part, SCHEMA, collapse)
    assert not compaction.append_run(one, path, part, "r1")  # taken in already
    assert compaction.append_run(one, path, part, "r3") and total() == [("a", 12), ("b", 12)]
    assert compaction.compact_partition(spark, path, part, SCHEMA, collapse) == 1
    assert total() == [("a", 12), ("b", 12)] and len(names(f"{path}/{part}")) == 1
    assert compaction.compact_partition(spark, path, part, SCHEMA, collapse) == 0


def test_first_rows_over_all_days_with_maps(spark, rows):
    df = spark.sql("SELECT * FROM VALUES ('2024-01-02', 1, map('a', 1)), ('2024-01-01', 1, map('a', 1)), ('2024-01-01', 2, map('b', 2)) AS t(reference_date, id, m)")
    assert rows(silver.silver_dedupe(df, scope="all"), "reference_date", "id") == [("2024-01-01", 1), ("2024-01-01", 2)]

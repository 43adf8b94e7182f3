"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(entry.core))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in text for bad in ("CartesianProduct", "NestedLoopJoin", "Python"))
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in entry.oracle_sql():
        assert got
        return
    result = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=str)
    assert got == want


def left_behind(spark):
    import pathlib

    return sorted(p.name for p in pathlib.Path(spark.conf.get("spark.checkpoint.dir")).iterdir())


def test_queries_leave_nothing_staged(spark, monkeypatch):
    entry.release()
    before = left_behind(spark)
    for name in ("delta_events_late_payload", "daily_run_changes", "stream_customer_ltv"):
        assert entry.queries()[name](spark, SF_DIR).count() and left_behind(spark) != before
        entry.release()
        assert left_behind(spark) == before
    monkeypatch.setattr(entry.ledger, "now", lambda: 1 / 0)
    monkeypatch.setattr(entry.delta, "attach_payload", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        entry.queries()["delta_events_late_payload"](spark, SF_DIR)
    assert left_behind(spark) == before


def test_sorted_names_returns_every_name_in_order(spark, db):
    names = [r.c_name for r in entry.queries()["sorted_names"](spark, SF_DIR).collect()]
    stored = [n for (n,) in db.execute("SELECT c_name FROM customer").fetchall()]
    assert len(stored) > 40 and names == sorted(stored)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

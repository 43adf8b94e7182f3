"""Queries over the driver's tables, and the same results as DuckDB SQL.

Two daily snapshots of ``orders`` are derived from the table's own values, so that
every order takes part on at least one day: pending orders (status P) arrive on
the second day, finished orders of low priority are archived before it, and
urgent orders get a surcharge of 1 on it. Daily snapshots over a whole month come
from ``events``: one row per day and active user.

Dates leave a query as ISO text and decimals as doubles, in Spark and in SQL.
"""

from __future__ import annotations

import atexit
import contextlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from snapdelta.functions import (
    add_row_hash,
    build_schema,
    cast_to,
    clean_strings,
    normalize_case,
    primary_key,
    row_hash,
    valid_operation,
    with_year_month,
)
from snapdelta.operators import aggregates, catalog, delta, ledger, metrics, profile, quality, sketches, state
from snapdelta.operators.envelope import (
    for_snapshot,
    has_columns,
    name_in,
    name_like,
    numeric_columns,
    parse_payload,
    rename_project,
    to_envelope,
    with_ingestion_metadata,
    with_snapshot_hash,
)
from snapdelta.plans.bronze import ingest_table, ingest_tables, load_envelope, snapshot_path
from snapdelta.plans.daily import ddl_for_missing, read_lineage, read_metadata, run_as_of, run_day
from snapdelta.plans.gold import gold_path, read_change_metrics, read_quality_metrics
from snapdelta.plans.lake import read_contract_results, run_lake
from snapdelta.plans.silver import read_events, read_state, silver_dedupe, silver_transform, typed_silver
from snapdelta.plans.specs import TableSpec
from snapdelta.schemas import INGESTION_CONTROL, RUN_METRICS, TABLE_METADATA
from snapdelta.session import RunScope, new_path
from snapdelta.sinks.compaction import append_run, compact_partition, read_runs_of
from snapdelta.sinks.ddl import catalog_to_ddl, schema_to_ddl
from snapdelta.sinks.layers import align, append_aligned, clustered, overwrite_partitions, write_layer, write_staging
from snapdelta.sources.pages import read_deep_page
from snapdelta.sources.tables import first_available, read_catalog_table, read_layer, read_page, scan_catalog, stage
from snapdelta.streaming import gold, sales

SMOKE_DIR = "/root/testdata/sf0.001"
PREV_DAY, REF_DAY = "2024-01-01", "2024-01-02"
MONTH_END = "2024-01-30"

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}
_open: list[RunScope] = []


def scoped(fn: Query) -> Query:
    """The query with what it stages in a scope of its own; gone at once if it fails."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with RunScope(spark) as scope:
            df = fn(spark, sf_dir)
            _open.append(scope.detach())  # the result may still read what was staged
        return df

    return run


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if there is one, its SQL."""

    def register(fn: Query) -> Query:
        _queries[name] = scoped(lambda spark, sf_dir: _plain(fn(spark, sf_dir)))
        if sql is not None:
            _oracles[name] = sql
        return fn

    return register


def release() -> None:
    """Remove what the queries so far have staged, once their results are used up; also done
    when the interpreter ends."""
    while _open:
        with contextlib.suppress(Exception):  # the session may be gone by then
            _open.pop().close()


atexit.register(release)


def row_count_of(df: DataFrame) -> int:
    return aggregates.row_count(df).first()["row_count"]


def _plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, decimals as doubles."""

    def plain(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- inputs ------------------------------------------------------------------

MONEY = "decimal(18,2)"

ORDERS_SQL = """
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
         CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
  FROM orders
"""
ENVELOPE_SQL = """
  SELECT DATE '{day}' AS ref_date, '{table}' AS table_name, CAST(o_orderkey AS VARCHAR) AS primary_key,
         sha256(concat_ws('|||', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority))
           AS row_hash,
         CAST(to_json({{'o_orderkey': o_orderkey, 'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus,
           'o_totalprice': o_totalprice, 'o_orderdate': o_orderdate, 'o_orderpriority': o_orderpriority}}) AS VARCHAR)
           AS data
  FROM {rows}
"""
SNAPSHOTS_SQL = f"""
  base AS ({ORDERS_SQL}),
  prev_rows AS (SELECT * FROM base WHERE o_orderstatus <> 'P'),
  cur_rows AS (
    SELECT * REPLACE (CAST(o_totalprice + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END
                           AS DECIMAL(18,2)) AS o_totalprice)
    FROM base WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')),
  prev AS ({ENVELOPE_SQL.format(day=PREV_DAY, table="orders", rows="prev_rows")}),
  cur AS ({ENVELOPE_SQL.format(day=REF_DAY, table="orders", rows="cur_rows")})
"""
EVENTS_SQL = f"""
  {SNAPSHOTS_SQL},
  delta AS (
    SELECT '{REF_DAY}' AS ref_date, coalesce(c.table_name, p.table_name) AS table_name,
           coalesce(c.primary_key, p.primary_key) AS primary_key,
           CASE WHEN p.primary_key IS NULL THEN 'INSERT' WHEN c.primary_key IS NULL THEN 'DELETE'
                ELSE 'UPDATE' END AS operation_type,
           p.row_hash AS row_hash_before, c.row_hash AS row_hash_after,
           p.data AS data_before, c.data AS data_after
    FROM cur c FULL JOIN prev p ON c.table_name = p.table_name AND c.primary_key = p.primary_key
    WHERE p.primary_key IS NULL OR c.primary_key IS NULL OR p.row_hash <> c.row_hash)
"""
ACTIVITY_SQL = """
  daily AS (
    SELECT CAST(ts AS DATE) AS ref_date, user_id, count(*) AS events,
           sum(CAST(value AS DECIMAL(18,2))) AS total
    FROM events GROUP BY 1, 2),
  history AS (
    SELECT ref_date, 'user_activity' AS table_name, CAST(user_id AS VARCHAR) AS primary_key,
           sha256(concat_ws('|||', user_id, events, total)) AS row_hash,
           CAST(to_json({'user_id': user_id, 'events': events, 'total': total}) AS VARCHAR) AS data
    FROM daily)
"""
CHANGES_SQL = f"""
  {ACTIVITY_SQL},
  days AS (SELECT DISTINCT ref_date FROM history),
  before AS (SELECT h.* REPLACE (h.ref_date + 1 AS ref_date) FROM history h
             WHERE h.ref_date + 1 IN (SELECT ref_date FROM days)),
  changes AS (
    SELECT coalesce(c.ref_date, CAST(p.ref_date AS DATE)) AS ref_date,
           coalesce(c.table_name, p.table_name) AS table_name,
           coalesce(c.primary_key, p.primary_key) AS primary_key,
           CASE WHEN p.primary_key IS NULL THEN 'INSERT' WHEN c.primary_key IS NULL THEN 'DELETE'
                ELSE 'UPDATE' END AS operation_type,
           p.row_hash AS row_hash_before, c.row_hash AS row_hash_after,
           p.data AS data_before, c.data AS data_after
    FROM history c FULL JOIN before p
      ON c.ref_date = CAST(p.ref_date AS DATE) AND c.table_name = p.table_name AND c.primary_key = p.primary_key
    WHERE p.primary_key IS NULL OR c.primary_key IS NULL OR p.row_hash <> c.row_hash)
"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").withColumns(
        {"o_totalprice": F.col("o_totalprice").cast(MONEY), "o_orderdate": F.col("o_orderdate").cast("date")}
    )


def _prev_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).filter(F.col("o_orderstatus") != "P")


def _cur_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    surcharge = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
    return (
        _orders(spark, sf_dir)
        .filter(~((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")))
        .withColumn("o_totalprice", (F.col("o_totalprice") + surcharge).cast(MONEY))
    )


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Envelopes of the current and the previous day."""
    key = ["o_orderkey"]
    return (
        to_envelope(_cur_orders(spark, sf_dir), "orders", key, REF_DAY),
        to_envelope(_prev_orders(spark, sf_dir), "orders", key, PREV_DAY),
    )


def _delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.detect_delta(*_snapshots(spark, sf_dir), REF_DAY)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily snapshots of user activity, all days in one table."""
    daily = (
        _table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("ref_date"), "user_id")
        .agg(F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast(MONEY)).alias("total"))
    )
    return to_envelope(daily, "user_activity", ["user_id"], F.col("ref_date"))


def _sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the column names of the sales metrics."""
    return rename_project(
        _orders(spark, sf_dir),
        {
            "o_orderkey": "order_id",
            "o_custkey": "customer_id",
            "o_orderdate": "order_date",
            "o_totalprice": "total_amount",
        },
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with exact amounts; their key has duplicates."""
    amounts = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return _table(spark, sf_dir, "lineitem").withColumns(
        {**{c: F.col(c).cast(MONEY) for c in amounts}, "l_shipdate": F.col("l_shipdate").cast("date")}
    )


LINE_KEY = ["l_orderkey", "l_linenumber"]

# --- envelopes and hashes ------------------------------------------------------


@query(
    "envelope_orders",
    f"WITH {SNAPSHOTS_SQL} SELECT CAST(ref_date AS VARCHAR) AS ref_date, table_name, primary_key, row_hash, data "
    "FROM cur",
)
def envelope_orders(spark, sf_dir):
    return _snapshots(spark, sf_dir)[0].drop("ingestion_timestamp")


@query(
    "row_hash_null_safe",
    """
    WITH r AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS a, nullif(o_orderpriority, '1-URGENT') AS b FROM orders)
    SELECT o_orderkey, sha256(concat_ws('|||', o_orderkey, a, b)) AS plain_hash,
           sha256('0' || CASE WHEN a IS NULL THEN '1' ELSE '0' END || CASE WHEN b IS NULL THEN '1' ELSE '0' END
                  || '|||' || concat_ws('|||', o_orderkey, a, b)) AS safe_hash
    FROM r
    """,
)
def row_hash_null_safe(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("a"),
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("b"),
    )
    cols = ["o_orderkey", "a", "b"]
    return rows.select(
        "o_orderkey", row_hash(cols).alias("plain_hash"), row_hash(cols, null_safe=True).alias("safe_hash")
    )


@query(
    "row_hash_json",
    """
    SELECT c_custkey, sha256(CAST(to_json({'c_acctbal': CAST(c_acctbal AS DECIMAL(18,2)), 'c_custkey': c_custkey,
             'c_mktsegment': c_mktsegment, 'c_name': c_name}) AS VARCHAR)) AS row_hash
    FROM customer
    """,
)
def row_hash_json(spark, sf_dir):
    rows = _table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast(MONEY))
    return add_row_hash(rows, exclude=["c_nationkey"]).select("c_custkey", "row_hash")


@query(
    "staging_hash",
    f"""
    WITH base AS ({ORDERS_SQL})
    SELECT *  REPLACE (CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate),
           '{REF_DAY}' AS snapshot_date,
           sha256(concat_ws('||', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority))
             AS record_hash
    FROM base
    """,
)
def staging_hash(spark, sf_dir):
    return with_snapshot_hash(_orders(spark, sf_dir), REF_DAY)


@query(
    "composite_key_counts",
    """
    SELECT l_orderkey || '|||' || l_linenumber AS primary_key, count(*) AS copies
    FROM lineitem GROUP BY 1 HAVING count(*) > 1
    """,
)
def composite_key_counts(spark, sf_dir):
    keys = _table(spark, sf_dir, "lineitem").select(primary_key(LINE_KEY).alias("primary_key"))
    return keys.groupBy("primary_key").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


# --- changes -------------------------------------------------------------------


@query("delta_events", f"WITH {EVENTS_SQL} SELECT * FROM delta")
def delta_events(spark, sf_dir):
    return _delta(spark, sf_dir)


@query("split_delta", f"WITH {EVENTS_SQL} SELECT * FROM delta")
def split_delta(spark, sf_dir):
    return delta.split_delta(*_snapshots(spark, sf_dir), REF_DAY)


@query("delta_inserts", f"WITH {EVENTS_SQL} SELECT * FROM delta WHERE operation_type = 'INSERT'")
def delta_inserts(spark, sf_dir):
    return delta.delta_inserts(*_snapshots(spark, sf_dir), REF_DAY)


@query("delta_updates", f"WITH {EVENTS_SQL} SELECT * FROM delta WHERE operation_type = 'UPDATE'")
def delta_updates(spark, sf_dir):
    return delta.delta_updates(*_snapshots(spark, sf_dir), REF_DAY)


@query("delta_deletes", f"WITH {EVENTS_SQL} SELECT * FROM delta WHERE operation_type = 'DELETE'")
def delta_deletes(spark, sf_dir):
    return delta.delta_deletes(*_snapshots(spark, sf_dir), REF_DAY)


@query("delta_events_late_payload", f"WITH {EVENTS_SQL} SELECT * FROM delta")
def delta_events_late_payload(spark, sf_dir):
    cur, prev = _snapshots(spark, sf_dir)
    found = stage(delta.detect_delta(cur.drop("data"), prev.drop("data"), REF_DAY))
    return delta.attach_payload(found, cur, prev)


@query(
    "delta_history",
    f"WITH {CHANGES_SQL} SELECT * REPLACE (CAST(ref_date AS VARCHAR) AS ref_date) FROM changes",
)
def delta_history(spark, sf_dir):
    return delta.detect_delta_range(_history(spark, sf_dir))


@query(
    "delta_summary",
    f"WITH {EVENTS_SQL} SELECT operation_type, count(*) AS total FROM delta GROUP BY operation_type",
)
def delta_summary(spark, sf_dir):
    return delta.delta_summary(_delta(spark, sf_dir), REF_DAY, "orders")


@query(
    "operation_count",
    f"WITH {EVENTS_SQL} SELECT count(*) AS total FROM delta WHERE operation_type = 'UPDATE'",
)
def operation_count(spark, sf_dir):
    return delta.operation_count(_delta(spark, sf_dir), REF_DAY, "orders", "UPDATE")


LINE_SNAPSHOTS_SQL = """
  prev AS (SELECT l_orderkey || '|||' || l_linenumber AS primary_key,
             sha256(concat_ws('|||', l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS DECIMAL(18,2)))) AS h
           FROM lineitem WHERE l_linestatus <> 'O' OR l_returnflag <> 'N'),
  cur AS (SELECT l_orderkey || '|||' || l_linenumber AS primary_key,
             sha256(concat_ws('|||', l_orderkey, l_linenumber, l_partkey,
               CAST(l_quantity + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DECIMAL(18,2)))) AS h
          FROM lineitem WHERE l_linestatus <> 'F' OR l_returnflag <> 'A')
"""


def _line_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line items on two days; returned ones gain a unit, and key duplicates are real."""
    lines = _lines(spark, sf_dir)
    cols = [*LINE_KEY, "l_partkey", "l_quantity"]
    prev = lines.filter((F.col("l_linestatus") != "O") | (F.col("l_returnflag") != "N"))
    more = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    cur = lines.filter((F.col("l_linestatus") != "F") | (F.col("l_returnflag") != "A")).withColumn(
        "l_quantity", (F.col("l_quantity") + more).cast(MONEY)
    )
    return (
        to_envelope(cur.select(*cols), "lineitem", LINE_KEY, REF_DAY),
        to_envelope(prev.select(*cols), "lineitem", LINE_KEY, PREV_DAY),
    )


@query(
    "duplicate_key_delta",
    f"""
    WITH {LINE_SNAPSHOTS_SQL},
    c AS (SELECT primary_key, max(h) AS row_hash_after FROM cur GROUP BY 1),
    p AS (SELECT primary_key, max(h) AS row_hash_before FROM prev GROUP BY 1)
    SELECT primary_key, CASE WHEN row_hash_before IS NULL THEN 'INSERT' WHEN row_hash_after IS NULL THEN 'DELETE'
             ELSE 'UPDATE' END AS operation_type, row_hash_before, row_hash_after
    FROM c FULL JOIN p USING (primary_key)
    WHERE row_hash_before IS DISTINCT FROM row_hash_after
    """,
)
def duplicate_key_delta(spark, sf_dir):
    cur, prev = _line_snapshots(spark, sf_dir)
    return delta.detect_delta(cur, prev, REF_DAY).select(
        "primary_key", "operation_type", "row_hash_before", "row_hash_after"
    )


@query(
    "duplicate_key_versions",
    f"""
    WITH {LINE_SNAPSHOTS_SQL},
    v AS (SELECT primary_key, h, 1 AS b, 0 AS a FROM prev UNION ALL SELECT primary_key, h, 0, 1 FROM cur)
    SELECT 'lineitem' AS table_name, primary_key, h AS row_hash,
           CAST(sum(b) AS BIGINT) AS rows_before, CAST(sum(a) AS BIGINT) AS rows_after
    FROM v GROUP BY primary_key, h
    """,
)
def duplicate_key_versions(spark, sf_dir):
    return delta.delta_versions(*_line_snapshots(spark, sf_dir))


@query(
    "row_pair_counts",
    f"""
    WITH {LINE_SNAPSHOTS_SQL}
    SELECT 'lineitem' AS table_name,
      (SELECT count(*) FROM cur WHERE primary_key NOT IN (SELECT primary_key FROM prev)) AS inserts,
      (SELECT count(*) FROM cur JOIN prev USING (primary_key) WHERE cur.h <> prev.h) AS updates,
      (SELECT count(*) FROM prev WHERE primary_key NOT IN (SELECT primary_key FROM cur)) AS deletes
    """,
)
def row_pair_counts(spark, sf_dir):
    return delta.row_pair_counts(*_line_snapshots(spark, sf_dir))


# --- state -----------------------------------------------------------------------

STATE_SQL = f"""
  WITH {SNAPSHOTS_SQL}
  SELECT coalesce(c.table_name, p.table_name) AS table_name, coalesce(c.primary_key, p.primary_key) AS primary_key,
         coalesce(c.row_hash, p.row_hash) AS row_hash, coalesce(c.data, p.data) AS data,
         CASE WHEN p.primary_key IS NULL THEN '{REF_DAY}' ELSE '{PREV_DAY}' END AS first_seen_date,
         CASE WHEN c.primary_key IS NULL THEN '{PREV_DAY}' ELSE '{REF_DAY}' END AS last_seen_date,
         CASE WHEN c.primary_key IS NULL THEN 0 ELSE 1 END AS is_active
  FROM cur c FULL JOIN prev p ON c.primary_key = p.primary_key
"""


@query("maintain_current_state", STATE_SQL)
def maintain_current_state(spark, sf_dir):
    cur, prev = _snapshots(spark, sf_dir)
    old = state.state_from_history(prev, PREV_DAY)
    return state.maintain_current_state(old, cur, REF_DAY).drop("updated_at")


@query("apply_delta", STATE_SQL)
def apply_delta(spark, sf_dir):
    cur, prev = _snapshots(spark, sf_dir)
    old = state.state_from_history(prev, PREV_DAY)
    return state.apply_delta(old, delta.detect_delta(cur, prev, REF_DAY), REF_DAY).drop("updated_at")


@query(
    "state_from_history",
    f"""
    WITH {ACTIVITY_SQL}
    SELECT table_name, primary_key, arg_max(row_hash, ref_date) AS row_hash, arg_max(data, ref_date) AS data,
           CAST(min(ref_date) AS VARCHAR) AS first_seen_date, CAST(max(ref_date) AS VARCHAR) AS last_seen_date,
           CASE WHEN max(ref_date) = DATE '{MONTH_END}' THEN 1 ELSE 0 END AS is_active
    FROM history WHERE ref_date <= DATE '{MONTH_END}' GROUP BY table_name, primary_key
    """,
)
def state_from_history(spark, sf_dir):
    return state.state_from_history(_history(spark, sf_dir), MONTH_END).drop("updated_at")


@query(
    "append_current_state_collapsed",
    f"""
    WITH {SNAPSHOTS_SQL}
    SELECT coalesce(c.table_name, p.table_name) AS table_name, coalesce(c.primary_key, p.primary_key) AS primary_key,
           coalesce(c.row_hash, p.row_hash) AS row_hash,
           CASE WHEN c.primary_key IS NULL THEN '{PREV_DAY}' ELSE '{REF_DAY}' END AS first_seen_date,
           CASE WHEN c.primary_key IS NULL THEN '{PREV_DAY}' ELSE '{REF_DAY}' END AS last_seen_date,
           1 AS is_active
    FROM cur c FULL JOIN prev p ON c.primary_key = p.primary_key
    """,
)
def append_current_state_collapsed(spark, sf_dir):
    appended = [
        state.append_current_state(s, F.col("ref_date").cast("timestamp")) for s in _snapshots(spark, sf_dir)
    ]
    rows = appended[0].unionByName(appended[1])
    return state.collapse_latest(rows, ["table_name", "primary_key"], "updated_at").drop("data", "updated_at")


COUNTS_SQL = """
  counts AS (
    SELECT ref_date, table_name, count(*) FILTER (operation_type = 'INSERT') AS total_inserts,
           count(*) FILTER (operation_type = 'UPDATE') AS total_updates,
           count(*) FILTER (operation_type = 'DELETE') AS total_deletes
    FROM changes GROUP BY ref_date, table_name)
"""


@query(
    "collapse_sum",
    f"""
    WITH {CHANGES_SQL}, {COUNTS_SQL}
    SELECT CAST(ref_date AS VARCHAR) AS ref_date, table_name, 2 * total_inserts AS total_inserts,
           2 * total_updates AS total_updates, 2 * total_deletes AS total_deletes
    FROM counts
    """,
)
def collapse_sum(spark, sf_dir):
    counts = metrics.change_counts(delta.detect_delta_range(_history(spark, sf_dir)))
    return state.collapse_sum(
        counts.unionByName(counts), ["ref_date", "table_name"], ["total_inserts", "total_updates", "total_deletes"]
    )


@query(
    "latest_order_by_customer",
    f"""
    WITH base AS ({ORDERS_SQL}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
               FROM base)
    SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
    FROM ranked WHERE rn = 1
    """,
)
def latest_order_by_customer(spark, sf_dir):
    return state.latest_by_key(_orders(spark, sf_dir), ["o_custkey"], ["o_orderdate", "o_orderkey"])


# --- metrics -----------------------------------------------------------------------


@query(
    "daily_change_metrics",
    f"""
    WITH {EVENTS_SQL}
    SELECT ref_date, table_name, count(*) FILTER (operation_type = 'INSERT') AS total_inserts,
           count(*) FILTER (operation_type = 'UPDATE') AS total_updates,
           count(*) FILTER (operation_type = 'DELETE') AS total_deletes,
           (SELECT count(*) FROM cur) AS total_active_records
    FROM delta GROUP BY ref_date, table_name
    """,
)
def daily_change_metrics(spark, sf_dir):
    cur, prev = _snapshots(spark, sf_dir)
    current = state.state_from_history(cur.unionByName(prev), REF_DAY)
    return metrics.daily_change_metrics(delta.detect_delta(cur, prev, REF_DAY), current, REF_DAY)


@query(
    "data_quality_metrics",
    f"""
    WITH q AS (
      SELECT l_returnflag AS table_name, count(*) FILTER (l_tax = 0) AS null_count,
             count(*) - count(DISTINCT l_orderkey || '|||' || l_linenumber) AS duplicate_count,
             count(*) AS total_records
      FROM lineitem GROUP BY l_returnflag)
    SELECT '{REF_DAY}' AS ref_date, *,
           100.0::DOUBLE * (1.0::DOUBLE - CAST(null_count + duplicate_count AS DOUBLE) / total_records)
             AS quality_score
    FROM q
    """,
)
def data_quality_metrics(spark, sf_dir):
    return metrics.data_quality_metrics(_flag_snapshot(spark, sf_dir), REF_DAY)


@query(
    "data_quality_metrics_approx",
    f"""
    SELECT '{REF_DAY}' AS ref_date, l_returnflag AS table_name, count(*) AS total_records, true AS close
    FROM lineitem GROUP BY l_returnflag
    """,
)
def data_quality_metrics_approx(spark, sf_dir):
    """Approximate duplicates lie within four standard errors (5 % each) of the exact keys."""
    rows = _flag_snapshot(spark, sf_dir)
    close = metrics.data_quality_metrics(rows, REF_DAY, approx=True).select(
        "ref_date", "table_name", "total_records", F.col("duplicate_count").alias("approximate")
    )
    exact = metrics.data_quality_metrics(rows, REF_DAY).select("table_name", "duplicate_count")
    keys = F.col("total_records") - F.col("duplicate_count")
    near = F.abs(F.col("approximate") - F.col("duplicate_count")) <= 0.2 * keys
    return close.join(exact, "table_name").select("ref_date", "table_name", "total_records", near.alias("close"))


def _flag_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as one table per return flag; untaxed lines have a blank payload."""
    lines = _lines(spark, sf_dir)
    rows = to_envelope(lines, "lineitem", LINE_KEY, REF_DAY)
    flagged = lines.select(
        F.lit(REF_DAY).cast("date").alias("ref_date"),
        F.col("l_returnflag").alias("table_name"),
        primary_key(LINE_KEY).alias("primary_key"),
        F.when(F.col("l_tax") == 0, "").otherwise(F.to_json(F.struct(*lines.columns))).alias("data"),
    )
    return align(flagged, rows.schema)


@query(
    "quality_limits",
    """
    WITH q AS (
      SELECT l_returnflag AS table_name, count(*) FILTER (l_tax = 0) AS nulls,
             count(*) - count(DISTINCT l_orderkey || '|||' || l_linenumber) AS dups, count(*) AS total
      FROM lineitem GROUP BY l_returnflag)
    SELECT table_name, dups AS duplicate_count,
           (100.0::DOUBLE * (1.0::DOUBLE - CAST(nulls + dups AS DOUBLE) / total) >= 95 AND dups <= 0) AS passed
    FROM q
    """,
)
def quality_limits(spark, sf_dir):
    measured = metrics.data_quality_metrics(_flag_snapshot(spark, sf_dir), REF_DAY)
    limits = quality.default_limits(_flag_snapshot(spark, sf_dir))
    return quality.check_quality(measured, limits).select("table_name", "duplicate_count", "passed")


@query(
    "historical_trends",
    f"""
    WITH {CHANGES_SQL}, {COUNTS_SQL},
    active AS (
      SELECT table_name, count(*) AS n
      FROM (SELECT table_name, primary_key, max(ref_date) AS last FROM history GROUP BY 1, 2)
      WHERE last = DATE '{MONTH_END}' GROUP BY 1)
    SELECT CAST(ref_date AS VARCHAR) AS ref_date, table_name, total_inserts, total_updates, total_deletes,
           coalesce(n, 0) AS total_active_records
    FROM counts LEFT JOIN active USING (table_name)
    ORDER BY ref_date DESC, table_name LIMIT 50
    """,
)
def historical_trends(spark, sf_dir):
    history = stage(_history(spark, sf_dir))  # snapshots are stored tables
    counts = metrics.change_counts(delta.detect_delta_range(history))
    return metrics.historical_trends(
        metrics.with_active_counts(counts, state.state_from_history(history, MONTH_END))
    )


SALES_SQL = f"""
  WITH base AS ({ORDERS_SQL})
  SELECT CAST(o_orderdate AS VARCHAR) AS order_date, CAST(sum(o_totalprice) AS DOUBLE) AS total_amount_sum,
         CAST(sum(o_totalprice) AS DOUBLE) / count(o_totalprice) AS total_amount_avg,
         CAST(max(o_totalprice) AS DOUBLE) AS total_amount_max, count(o_orderkey) AS order_id_count,
         count(DISTINCT o_custkey) AS "customer_id_countDistinct"
  FROM base GROUP BY o_orderdate
"""
LTV_SQL = f"""
  WITH base AS ({ORDERS_SQL})
  SELECT o_custkey AS customer_id, CAST(sum(o_totalprice) AS DOUBLE) AS lifetime_value, count(*) AS order_count,
         CAST(min(o_orderdate) AS VARCHAR) AS first_order_date, CAST(max(o_orderdate) AS VARCHAR) AS last_order_date
  FROM base GROUP BY o_custkey
"""


@query("daily_sales_summary", SALES_SQL)
def daily_sales_summary(spark, sf_dir):
    return metrics.daily_sales_summary(_sales_orders(spark, sf_dir))


@query("customer_ltv", LTV_SQL)
def customer_ltv(spark, sf_dir):
    return metrics.customer_ltv(_sales_orders(spark, sf_dir))


def _order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as a stream of four batches."""
    schema = _table(spark, sf_dir, "orders").schema
    # Several files, a batch each: what the batches leave is combined when it is read.
    files = new_path(spark, "order-files")
    _table(spark, sf_dir, "orders").repartition(4, "o_orderkey").write.parquet(files)
    raw = sales.read_order_stream(spark, files, schema, files_per_batch=1)
    return raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
    )


def _streamed_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream all orders into partial results and read them."""
    target, offsets = new_path(spark, "sales-partials"), new_path(spark, "sales-offsets")
    sales.stream_daily_sales(_order_stream(spark, sf_dir), target, offsets).awaitTermination()
    return sales.read_partials(spark, target, offsets)


@query("stream_daily_sales", SALES_SQL)
def stream_daily_sales(spark, sf_dir):
    return sales.daily_sales_from_partials(_streamed_partials(spark, sf_dir))


@query("stream_customer_ltv", LTV_SQL)
def stream_customer_ltv(spark, sf_dir):
    return sales.customer_ltv_from_partials(sales.compact_partials(_streamed_partials(spark, sf_dir)))


def _streamed_gold(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Stream all orders into the gold tables and read one."""
    base, offsets = new_path(spark, "sales-gold"), new_path(spark, "gold-offsets")
    gold.stream_gold_sales(_order_stream(spark, sf_dir), base, offsets).awaitTermination()
    return gold.read_gold(spark, base, table)


@query("stream_gold_sales", SALES_SQL)
def stream_gold_sales(spark, sf_dir):
    return _streamed_gold(spark, sf_dir, gold.DAILY)


@query("stream_gold_ltv", LTV_SQL)
def stream_gold_ltv(spark, sf_dir):
    return _streamed_gold(spark, sf_dir, gold.CUSTOMERS)


@query(
    "line_metrics_by_supplier",
    """
    WITH l AS (SELECT l_suppkey, l_returnflag, l_partkey, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity FROM lineitem)
    SELECT l_suppkey, l_returnflag, CAST(sum(l_quantity) AS DOUBLE) AS l_quantity_sum,
           CAST(min(l_quantity) AS DOUBLE) AS l_quantity_min, CAST(max(l_quantity) AS DOUBLE) AS l_quantity_max,
           CAST(sum(l_quantity) AS DOUBLE) / count(l_quantity) AS l_quantity_avg,
           count(DISTINCT l_partkey) AS "l_partkey_countDistinct", count(l_partkey) AS l_partkey_count
    FROM l GROUP BY l_suppkey, l_returnflag
    """,
)
def line_metrics_by_supplier(spark, sf_dir):
    spec = {"l_quantity": ["sum", "min", "max", "avg"], "l_partkey": ["countDistinct", "count"]}
    return metrics.aggregate_spec(_lines(spark, sf_dir), ["l_suppkey", "l_returnflag"], spec)


# --- counts, distinct values, pages --------------------------------------------------


@query("row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf_dir):
    return aggregates.row_count(_table(spark, sf_dir, "lineitem"))


@query("count_distinct", 'SELECT count(DISTINCT l_partkey) AS "l_partkey_countDistinct" FROM lineitem')
def count_distinct(spark, sf_dir):
    return aggregates.count_distinct(_table(spark, sf_dir, "lineitem"), "l_partkey")


@query("group_count_desc", 'SELECT event_type, user_id, count(*) AS "count" FROM events GROUP BY 1, 2')
def group_count_desc(spark, sf_dir):
    return aggregates.group_count_desc(_table(spark, sf_dir, "events"), ["event_type", "user_id"])


@query(
    "top_groups",
    'SELECT user_id, count(*) AS "count" FROM events GROUP BY user_id ORDER BY "count" DESC, user_id LIMIT 10',
)
def top_groups(spark, sf_dir):
    return aggregates.top_groups(_table(spark, sf_dir, "events"), "user_id", 10)


@query("distinct_values", "SELECT DISTINCT event_type, user_id FROM events")
def distinct_values(spark, sf_dir):
    return aggregates.distinct_values(_table(spark, sf_dir, "events"), ["event_type", "user_id"])


@query(
    "tables_per_owner",
    "SELECT p_brand AS owner, count(*) AS row_count, count(DISTINCT p_name) AS table_count FROM part GROUP BY p_brand",
)
def tables_per_owner(spark, sf_dir):
    names = rename_project(_table(spark, sf_dir, "part"), {"p_brand": "owner", "p_name": "table_name"})
    return aggregates.tables_per_owner(names)


@query(
    "page",
    """
    SELECT event_id, user_id, event_type FROM events ORDER BY user_id, event_id LIMIT 50 OFFSET 200
    """,
)
def page(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return read_page(events, ["user_id", "event_id"], 50, 200)


@query(
    "page_after_key",
    """
    SELECT event_id, user_id, event_type FROM events WHERE user_id > 3 OR (user_id = 3 AND event_id > 500)
    ORDER BY user_id, event_id LIMIT 50
    """,
)
def page_after_key(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return read_page(events, ["user_id", "event_id"], 50, after=[3, 500])


@query(
    "name_like",
    "SELECT p_partkey, upper(p_name) AS p_name FROM part WHERE upper(p_name) LIKE '%RING%'",
)
def name_like_query(spark, sf_dir):
    parts = _table(spark, sf_dir, "part").select("p_partkey", normalize_case("p_name").alias("p_name"))
    return name_like(parts, "%ring%", col="p_name")


@query(
    "name_in",
    "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('view', 'click')",
)
def name_in_query(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "event_type")
    return name_in(events, ["view", "click"], negate=True, col="event_type")


@query(
    "rename_project",
    "SELECT o_orderkey AS id, o_custkey AS nome, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS valor FROM orders",
)
def rename_project_query(spark, sf_dir):
    return rename_project(
        _orders(spark, sf_dir), {"o_orderkey": "id", "o_custkey": "nome", "o_totalprice": "valor"}
    )


@query(
    "declared_schema",
    """
    SELECT l_orderkey AS id, CAST(l_linenumber AS INTEGER) AS line, CAST(CAST(l_quantity AS DECIMAL(18,4)) AS DOUBLE) AS qty,
           l_extendedprice AS price, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped, l_returnflag = 'R' AS returned
    FROM lineitem
    """,
)
def declared_schema(spark, sf_dir):
    raw = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.col("l_linenumber").cast("string").alias("line"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_shipdate").alias("shipped"),
        F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("returned"),
    )
    definition = [
        {"name": "id", "type": "long"},
        {"name": "line", "type": "int"},
        {"name": "qty", "type": "decimal(18,4)", "nullable": True},
        {"name": "price", "type": "double"},
        {"name": "shipped", "type": "date"},
        {"name": "returned", "type": "boolean"},
    ]
    return cast_to(raw, build_schema(definition))


@query(
    "orders_per_month",
    """
    SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS year_month, count(*) AS orders
    FROM orders GROUP BY 1
    """,
)
def orders_per_month(spark, sf_dir):
    months = with_year_month(_orders(spark, sf_dir), "o_orderdate")
    return months.groupBy("year_month").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "snapshot_rows",
    f"WITH {ACTIVITY_SQL} SELECT primary_key, row_hash FROM history WHERE ref_date = DATE '2024-01-15'",
)
def snapshot_rows(spark, sf_dir):
    rows = for_snapshot(_history(spark, sf_dir), "2024-01-15", "user_activity")
    return rows.select("primary_key", "row_hash")


@query(
    "reconcile",
    f"""
    WITH {SNAPSHOTS_SQL},
    s AS (SELECT count(*) AS n, sum(o_totalprice) AS t FROM cur_rows),
    g AS (SELECT count(*) AS n, sum(o_totalprice) AS t FROM prev_rows)
    SELECT 'row_count' AS metric, CAST(s.n AS DOUBLE) AS source, CAST(g.n AS DOUBLE) AS target, s.n = g.n AS matched
    FROM s, g
    UNION ALL
    SELECT 'o_totalprice_sum', CAST(s.t AS DOUBLE), CAST(g.t AS DOUBLE), s.t = g.t FROM s, g
    """,
)
def reconcile(spark, sf_dir):
    return aggregates.reconcile(_cur_orders(spark, sf_dir), _prev_orders(spark, sf_dir), ["o_totalprice"])


# --- profiles and contracts ------------------------------------------------------------

EXACT = ["mean", "std", "min", "max"]


@query(
    "profile_orders",
    f"""
    WITH base AS ({ORDERS_SQL})
    SELECT count(*) AS row_count, CAST(sum(o_totalprice) AS DOUBLE) / count(o_totalprice) AS o_totalprice_mean,
           round(stddev_samp(CAST(o_totalprice AS DOUBLE)), 4) AS o_totalprice_std,
           CAST(min(o_totalprice) AS DOUBLE) AS o_totalprice_min, CAST(max(o_totalprice) AS DOUBLE) AS o_totalprice_max
    FROM base
    """,
)
def profile_orders(spark, sf_dir):
    stats = profile.column_statistics(_orders(spark, sf_dir), ["o_totalprice"], statistics=EXACT)
    return stats.withColumn("o_totalprice_std", F.round("o_totalprice_std", 4))


@query(
    "profile_orders_median",
    f"""
    WITH base AS ({ORDERS_SQL})
    SELECT count(*) AS row_count, CAST(quantile_disc(o_totalprice, 0.5) AS DOUBLE) AS o_totalprice_p50,
           quantile_disc(o_custkey, 0.5) AS o_custkey_p50 FROM base
    """,
)
def profile_orders_median(spark, sf_dir):
    """Exact medians by counting per value."""
    orders = _orders(spark, sf_dir)
    cols = ["o_totalprice", "o_custkey"]
    types = [T.StructField("row_count", T.LongType())] + [T.StructField(f"{c}_p50", orders.schema[c].dataType) for c in cols]
    return spark.createDataFrame([(row_count_of(orders), *(profile.exact_median(orders, c) for c in cols))], T.StructType(types))


LINE_STATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_STATS_SQL = " UNION ALL ".join(
    f"""
    SELECT '{c}' AS column_name, count(*) AS row_count,
           CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / count({c}) AS mean,
           round(stddev_samp({c}), 4) AS std,
           CAST(min(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) AS min, CAST(max(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) AS max
    FROM lineitem
    """
    for c in LINE_STATS
)


@query("profile_lineitem", LINE_STATS_SQL)
def profile_lineitem(spark, sf_dir):
    stats = profile.column_statistics_long(_lines(spark, sf_dir), LINE_STATS, statistics=EXACT)
    return stats.withColumn("std", F.round("std", 4))


@query(
    "contract_checks",
    """
    WITH c AS (
      SELECT count(*) AS n, count(DISTINCT l_orderkey || '|||' || l_linenumber) AS keys,
             (epoch(TIMESTAMP '2002-01-01') - epoch(max(l_shipdate))) / 3600.0 AS hours FROM lineitem)
    SELECT 'lineitem' AS table_name, 'row_count_min' AS "check", CAST(n AS DOUBLE) AS actual,
           5000::DOUBLE AS expected, n >= 5000 AS passed FROM c
    UNION ALL SELECT 'lineitem', 'freshness_hours', CAST(hours AS DOUBLE), 6, hours <= 6 FROM c
    UNION ALL SELECT 'lineitem', 'duplicates_max', CAST(n - keys AS DOUBLE), 0, n - keys <= 0 FROM c
    UNION ALL SELECT 'lineitem', 'quality_score_min',
      100.0::DOUBLE * (1.0::DOUBLE - CAST(n - keys AS DOUBLE) / n), 95,
      100.0::DOUBLE * (1.0::DOUBLE - CAST(n - keys AS DOUBLE) / n) >= 95 FROM c
    UNION ALL SELECT 'lineitem', 'schema:l_orderkey', 0, 0, true
    UNION ALL SELECT 'lineitem', 'schema:l_returnflag', CAST(n AS DOUBLE), 0, false FROM c
    UNION ALL SELECT 'lineitem', 'column:l_comment', 0, 1, false
    UNION ALL SELECT 'lineitem', 'schema:l_comment', CAST(n AS DOUBLE), 0, false FROM c
    """,
)
def contract_checks(spark, sf_dir):
    contract = quality.Contract(
        "lineitem",
        row_count_min=5000,
        freshness_hours=6,
        freshness_col="l_shipdate",
        key=("l_orderkey", "l_linenumber"),
        duplicates_max=0,
        quality_score_min=95,
        schema={"l_orderkey": "integer", "l_returnflag": "integer", "l_comment": "string"},
    )
    return quality.run_contract(_table(spark, sf_dir, "lineitem"), contract, "2002-01-01 00:00:00")


@query(
    "validate_schema",
    """
    SELECT 'p_partkey' AS column_name, 'int' AS expected_type, 'bigint' AS actual_type, true AS present,
           false AS type_matches, 0 AS invalid_count
    UNION ALL SELECT 'p_name', 'string', 'string', true, true, 0
    UNION ALL SELECT 'p_brand', 'int', 'string', true, false,
      (SELECT count(*) FROM part WHERE p_brand IS NOT NULL AND TRY_CAST(p_brand AS INTEGER) IS NULL)
    UNION ALL SELECT 'p_type', 'timestamp', 'string', true, false,
      (SELECT count(*) FROM part WHERE p_type IS NOT NULL AND TRY_CAST(p_type AS TIMESTAMP) IS NULL)
    """,
)
def validate_schema(spark, sf_dir):
    expected = {"p_partkey": "integer", "p_name": "string", "p_brand": "integer", "p_type": "timestamp"}
    return quality.validate_schema(_table(spark, sf_dir, "part"), expected)


@query(
    "retained_rows",
    f"""
    WITH base AS ({ORDERS_SQL})
    SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM base
    WHERE o_orderdate >= DATE '2001-08-01' - 365
    """,
)
def retained_rows(spark, sf_dir):
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return quality.retained(rows, "o_orderdate", "2001-08-01", quality.LAYER_RETENTION_DAYS["silver"])


@query(
    "expired_partitions",
    f"""
    WITH base AS ({ORDERS_SQL})
    SELECT CAST(o_orderdate AS VARCHAR) AS o_orderdate, count(*) AS row_count FROM base
    WHERE o_orderdate < DATE '2001-08-01' - 90 GROUP BY o_orderdate
    """,
)
def expired_partitions(spark, sf_dir):
    days = quality.LAYER_RETENTION_DAYS["bronze"]
    return quality.expired_partitions(_orders(spark, sf_dir), "o_orderdate", "2001-08-01", days)


# --- silver ------------------------------------------------------------------------------


@query(
    "clean_dedupe_customers",
    """
    WITH messy AS (
      SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer
      UNION ALL SELECT c_custkey, '  ' || lower(c_name) || ' ', lower(c_mktsegment), c_acctbal + 1 FROM customer),
    cleaned AS (SELECT c_custkey, upper(trim(c_name)) AS c_name, upper(trim(c_mktsegment)) AS c_mktsegment, c_acctbal
                FROM messy)
    SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM (
      SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY c_acctbal DESC) AS rn FROM cleaned)
    WHERE rn = 1
    """,
)
def clean_dedupe_customers(spark, sf_dir):
    base = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    messy = base.select(
        "c_custkey",
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("c_name"),
        F.lower("c_mktsegment").alias("c_mktsegment"),
        (F.col("c_acctbal") + 1).alias("c_acctbal"),
    )
    steps = [
        {"type": "clean_strings", "columns": ["c_name", "c_mktsegment"], "trim_spaces": True, "upper_case": True},
        {"type": "deduplicate", "subset": ["c_custkey"]},
    ]
    return silver_transform(base.unionByName(messy), steps, order_by=["c_acctbal"])[0]


@query(
    "clean_strings",
    "SELECT p_partkey, upper(trim(p_name || '  ')) AS p_name, upper(trim(' ' || p_brand)) AS p_brand FROM part",
)
def clean_strings_query(spark, sf_dir):
    parts = _table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat("p_name", F.lit("  ")).alias("p_name"),
        F.concat(F.lit(" "), "p_brand").alias("p_brand"),
    )
    return clean_strings(parts, ["p_name", "p_brand"], upper=True)


@query(
    "silver_dedupe_hash",
    f"""
    WITH {SNAPSHOTS_SQL},
    both_days AS (SELECT '{PREV_DAY}' AS d, * FROM prev_rows UNION ALL SELECT '{REF_DAY}', * FROM cur_rows)
    SELECT min(d) AS reference_date, o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
    FROM both_days GROUP BY ALL
    """.replace("GROUP BY ALL", "GROUP BY o_orderkey, o_custkey, o_orderstatus, both_days.o_totalprice, "
                "both_days.o_orderdate, o_orderpriority"),
)
def silver_dedupe_hash(spark, sf_dir):
    days = [
        with_ingestion_metadata(rows, "files", "sales.orders", day)
        for rows, day in ((_prev_orders(spark, sf_dir), PREV_DAY), (_cur_orders(spark, sf_dir), REF_DAY))
    ]
    rows = silver_dedupe(days[0].unionByName(days[1]), scope="all")
    return rows.drop("row_hash", "_ingestion_timestamp", "_source", "_source_table")


EVENT_SQL = """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value FROM events
"""


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _exact_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("silver_dedupe_events", EVENT_SQL)
def silver_dedupe_events(spark, sf_dir):
    """Every event twice on one day; the hash tells those apart that differ by a microsecond."""
    events = with_ingestion_metadata(_event_rows(spark, sf_dir), "files", "events", REF_DAY)
    rows = silver_dedupe(events.unionByName(events), scope="day")
    return _exact_time(rows.select("event_id", "ts", "user_id", "event_type", "value"))


@query("typed_events_from_payload", EVENT_SQL)
def typed_events_from_payload(spark, sf_dir):
    """All events through their JSON payloads and back, times to the microsecond."""
    events = _event_rows(spark, sf_dir)
    schema = ", ".join(f"{name} {kind}" for name, kind in events.dtypes)
    rows = typed_silver(to_envelope(events, "events", ["event_id"], REF_DAY), REF_DAY, "events", schema, ["event_id"])
    return _exact_time(rows.select("event_id", "ts", "user_id", "event_type", "value"))


@query(
    "distinct_by_hash",
    "SELECT l_returnflag, l_linestatus, count(*) AS rows FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem) "
    "GROUP BY l_returnflag, l_linestatus",
)
def distinct_by_hash(spark, sf_dir):
    rows = add_row_hash(_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus"))
    kept = aggregates.drop_duplicates_by_hash(rows)
    return kept.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "sample_count",
    "SELECT count(*) AS row_count, count(DISTINCT o_orderkey) AS orders, count(*) AS known FROM (SELECT * FROM orders LIMIT 25)",
)
def sample_count(spark, sf_dir):
    """The sample's rows are 25 different ones of the table."""
    orders = _orders(spark, sf_dir)
    sample = stage(aggregates.sample_rows(orders, 25)).withColumn("sampled", F.lit(1))
    known = sample.join(orders, orders.columns, "left_semi")
    return known.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("o_orderkey").alias("orders"), F.sum("sampled").alias("known")
    )


@query("sorted_names", "SELECT c_name FROM customer")
def sorted_names(spark, sf_dir):
    return aggregates.sorted_names(_table(spark, sf_dir, "customer").select("c_name"), "c_name")


@query(
    "typed_from_payload",
    f"""
    WITH {SNAPSHOTS_SQL}
    SELECT '{REF_DAY}' AS ref_date, o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
    FROM cur_rows
    """,
)
def typed_from_payload(spark, sf_dir):
    cur, prev = _snapshots(spark, sf_dir)
    schema = (
        "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DECIMAL(18,2), o_orderdate DATE, o_orderpriority STRING"
    )
    rows = typed_silver(cur.unionByName(prev), REF_DAY, "orders", schema, ["o_orderkey"], ["o_orderstatus"])
    return rows.drop("table_name", "row_hash", "ingestion_timestamp")


@query(
    "parse_event_props",
    """
    SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
    """,
)
def parse_event_props(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return parse_payload(events, "k BIGINT", data_col="props")


# --- catalog, lineage, ledger ----------------------------------------------------------------


@query(
    "coverage_missing",
    """
    WITH s AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem WHERE l_linestatus = 'O'),
    t AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem WHERE l_linestatus <> 'O')
    SELECT coalesce(s.k, t.k) AS table_name, CASE WHEN t.k IS NULL THEN 'missing' ELSE 'extra' END AS status
    FROM s FULL JOIN t ON s.k = t.k WHERE s.k IS NULL OR t.k IS NULL
    """,
)
def coverage_missing(spark, sf_dir):
    names = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("table_name"), (F.col("l_linestatus") == "O").alias("open")
    )
    return catalog.coverage(names.filter("open"), names.filter("NOT open"))


@query(
    "missing_orders",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def missing_orders(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey")
    return catalog.missing(orders, _table(spark, sf_dir, "lineitem").select("l_orderkey"))


TABLES = ["customer", "events", "lineitem", "orders", "part", "supplier"]


@query(
    "table_stats",
    " UNION ALL ".join(f"SELECT 'TPC' AS owner, '{t}' AS table_name, count(*) AS num_rows FROM {t}" for t in TABLES),
)
def table_stats(spark, sf_dir):
    return catalog.table_counts({t: _table(spark, sf_dir, t) for t in TABLES}, "TPC").drop("last_analyzed")


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which monthly order partition feeds which day, and which day feeds which year."""
    days = _orders(spark, sf_dir).select("o_orderdate").distinct()

    def edge(source: str, target: str, kind: str) -> DataFrame:
        return days.select(
            F.concat(F.lit("orders_" if kind == "aggregate" else "daily_sales_"), F.date_format("o_orderdate", source))
            .alias("source_table"),
            F.concat(F.lit("daily_sales_" if kind == "aggregate" else "ltv_"), F.date_format("o_orderdate", target))
            .alias("target_table"),
            F.lit(kind).alias("transformation_type"),
            F.lit("gold").alias("pipeline_name"),
            F.col("o_orderdate").cast("timestamp").alias("execution_timestamp"),
        )

    return catalog.register_lineage(edge("yyyyMM", "yyyyMMdd", "aggregate"), edge("yyyyMMdd", "yyyy", "rollup"))


LINEAGE_SQL = """
  WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
  edges AS (
    SELECT 'orders_' || strftime(d, '%Y%m') AS source_table, 'daily_sales_' || strftime(d, '%Y%m%d') AS target_table,
           'aggregate' AS transformation_type FROM days
    UNION ALL
    SELECT 'daily_sales_' || strftime(d, '%Y%m%d'), 'ltv_' || strftime(d, '%Y'), 'rollup' FROM days)
  SELECT * FROM edges WHERE source_table = '{0}' OR target_table = '{0}'
"""


@query("lineage_lookup", LINEAGE_SQL.format("daily_sales_19970214"))
def lineage_lookup(spark, sf_dir):
    found = catalog.lineage_of(_edges(spark, sf_dir), "daily_sales_19970214")
    return found.select("source_table", "target_table", "transformation_type")


@query("lineage_of_year", LINEAGE_SQL.format("ltv_1998"))
def lineage_of_year(spark, sf_dir):
    found = catalog.lineage_of(_edges(spark, sf_dir), "ltv_1998")
    return found.select("source_table", "target_table", "transformation_type")


def _metadata_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a table whose record changes with each of its orders."""
    records = _orders(spark, sf_dir).select(
        F.lit("sales").alias("domain"),
        F.lit("bronze").alias("layer"),
        F.col("o_custkey").cast("string").alias("name"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.col("o_orderkey").alias("row_count"),
        F.lit(False).alias("pii"),
        F.lit(365).alias("retention_days"),
    )
    return align(records, TABLE_METADATA)


@query(
    "metadata_upsert",
    f"""
    WITH base AS ({ORDERS_SQL}),
    old AS (SELECT o_custkey, min(o_orderdate) AS first FROM base GROUP BY 1),
    names AS (SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM old)
    SELECT CAST(k AS VARCHAR) AS name, coalesce(c_mktsegment, '') AS owner,
           CAST(coalesce(first, DATE '2024-01-01') AS VARCHAR) AS created,
           CASE WHEN c_custkey IS NULL THEN 'orders' ELSE 'crm' END AS source
    FROM names LEFT JOIN old ON k = o_custkey LEFT JOIN customer ON k = c_custkey
    """,
)
def metadata_upsert(spark, sf_dir):
    old = _metadata_history(spark, sf_dir).withColumn("source_system", F.lit("orders"))
    records = align(
        _table(spark, sf_dir, "customer").select(
            F.lit("sales").alias("domain"),
            F.lit("bronze").alias("layer"),
            F.col("c_custkey").cast("string").alias("name"),
            F.lit("crm").alias("source_system"),
            F.col("c_mktsegment").alias("owner"),
        ),
        TABLE_METADATA,
    )
    merged = catalog.register_table(old, records, F.lit("2024-01-01").cast("timestamp"))
    return merged.select(
        "name",
        F.coalesce("owner", F.lit("")).alias("owner"),
        F.col("created_at").cast("date").alias("created"),
        F.col("source_system").alias("source"),
    )


@query(
    "catalog_as_of",
    f"""
    WITH base AS ({ORDERS_SQL}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
               FROM base WHERE o_orderdate <= DATE '1998-06-30')
    SELECT CAST(o_custkey AS VARCHAR) AS name, o_orderkey AS row_count, CAST(o_orderdate AS VARCHAR) AS updated,
           '1998-06-30' AS generated_for
    FROM ranked WHERE rn = 1
    """,
)
def catalog_as_of(spark, sf_dir):
    found = catalog.generate_catalog(_metadata_history(spark, sf_dir), "1998-06-30")
    return found.select("name", "row_count", F.col("updated_at").cast("date").alias("updated"), "generated_for")


@query(
    "pending_loads",
    f"""
    WITH base AS ({ORDERS_SQL}),
    last AS (SELECT o_orderdate, o_orderpriority,
               max(CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'STARTED' ELSE 'FAILED' END) AS status
             FROM base GROUP BY 1, 2)
    SELECT CAST(o_orderdate AS VARCHAR) AS ref_date, 'sales' AS schema_name, o_orderpriority AS table_name
    FROM last WHERE status <> 'SUCCESS'
    """,
)
def pending_loads(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    statuses = F.create_map(*[F.lit(x) for x in ("F", "SUCCESS", "P", "STARTED", "O", "FAILED")])
    rows = orders.select(
        F.col("o_orderdate").alias("ref_date"),
        F.lit("sales").alias("schema_name"),
        F.col("o_orderpriority").alias("table_name"),
        F.col("o_orderdate").cast("timestamp").alias("ingestion_start"),
        statuses[F.col("o_orderstatus")].alias("status"),
    )
    return ledger.pending_loads(align(rows, INGESTION_CONTROL), rows)


@query(
    "run_report",
    """
    WITH runs AS (
      SELECT CAST(ts AS DATE) AS d, user_id, min(ts) AS start_time, max(ts) AS end_time, count(*) AS n,
             count(*) FILTER (event_type = 'error') AS bad,
             CASE WHEN user_id < 50 THEN 'bronze' WHEN user_id < 100 THEN 'silver' ELSE 'gold' END AS layer
      FROM events GROUP BY 1, 2)
    SELECT 'events' AS domain, layer, count(*) AS runs, count(*) FILTER (bad > 0) AS failed_runs,
           CAST(sum(n) AS BIGINT) AS rows_processed, CAST(sum(bad) AS BIGINT) AS rows_failed,
           max(epoch_us(end_time) - epoch_us(start_time)) // 1000000 AS max_seconds,
           max(epoch_us(end_time) - epoch_us(start_time)) / 1e6
             <= 3600 * CASE layer WHEN 'gold' THEN 1 ELSE 2 END AS within_sla
    FROM runs GROUP BY layer
    """,
)
def run_report(spark, sf_dir):
    errors = T.StructType.fromDDL(RUN_METRICS)["errors"].dataType
    layer = F.when(F.col("user_id") < 50, "bronze").when(F.col("user_id") < 100, "silver").otherwise("gold")
    runs = (
        _table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("day"), "user_id")
        .agg(
            F.min("ts").alias("start_time"),
            F.max("ts").alias("end_time"),
            F.count(F.lit(1)).alias("rows_processed"),
            F.count_if(F.col("event_type") == "error").alias("rows_failed"),
        )
        .withColumns(
            {
                "domain": F.lit("events"),
                "layer": layer,
                "status": F.when(F.col("rows_failed") > 0, "error").otherwise("success"),
                "errors": F.lit(None).cast(errors),
            }
        )
    )
    report = ledger.run_report(ledger.with_duration(runs), {"bronze": 2, "silver": 2, "gold": 1})
    return report.select(
        "domain",
        "layer",
        "runs",
        "failed_runs",
        "rows_processed",
        "rows_failed",
        F.floor("max_duration_seconds").alias("max_seconds"),
        "within_sla",
    )


@query(
    "ddl_text",
    """
    WITH cols AS (
      SELECT DISTINCT p_type AS table_name, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS column_id, p_brand
      FROM part),
    typed AS (
      SELECT table_name, column_id, lower(replace(replace(p_brand, 'Brand#', 'Preço-Médio '), ' ', '_')) AS n,
             CASE WHEN column_id < 6 THEN 'Decimal64(2)' WHEN column_id < 11 THEN 'DateTime'
                  WHEN column_id < 16 THEN 'DateTime64(3)' ELSE 'String' END AS t
      FROM cols)
    SELECT 'PARTS' AS owner, table_name, 'parts_' || lower(table_name) AS target_table,
      'CREATE TABLE IF NOT EXISTS bronze.parts_' || lower(table_name) || chr(10) || '(' || chr(10) ||
      string_agg('    ' || replace(replace(replace(n, 'ç', 'c'), 'é', 'e'), '-', '_') || ' ' || t, ',' || chr(10)
                 ORDER BY column_id) ||
      ',' || chr(10) || '    _ingestion_timestamp DateTime DEFAULT now(),' || chr(10) ||
      '    reference_date Date,' || chr(10) || '    _source String,' || chr(10) ||
      '    _source_table String,' || chr(10) || '    row_hash String' || chr(10) || ')' || chr(10) ||
      'ENGINE = MergeTree()' || chr(10) || 'PARTITION BY toYYYYMM(reference_date)' || chr(10) ||
      'ORDER BY (reference_date, row_hash)' || chr(10) || 'SETTINGS index_granularity = 8192;' || chr(10) AS ddl
    FROM typed GROUP BY table_name
    """,
)
def ddl_text(spark, sf_dir):
    number = F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int")
    kind = (
        F.when(F.col("column_id") < 6, "NUMBER")
        .when(F.col("column_id") < 11, "DATE")
        .when(F.col("column_id") < 16, "TIMESTAMP")
        .when(F.col("column_id") < 21, "VARCHAR2")
        .otherwise("RAW")
    )
    columns = (
        _table(spark, sf_dir, "part")
        .select(
            F.lit("PARTS").alias("owner"),
            F.col("p_type").alias("table_name"),
            number.alias("column_id"),
            F.replace("p_brand", F.lit("Brand#"), F.lit("Preço-Médio ")).alias("column_name"),
        )
        .distinct()
        .withColumn("data_type", kind)
    )
    return catalog_to_ddl(columns)


# --- deep pages, sketches, compacted metrics -----------------------------------------------------


@query(
    "page_deep",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 40 OFFSET (SELECT 9 * count(*) // 10 FROM lineitem)
    """,
)
def page_deep(spark, sf_dir):
    """A page nine tenths into the line items."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = _table(spark, sf_dir, "lineitem").select(*keys)
    return read_deep_page(lines, keys, 40, 9 * row_count_of(lines) // 10, ranges=16, most=2000)


@query(
    "sketched_activity",
    """
    SELECT event_type, count(*) AS row_count, true AS users_close, true AS middle_close, true AS top_close
    FROM events GROUP BY event_type
    """,
)
def sketched_activity(spark, sf_dir):
    """Sketches of every day, merged over all days, beside exact figures: users within five standard
    errors, quantiles within three rank errors."""
    events = _table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    daily = stage(sketches.daily_sketches(events, ["day", "event_type"], ["user_id"], ["value"]))
    merged = sketches.read_sketches(sketches.merge_sketches(daily, ["event_type"]), [0.5, 0.95])
    known = events.join(merged, "event_type")
    exact = known.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("user_id").alias("users"),
        F.first("user_id_distinct").alias("estimate"),
        F.avg((F.col("value") < F.col("value_p50")).cast("int")).alias("below"),
        F.avg((F.col("value") <= F.col("value_p50")).cast("int")).alias("upto"),
        F.avg((F.col("value") < F.col("value_p95")).cast("int")).alias("below_top"),
        F.avg((F.col("value") <= F.col("value_p95")).cast("int")).alias("upto_top"),
    )
    near = lambda below, upto, q: (F.col(below) - 0.04 <= q) & (F.col(upto) + 0.04 >= q)
    return exact.select(
        "event_type",
        "row_count",
        (F.abs(F.col("estimate") - F.col("users")) <= 1 + 0.08 * F.col("users")).alias("users_close"),
        near("below", "upto", 0.5).alias("middle_close"),
        near("below_top", "upto_top", 0.95).alias("top_close"),
    )


@query(
    "compacted_metrics",
    f"""
    WITH {CHANGES_SQL}, {COUNTS_SQL}
    SELECT CAST(ref_date AS VARCHAR) AS ref_date, table_name, total_inserts, total_updates, total_deletes FROM counts
    """,
)
def compacted_metrics(spark, sf_dir):
    """Two runs append the days' counts, each is repeated, before and after they are compacted: every count once."""
    counts = stage(metrics.change_counts(delta.detect_delta_range(_history(spark, sf_dir))))
    keys, sums = ["ref_date", "table_name"], ["total_inserts", "total_updates", "total_deletes"]
    schema = ", ".join(f"{n} {t}" for n, t in counts.dtypes)
    path = new_path(spark, "change-counts")
    early = F.dayofmonth("ref_date") <= 15
    for _ in range(2):
        for _ in range(2):
            append_run(counts.filter(early), path, "month=202401", "first")
            append_run(counts.filter(~early), path, "month=202401", "second")
        compact_partition(spark, path, "month=202401", schema, lambda df: state.collapse_sum(df, keys, sums))
    return read_runs_of(spark, path, "month=202401", schema)


# --- one table, several ways in and out ------------------------------------------------------------

STATUS_SQL = "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus"


def _by_status(df: DataFrame) -> DataFrame:
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query("catalog_table", STATUS_SQL)
def catalog_table(spark, sf_dir):
    _orders(spark, sf_dir).createOrReplaceTempView("orders_of_catalog")
    return _by_status(read_catalog_table(spark, "orders_of_catalog"))


@query("staging_table", STATUS_SQL)
def staging_table(spark, sf_dir):
    path = new_path(spark, "staging")
    write_staging(_prev_orders(spark, sf_dir), path)
    return _by_status(spark.read.parquet(write_staging(_orders(spark, sf_dir), path)))


@query("first_available", STATUS_SQL)
def first_available_query(spark, sf_dir):
    """A missing file and an empty table are passed over."""
    orders = _orders(spark, sf_dir)
    candidates = [
        lambda: spark.read.parquet(f"{sf_dir}/no-such-table.parquet"),
        lambda: orders.filter("o_orderkey < 0"),
        lambda: orders,
    ]
    return _by_status(first_available(candidates))


@query(
    "append_aligned",
    """
    SELECT c_mktsegment AS segment, count(*) AS rows, count(c_acctbal) AS balances FROM (
      SELECT c_mktsegment, c_acctbal FROM customer UNION ALL SELECT c_mktsegment, NULL FROM customer)
    GROUP BY c_mktsegment
    """,
)
def append_aligned_query(spark, sf_dir):
    """Rows in another order, and rows without a column, appended to one table."""
    customers = _table(spark, sf_dir, "customer").select("c_acctbal", F.col("c_mktsegment").alias("segment"))
    schema, path = "segment STRING, c_acctbal DOUBLE", new_path(spark, "aligned")
    for rows in (customers, customers.drop("c_acctbal").withColumn("unknown", F.lit(1))):
        append_aligned(rows, schema, path)
    return spark.read.parquet(path).groupBy("segment").agg(
        F.count(F.lit(1)).alias("rows"), F.count("c_acctbal").alias("balances")
    )


@query(
    "scan_catalog",
    """
    SELECT 'tpc.customer' AS name, 'MAPPED' AS status, count(*) AS rows FROM customer
    UNION ALL SELECT 'tpc.supplier', 'SKIPPED', 0 UNION ALL SELECT 'tpc.nowhere', 'FAILED', 0
    """,
)
def scan_catalog_query(spark, sf_dir):
    """One table has the columns, one lacks them, one cannot be read."""
    names = [("tpc", n) for n in ("customer", "supplier", "nowhere")]
    found = scan_catalog(
        lambda owner, name: _table(spark, sf_dir, name), names, ["c_custkey", "c_name"], {"c_custkey": "id", "c_name": "name"}
    )
    parts = []
    for t in found:
        rows = t.df if t.df is not None else _table(spark, sf_dir, "customer").limit(0).select(F.col("c_custkey").alias("id"))
        label = F.lit(f"{t.owner}.{t.table_name}").alias("name")
        parts.append(rows.agg(label, F.lit(t.status).alias("status"), F.count("id").alias("rows")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("list_columns", "SELECT column_name, CAST(row_number() OVER () AS INTEGER) AS column_id FROM (DESCRIBE orders)")
def list_columns_query(spark, sf_dir):
    return catalog.list_columns(_table(spark, sf_dir, "orders")).select("column_name", "column_id")


@query(
    "numeric_totals",
    """
    SELECT CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS l_quantity, CAST(sum(l_orderkey) AS BIGINT) AS l_orderkey,
           CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber FROM lineitem
    """,
)
def numeric_totals(spark, sf_dir):
    """Totals of the numeric columns a table turns out to have."""
    lines = _lines(spark, sf_dir).select("l_orderkey", "l_returnflag", "l_shipdate", "l_quantity", "l_linenumber")
    if not has_columns(lines, ["L_ORDERKEY", "l_shipdate"]) or has_columns(lines, ["l_comment"]):
        raise ValueError("line items have other columns than expected")
    return lines.agg(*[F.sum(c).alias(c) for c in numeric_columns(lines)])


@query("explore_table", "SELECT count(*) AS row_count, (SELECT count(*) FROM (DESCRIBE part)) AS columns FROM part")
def explore_table(spark, sf_dir):
    parts = profile.explore_table(_table(spark, sf_dir, "part"))
    columns = row_count_of(parts["columns"])
    return parts["row_count"].withColumn("columns", F.lit(columns).cast("bigint"))


@query(
    "valid_operations",
    """
    SELECT event_type, event_type IN ('signup', 'error') AS valid, count(*) AS events FROM events GROUP BY event_type
    """,
)
def valid_operations(spark, sf_dir):
    """Event types as operations: a signup inserts, an error deletes, others are none."""
    kinds = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise(F.col("event_type"))
    events = _table(spark, sf_dir, "events").withColumn("valid", valid_operation(kinds))
    return events.groupBy("event_type", "valid").agg(F.count(F.lit(1)).alias("events"))


@query(
    "schema_ddl",
    """
    SELECT 'stage.orders' AS target, 'CREATE TABLE IF NOT EXISTS stage.orders (' || string_agg(column_name || ' ' ||
             CASE column_type WHEN 'BIGINT' THEN 'Int64' WHEN 'DOUBLE' THEN 'Float64' ELSE 'String' END, ', ') ||
           ', snapshot_date Date, record_hash FixedString(64)) ENGINE = MergeTree PARTITION BY snapshot_date ' ||
           'ORDER BY (o_orderkey) SETTINGS index_granularity = 8192' AS ddl
    FROM (DESCRIBE SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders)
    """,
)
def schema_ddl(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").drop("o_orderdate")
    ddl = schema_to_ddl(orders.schema, "stage.orders", ["o_orderkey"])
    return spark.createDataFrame([("stage.orders", ddl)], "target STRING, ddl STRING")


@query(
    "ddl_for_missing",
    """
    SELECT 'PARTS' AS owner, p_type AS table_name FROM part GROUP BY p_type
    HAVING p_type NOT IN (SELECT p_type FROM part WHERE p_size < 5)
    """,
)
def ddl_for_missing_query(spark, sf_dir):
    """Types that have no small part count as tables not created yet."""
    parts = _table(spark, sf_dir, "part")
    columns = parts.select(
        F.lit("PARTS").alias("owner"),
        F.col("p_type").alias("table_name"),
        F.lit(1).alias("column_id"),
        F.lit("p_name").alias("column_name"),
        F.lit("VARCHAR2").alias("data_type"),
    ).distinct()
    existing = parts.filter("p_size < 5").select(F.col("p_type").alias("table_name")).distinct()
    return ddl_for_missing(columns, existing).filter(F.col("ddl").contains("p_name String")).select("owner", "table_name")


# --- layers and whole runs -----------------------------------------------------------------------


@query(
    "layer_rerun",
    f"""
    WITH {SNAPSHOTS_SQL}
    SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS year_month, count(*) AS orders,
           CAST(sum(o_totalprice) AS DOUBLE) AS amount
    FROM cur_rows GROUP BY 1
    """,
)
def layer_rerun(spark, sf_dir):
    """Monthly partitions written twice hold the rows once."""
    target = new_path(spark, "orders-by-month")
    for _ in range(2):
        overwrite_partitions(with_year_month(_cur_orders(spark, sf_dir), "o_orderdate"), target, ["year_month"])
    return (
        spark.read.parquet(target)
        .groupBy("year_month")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("amount"))
    )


@query(
    "layer_day",
    f"""
    WITH {SNAPSHOTS_SQL}
    SELECT '{REF_DAY}' AS reference_date, 'files' AS _source, 'sales.orders' AS _source_table, o_orderkey, o_orderstatus
    FROM cur_rows
    """,
)
def layer_day(spark, sf_dir):
    """Both days in one bronze layer, one of them read back."""
    base = new_path(spark, "lake")
    for rows, day in ((_prev_orders(spark, sf_dir), PREV_DAY), (_cur_orders(spark, sf_dir), REF_DAY)):
        stamped = with_ingestion_metadata(rows, "files", "sales.orders", day)
        write_layer(stamped, base, "bronze", "files", "orders", ["reference_date"])
    found = read_layer(spark, base, "bronze", "files", "orders", REF_DAY)
    return found.select("reference_date", "_source", "_source_table", "o_orderkey", "o_orderstatus")


@query(
    "clustered_lines",
    """
    SELECT l_returnflag, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
           min(l_suppkey) AS first_supplier, max(l_suppkey) AS last_supplier, false AS overlapping
    FROM lineitem GROUP BY l_returnflag
    """,
)
def clustered_lines(spark, sf_dir):
    """Files of a flag hold ranges of suppliers that touch at most in one supplier."""
    rows = clustered(_lines(spark, sf_dir), ["l_returnflag"], ["l_suppkey", "l_orderkey"])
    stored = stage(rows)
    files = stored.groupBy("l_returnflag", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("l_quantity").alias("quantity"),
        F.min("l_suppkey").alias("low"),
        F.max("l_suppkey").alias("high"),
    )
    earlier = Window.partitionBy("l_returnflag").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("overlapping", F.coalesce(F.col("low") < F.max("high").over(earlier), F.lit(False)))
    return files.groupBy("l_returnflag").agg(
        F.sum("lines").alias("lines"),
        F.sum("quantity").alias("quantity"),
        F.min("low").alias("first_supplier"),
        F.max("high").alias("last_supplier"),
        F.max("overlapping").alias("overlapping"),
    )


def _lake(spark: SparkSession, sf_dir: str) -> str:
    """The lake job from a config over orders and line items; returns its folder."""
    base = new_path(spark, "lake")
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
    )
    tables = {"orders": orders, "lineitem": _lines(spark, sf_dir)}

    def declared(name: str, key: str) -> dict:
        return {
            "name": name,
            "source": {"type": "files", "schema": "sales", "table": name},
            "ingestion": {"mode": "snapshot_full", "reference_date": "D-1"},
            "primary_keys": [key],
            "quality": {"row_count_min": 10, "freshness_hours": 24},
            "metadata": {"domain": "sales", "owner": "data"},
        }

    sales = {"group_by": ["order_date"], "metrics": metrics.DAILY_SALES_METRICS}
    config = {
        "bronze_tables": [declared("orders", "order_id"), declared("lineitem", "l_orderkey")],
        "silver_transformations": {"orders": {"transformations": [{"type": "deduplicate", "subset": ["order_id"]}]}},
        "gold_metrics": {
            "daily_sales_summary": {"source": "silver.sales.orders", "aggregations": sales},
            "customer_ltv": {"source": "silver.sales.orders", "type": "customer_ltv"},
            "lines": {"source": "silver.sales.lineitem", "aggregations": {"group_by": ["l_returnflag"], "metrics": {}}},
        },
    }
    run_lake(spark, lambda s: tables[s.table], config, base, REF_DAY)
    return base


@query("lake_run_sales", SALES_SQL)
def lake_run_sales(spark, sf_dir):
    """Written gold of the lake job."""
    path = gold_path(_lake(spark, sf_dir), "daily_sales_summary")
    return spark.read.parquet(path).drop("ref_date")


@query("lake_run_ltv", LTV_SQL)
def lake_run_ltv(spark, sf_dir):
    return spark.read.parquet(gold_path(_lake(spark, sf_dir), "customer_ltv")).drop("ref_date")


@query(
    "lake_run_contracts",
    """
    SELECT 'orders' AS table_name, 'row_count_min' AS "check", CAST(count(*) AS DOUBLE) AS actual, 10.0::DOUBLE AS expected,
           true AS passed FROM orders
    UNION ALL SELECT 'orders', 'duplicates_max', 0, 0, true
    UNION ALL SELECT 'lineitem', 'row_count_min', count(*), 10, true FROM lineitem
    UNION ALL SELECT 'lineitem', 'duplicates_max', count(*) - count(DISTINCT l_orderkey), 0, false FROM lineitem
    """,
)
def lake_run_contracts(spark, sf_dir):
    """Line items have many rows per order, so that table fails and stays out of silver."""
    rows = read_contract_results(spark, _lake(spark, sf_dir), PREV_DAY)
    return rows.filter("check <> 'freshness_hours'").select("table_name", "check", "actual", "expected", "passed")


@query(
    "ingest_two_schemas",
    """
    SELECT 'sales' AS schema_name, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
    UNION ALL SELECT 'logistics', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM lineitem
    """,
)
def ingest_two_schemas(spark, sf_dir):
    """Two tables of one name in two schemas: each keeps its own rows."""
    base = new_path(spark, "two-schemas")
    tables = {"sales": _orders(spark, sf_dir), "logistics": _lines(spark, sf_dir)}
    specs = [TableSpec(s, "movements", s, "files", ("o_orderkey",)) for s in tables]
    ingest_tables(spark, lambda s: tables[s.schema], specs, base, REF_DAY, ingest_table)

    def totals(spec: TableSpec, key: str) -> DataFrame:
        rows = read_layer(spark, base, "bronze", "files", spec.entity, REF_DAY)
        return rows.agg(F.lit(spec.schema).alias("schema_name"), F.count(F.lit(1)).alias("rows"), F.sum(key).alias("keys"))

    return totals(specs[0], "o_orderkey").unionByName(totals(specs[1], "l_orderkey"))


@query(
    "load_envelope",
    f"""
    WITH base AS ({ORDERS_SQL})
    SELECT 'sales.orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS primary_key, o_orderstatus FROM base
    """,
)
def load_envelopes(spark, sf_dir):
    """Envelopes from the stored typed layer."""
    base = new_path(spark, "load-envelope")
    spec = TableSpec("orders", "orders", "sales", "files", ("o_orderkey",))
    ingest_table(lambda _: _orders(spark, sf_dir), spec, base, REF_DAY)
    load_envelope(spark, spec, base, REF_DAY)
    rows = spark.read.option("basePath", snapshot_path(base)).parquet(snapshot_path(base))
    return parse_payload(rows.select("table_name", "primary_key", "data"), "o_orderstatus STRING")


def _two_days(spark: SparkSession, sf_dir: str) -> str:
    """The whole job over orders and customers for two days; returns its folder."""
    base = new_path(spark, "daily-run")
    specs = [
        TableSpec("orders", "orders", source_type="files", primary_keys=("o_orderkey",)),
        TableSpec("customer", "customer", source_type="files", primary_keys=("c_custkey",)),
    ]
    for day, orders in ((PREV_DAY, _prev_orders(spark, sf_dir)), (REF_DAY, _cur_orders(spark, sf_dir))):
        tables = {"orders": orders, "customer": _table(spark, sf_dir, "customer")}
        run_day(spark, lambda s, t=tables: t[s.table], specs, base, day)
    return base


@query(
    "daily_run_changes",
    f"""
    WITH {EVENTS_SQL}
    SELECT '{PREV_DAY}' AS ref_date, 'customer' AS table_name, count(*) AS total_inserts, 0::BIGINT AS total_updates,
           0::BIGINT AS total_deletes, count(*) AS total_active_records FROM customer
    UNION ALL SELECT '{PREV_DAY}', 'orders', count(*), 0, 0, count(*) FROM prev
    UNION ALL SELECT ref_date, table_name, count(*) FILTER (operation_type = 'INSERT'),
      count(*) FILTER (operation_type = 'UPDATE'), count(*) FILTER (operation_type = 'DELETE'),
      (SELECT count(*) FROM cur) FROM delta GROUP BY ref_date, table_name
    """,
)
def daily_run_changes(spark, sf_dir):
    return read_change_metrics(spark, _two_days(spark, sf_dir)).drop("calculated_at")


@query(
    "daily_run_quality",
    f"""
    WITH {SNAPSHOTS_SQL}
    SELECT '{REF_DAY}' AS ref_date, 'customer' AS table_name, 0::BIGINT AS null_count, 0::BIGINT AS duplicate_count,
           count(*) AS total_records, 100.0::DOUBLE AS quality_score FROM customer
    UNION ALL SELECT '{REF_DAY}', 'orders', 0, 0, count(*), 100.0::DOUBLE FROM cur
    """,
)
def daily_run_quality(spark, sf_dir):
    return read_quality_metrics(spark, _two_days(spark, sf_dir), REF_DAY).drop("calculated_at")


def _gated_run(spark: SparkSession, sf_dir: str) -> str:
    """A gated day over orders and line items, whose key is not unique; returns its folder."""
    base = new_path(spark, "gated-run")
    tables = {"orders": _orders(spark, sf_dir), "lineitem": _lines(spark, sf_dir)}
    specs = [
        TableSpec("orders", "orders", "sales", "files", ("o_orderkey",), row_count_min=10, reference_date="D-1", owner="data", domain="sales"),
        TableSpec("lines", "lineitem", "sales", "files", ("l_orderkey",), row_count_min=10, reference_date="D-1", owner="data", domain="sales"),
    ]
    run_as_of(spark, lambda s: tables[s.table], specs, base, REF_DAY, gate=True)
    return base


@query(
    "daily_run_contracts",
    f"""
    SELECT 'sales.orders' AS table_name, 'events' AS kind, count(*) AS rows FROM orders
    UNION ALL SELECT 'sales.orders', 'state', count(*) FROM orders
    UNION ALL SELECT 'lines', 'duplicates', count(*) - count(DISTINCT l_orderkey) FROM lineitem
    """,
)
def daily_run_contracts(spark, sf_dir):
    """Line items break their contract: they stay out of silver. ``D-1`` is the day before."""
    base = _gated_run(spark, sf_dir)
    kinds = {"events": read_events(spark, base, PREV_DAY), "state": read_state(spark, base, PREV_DAY)}
    parts = [df.groupBy("table_name").agg(F.lit(k).alias("kind"), F.count(F.lit(1)).alias("rows")) for k, df in kinds.items()]
    failed = read_contract_results(spark, base, PREV_DAY).filter("NOT passed")
    parts.append(failed.select("table_name", F.lit("duplicates").alias("kind"), F.col("actual").cast("bigint").alias("rows")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "daily_run_duplicates",
    f"""
    SELECT 'sales.orders' AS table_name, 0::BIGINT AS null_count, 0::BIGINT AS duplicate_count, count(*) AS total_records,
           100.0::DOUBLE AS quality_score FROM orders
    UNION ALL SELECT 'sales.lineitem', 0, count(*) - count(DISTINCT l_orderkey), count(*),
           100.0::DOUBLE * (1.0::DOUBLE - CAST(count(*) - count(DISTINCT l_orderkey) AS DOUBLE) / count(*)) FROM lineitem
    """,
)
def daily_run_duplicates(spark, sf_dir):
    """The day's quality counts the rows of the table that was kept out."""
    rows = read_quality_metrics(spark, _gated_run(spark, sf_dir), PREV_DAY)
    return rows.drop("calculated_at", "ref_date")


@query(
    "run_lineage",
    """
    SELECT * FROM (VALUES ('sales.orders', 'bronze.sales.orders', 'snapshot'), ('bronze.sales.orders', 'silver.delta_events', 'compare'),
      ('silver.delta_events', 'silver.current_state', 'apply'), ('silver.delta_events', 'gold.daily_change_metrics', 'aggregate'),
      ('bronze.sales.orders', 'gold.data_quality_metrics', 'aggregate')) AS t(source_table, target_table, transformation_type)
    WHERE (SELECT count(*) FROM orders) > 0
    """,
)
def run_lineage(spark, sf_dir):
    return read_lineage(spark, _gated_run(spark, sf_dir)).drop("pipeline_name", "execution_timestamp")


@query(
    "run_metadata",
    """
    SELECT 'sales.orders' AS name, 'sales' AS domain, 'data' AS owner, 'files' AS source_system, count(*) AS row_count FROM orders
    UNION ALL SELECT 'sales.lineitem', 'sales', 'data', 'files', count(*) FROM lineitem
    """,
)
def run_metadata(spark, sf_dir):
    rows = read_metadata(spark, _gated_run(spark, sf_dir))
    return rows.select("name", "domain", "owner", "source_system", "row_count")


# --- training-data operators, if their subpackage is there ---------------------------------------------

core = tuple(_queries)
try:
    import corpus_pipeline
    from snapdelta.llm import queries as training
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "snapdelta.llm", "public_tokenizers", "regex", "tokenizers"):
        raise
else:
    _queries |= {name: scoped(fn) for name, fn in (training.QUERIES | {"pipeline": corpus_pipeline.run}).items()}
    _oracles |= training.ORACLES
    if corpus_pipeline.ORACLE_SQL:
        _oracles["pipeline"] = corpus_pipeline.ORACLE_SQL


# --- driver contract ---------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Events between the two days of ``orders``."""
    return _queries["delta_events"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)

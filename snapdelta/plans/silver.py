"""Silver jobs: deduplication, declared transformations, changes and state."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import add_row_hash, clean_strings
from ..operators.aggregates import deduplicate
from ..operators.delta import arrivals, attach_payload, detect_delta, one_row_per_key
from ..operators.envelope import for_snapshot, parse_payload
from ..operators.ledger import STARTED, SUCCESS, Load, finished_loads, ledger_row, now, read_ledger, record_ingestion
from ..operators.quality import validate_schema
from ..operators.state import STATE_COLUMNS, apply_delta, latest_by_key, maintain_current_state, state_of_arrivals
from ..schemas import BRONZE_METADATA, CURRENT_STATE, DELTA_EVENTS, KEYS, SNAPSHOT_KEYS, SNAPSHOT_RAW
from ..session import CODEC, delete_path, new_path
from ..sinks.buckets import BUCKETS, DIGESTS, changed_buckets, digests, read_buckets, write_buckets
from ..sinks.layers import align, in_stored_order, overwrite_partition
from ..sinks.versions import list_names, next_name, read_version, version_names, write_version
from ..sources.tables import layer_path, partition_path, read_layer, read_partition, stage
from .bronze import ledger_path, snapshot_path, write_counted

SILVER_SCHEMA = "silver"
STATE_TABLE = "current_state"


def silver_dedupe(
    df: DataFrame,
    ref_date_col: str = "reference_date",
    exclude: Iterable[str] = BRONZE_METADATA,
    scope: str = "day",
) -> DataFrame:
    """Hash rows over their business columns and keep one per hash.

    ``scope="day"`` keeps one per day and hash; ``"all"`` keeps the first day only.
    """
    hashed = add_row_hash(df, exclude=exclude)
    if scope == "day":
        return deduplicate(hashed, [ref_date_col, "row_hash"])
    if scope != "all":
        raise ValueError(f"unknown scope {scope!r}")
    return latest_by_key(hashed, ["row_hash"], [ref_date_col], latest=False)


def silver_transform(
    df: DataFrame, steps: Sequence[Mapping], order_by: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Apply declared steps in order: ``clean_strings``, ``deduplicate``,
    ``validate_schema``. Returns the rows and the schema report, if one is declared.

    A cleaned column the table lacks is passed over; ``order_by`` decides which
    duplicate stays.
    """
    report = None
    for step in steps:
        kind = step["type"]
        if kind == "clean_strings":
            present = [c for c in step["columns"] if c in df.columns]
            df = clean_strings(df, present, step.get("trim_spaces", True), step.get("upper_case", False))
        elif kind == "deduplicate":
            df = deduplicate(df, step["subset"], order_by)
        elif kind == "validate_schema":
            report = validate_schema(df, step["schema"])
        else:
            raise ValueError(f"unknown transformation {kind!r}")
    return df, report


def typed_silver(
    snapshots: DataFrame,
    ref_date: str | dt.date,
    table_name: str,
    schema: str | T.StructType,
    key: Sequence[str],
    clean: Sequence[str] = (),
) -> DataFrame:
    """Typed rows of one table and day from their JSON payloads, cleaned, one per key
    (the newest load)."""
    rows = parse_payload(for_snapshot(snapshots, ref_date, table_name), schema)
    rows = clean_strings(rows, clean) if clean else rows
    return deduplicate(rows, key, ["ingestion_timestamp", "row_hash"]).drop("primary_key")


def write_silver_day(
    spark: SparkSession,
    base: str,
    source: str,
    entity: str,
    ref_date: str | dt.date,
    exclude: Iterable[str] = BRONZE_METADATA,
) -> int:
    """Hash and deduplicate one entity's bronze rows of a day into the silver layer;
    returns the rows kept. A rerun replaces the day."""
    rows = silver_dedupe(read_layer(spark, base, "bronze", source, entity, ref_date), exclude=exclude)
    path = layer_path(base, "silver", source, entity)
    return write_counted(
        rows, f"silver_{entity}", lambda d: overwrite_partition(d, path, {"reference_date": str(ref_date)})
    )


def read_snapshots(spark: SparkSession, base: str, ref_date: str | dt.date) -> DataFrame:
    """All envelopes of a day."""
    return read_partition(spark, snapshot_path(base), SNAPSHOT_RAW, {"ref_date": ref_date})


def events_path(base: str) -> str:
    return f"{base.rstrip('/')}/silver/delta_events"


def state_path(base: str) -> str:
    return f"{base.rstrip('/')}/silver/current_state"


def index_path(base: str) -> str:
    return f"{base.rstrip('/')}/bronze/snapshot_keys"


def read_events(spark: SparkSession, base: str, ref_date: str | dt.date) -> DataFrame:
    """All events of a day."""
    return read_partition(spark, events_path(base), DELTA_EVENTS, {"ref_date": ref_date})


# --- key indexes: what a day's comparison reads ----------------------------------------


def write_key_index(
    spark: SparkSession, base: str, ref_date: str | dt.date, buckets: int = BUCKETS, tables: Sequence[str] | None = None
) -> dict:
    """Index a day's snapshots (of ``tables``): key, newest hash and number of rows of every key, in sorted
    buckets, with their digests. Returns the version that names it; a rerun replaces it."""
    root, day = index_path(base), str(ref_date)
    folder = f"version={next_name(spark, root, day)}-{uuid.uuid4().hex[:8]}"
    path = f"{root}/{folder}"
    rows = read_snapshots(spark, base, ref_date)
    rows = rows if tables is None else rows.filter(F.col("table_name").isin(*tables))
    newest = F.struct("ingestion_timestamp", "row_hash")
    index = rows.groupBy(*KEYS).agg(F.max(newest).getField("row_hash").alias("row_hash"), F.count(F.lit(1)).alias("copies"))
    write_buckets(index, f"{path}/rows", KEYS, buckets)
    stored = read_buckets(spark, f"{path}/rows", SNAPSHOT_KEYS, KEYS, buckets)
    digests(stored, KEYS, buckets).coalesce(1).write.parquet(f"{path}/digests")
    version = {"folder": folder, "buckets": buckets}
    write_version(spark, root, next_name(spark, root, day), version)
    return version


def key_index(spark: SparkSession, base: str, ref_date: str | dt.date) -> dict | None:
    """The newest index of a day; None if it has none."""
    names = [n for n in version_names(spark, index_path(base)) if n.rpartition("-")[0] == str(ref_date)]
    return read_version(spark, index_path(base), names[-1]) if names else None


def read_key_index(spark: SparkSession, base: str, index: dict, only: Sequence[int] | None = None) -> DataFrame:
    """Rows of an index, or those in some of its buckets."""
    path = f"{index_path(base)}/{index['folder']}/rows"
    return read_buckets(spark, path, SNAPSHOT_KEYS, KEYS, index["buckets"], only)


def read_digests(spark: SparkSession, base: str, index: dict) -> DataFrame:
    return spark.read.schema(DIGESTS).parquet(f"{index_path(base)}/{index['folder']}/digests")


def indexed_delta(
    spark: SparkSession, base: str, cur: dict, prev: dict, tables: Sequence[str], ref_date: str | dt.date
) -> DataFrame | None:
    """Events (without payloads) of ``tables`` between two indexed days; None if all their
    digests are equal. Only buckets that differ are read, and nothing moves if both days
    have the same number of buckets."""
    only = None
    if cur["buckets"] == prev["buckets"]:
        only = changed_buckets(read_digests(spark, base, cur), read_digests(spark, base, prev), tables)
        if not only:
            return None
    listed = F.col("table_name").isin(*tables)
    after, before = (read_key_index(spark, base, i, only).filter(listed).drop("copies") for i in (cur, prev))
    return detect_delta(after, before, ref_date, unique_keys=True)


# --- state versions ------------------------------------------------------------------------


def state_version(spark: SparkSession, base: str, before: dt.date | None = None, day: dt.date | None = None) -> dict | None:
    """The newest complete state version of ``day``, or of any day before ``before``."""
    root = state_path(base)
    dated = [(dt.date.fromisoformat(n.rpartition("-")[0]), n) for n in version_names(spark, root)]
    names = [n for d, n in dated if (d == day if day is not None else before is None or d < before)]
    return read_version(spark, root, names[-1]) if names else None


def read_state_tables(spark: SparkSession, base: str, entries: Mapping[str, Mapping], tables: Iterable[str] | None = None) -> DataFrame:
    """State rows of some tables of a version (of all by default). Active keys were last seen
    on the day the version names for their table: a table without changes is not rewritten
    to say so."""
    chosen = {t: e for t, e in entries.items() if tables is None or t in set(tables)}
    if not chosen:
        return spark.createDataFrame([], CURRENT_STATE)
    root = state_path(base)
    paths = [partition_path(f"{root}/{e['folder']}", {"table_name": t}) for t, e in sorted(chosen.items())]
    rows = spark.read.schema(f"{CURRENT_STATE}, version STRING").option("basePath", root).parquet(*paths)
    active = F.col("is_active") == 1
    of = lambda field: F.create_map(*[F.lit(x) for t, e in chosen.items() for x in (t, e[field])])[F.col("table_name")]
    return rows.select(
        *[c for c in STATE_COLUMNS if c not in ("last_seen_date", "updated_at")],
        F.when(active, of("seen").cast("date")).otherwise(F.col("last_seen_date")).alias("last_seen_date"),
        F.when(active, of("updated").cast("timestamp")).otherwise(F.col("updated_at")).alias("updated_at"),
    ).select(*STATE_COLUMNS)


def read_state(spark: SparkSession, base: str, state_date: str | dt.date) -> DataFrame:
    """One stored state version."""
    version = state_version(spark, base, day=dt.date.fromisoformat(str(state_date)))
    return read_state_tables(spark, base, version["tables"] if version else {})


def write_state(
    spark: SparkSession, base: str, day: dt.date, rows: DataFrame | None, kept: Mapping[str, Mapping], seen: Iterable[str], stamp: str
) -> None:
    """Commit a day's state version: ``rows`` are new, the tables in ``kept`` are named as they
    are, and those of them in ``seen`` were loaded without a change."""
    root = state_path(base)
    name = next_name(spark, root, str(day))
    today = {"seen": str(day), "updated": stamp}
    entries = {t: {**e, **(today if t in set(seen) else {})} for t, e in kept.items()}
    if rows is not None:
        folder = f"version={name}-{uuid.uuid4().hex[:8]}"
        settled = align(rows, CURRENT_STATE).sortWithinPartitions("table_name", "is_active", "primary_key")
        settled.write.partitionBy("table_name").parquet(f"{root}/{folder}", compression=CODEC)
        written = [unquote(n.removeprefix("table_name=")) for n in list_names(spark, f"{root}/{folder}") if n.startswith("table_name=")]
        entries |= {t: {"folder": folder, **today} for t in written}
    write_version(spark, root, name, {"date": str(day), "tables": entries})


def process_silver(
    spark: SparkSession,
    base: str,
    ref_date: str | dt.date,
    tables: Sequence[str],
    finished: set[Load] | None = None,
    buckets: int = BUCKETS,
) -> int:
    """Events and the next state version of one day, for all ``tables`` at once;
    returns the number of events.

    The day's keys are indexed once; comparing two days reads only the buckets of their
    indexes whose digests differ, and nothing is shuffled. Payloads are fetched for the events
    found; a table seen for the first time is all events, straight from its snapshot. Tables not listed
    (not loaded that day) raise no events, and their state is named again, not copied; so is
    that of tables without events. The ledger shows the day as started until its state
    is complete, so a run that dies half-way, also a forced one, is repeated.
    """
    started = now()
    stamp = started.strftime("%Y-%m-%d %H:%M:%S.%f")
    day = dt.date.fromisoformat(str(ref_date))
    previous_day = day - dt.timedelta(days=1)
    record_ingestion(spark, ledger_path(base), [ledger_row(day, SILVER_SCHEMA, STATE_TABLE, STARTED, started)])
    cur, prev = (read_snapshots(spark, base, d) for d in (day, previous_day))

    index, before = write_key_index(spark, base, day, buckets, tables), key_index(spark, base, previous_day)
    rows_of = _rows_per_table(spark, base, index)
    indexed = set(_rows_per_table(spark, base, before)) if before else set()
    known, new = [t for t in tables if t in indexed], [t for t in tables if t not in indexed]
    parts, staged = [], new_path(spark, "events-found")
    try:
        found = indexed_delta(spark, base, index, before, known, day) if known else None
        if found is not None:
            found = stage(found, staged)
            listed = F.col("table_name").isin(*known)
            parts.append(attach_payload(found, cur.filter(listed), prev.filter(listed)))
        if new:
            copies = any(c > n for t in new for n, c in [rows_of.get(t, (0, 0))])
            arrived = one_row_per_key(cur.filter(F.col("table_name").isin(*new)), unique_keys=not copies)
            parts.append(arrivals(arrived, day))
        events = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], DELTA_EVENTS)
        events = events.withColumn("detected_at", F.lit(stamp).cast("timestamp"))
        n_events = write_counted(
            in_stored_order(align(events, DELTA_EVENTS), "silver", "delta_events"),
            "events",
            lambda d: overwrite_partition(d, events_path(base), {"ref_date": day}),
        )
    finally:
        delete_path(spark, staged)

    old = state_version(spark, base, before=day)
    entries = old["tables"] if old else {}
    loaded = set()
    if old and old["date"] == str(previous_day):
        if finished is None:
            finished = finished_loads(read_ledger(spark, ledger_path(base), [previous_day]), [previous_day])
        loaded = set(_loaded(finished, previous_day, tables))
    events = read_events(spark, base, day)
    changed = {r["table_name"] for r in events.select("table_name").distinct().collect()} if n_events else set()
    # Each table goes its own way: one that missed yesterday does not hold up the others.
    carried = [t for t in tables if t in entries and t in loaded and t in indexed]
    missed = [t for t in tables if t in entries and t not in carried]
    first = [t for t in tables if t not in entries]
    # ``indexed`` tables without a state before (an interrupted first day) go through their whole snapshot.
    missed += [t for t in first if t in indexed]
    first = [t for t in first if t not in indexed]
    rewritten = [t for t in carried if t in changed]
    joined, state = [], []
    if rewritten:
        these = F.col("table_name").isin(*rewritten)
        joined.append(apply_delta(read_state_tables(spark, base, entries, rewritten), events.filter(these), day))
    if missed:
        these = F.col("table_name").isin(*missed)
        joined.append(maintain_current_state(read_state_tables(spark, base, entries, missed), cur.filter(these), day))
    if joined:
        # Joins leave some rows of every table in every task: several tables are gathered first, one need not move.
        rows = reduce(DataFrame.unionByName, joined)
        state.append(rows if len(rewritten) + len(missed) == 1 else rows.hint("rebalance", "table_name"))
    if first:  # straight from the stored events, which lie by table
        state.append(state_of_arrivals(events.filter(F.col("table_name").isin(*first)), day))
    kept = {t: e for t, e in entries.items() if t not in rewritten and t not in missed}
    write_state(spark, base, day, reduce(DataFrame.unionByName, state) if state else None, kept, carried, stamp)
    record_ingestion(spark, ledger_path(base), [ledger_row(day, SILVER_SCHEMA, STATE_TABLE, SUCCESS, started)])
    return n_events


def _rows_per_table(spark: SparkSession, base: str, index: dict) -> dict[str, tuple[int, int]]:
    """Keys and rows of every table of an index, from its digests."""
    found = read_digests(spark, base, index).groupBy("table_name").agg(F.sum("rows").alias("n"), F.sum("copies").alias("c"))
    return {r["table_name"]: (r["n"], r["c"]) for r in found.collect()}


def _loaded(finished: set[Load], day: dt.date, tables: Sequence[str]) -> list[str]:
    """The tables that have a successful load of ``day``."""
    done = {f"{schema}.{table}" if schema else table for d, schema, table in finished if d == day}
    return [t for t in tables if t in done]

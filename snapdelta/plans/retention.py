"""Retention of every layer of the daily run, by age and by what is still named.

Past its layer's days a thing goes, unless the ledger still names it: the last successful load of each
table keeps its envelopes and index, the newest state version keeps every folder it names,
however old, and the ledger keeps the rows of those loads. What no version names goes at
once, whatever its age: folders of runs that died, and those a rerun replaced.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import compact_rows, forget_days, read_ledger, successful_loads
from ..operators.quality import LAYER_RETENTION_DAYS
from ..schemas import INGESTION_CONTROL
from ..session import delete_path
from ..sinks.layers import expire_partitions
from ..sinks.versions import drop_unnamed, drop_versions, list_names, read_version, version_names
from ..sources.tables import partition_path
from .bronze import ledger_path, snapshot_path
from .gold import GOLD_SCHEMA, gold_path
from .silver import SILVER_SCHEMA, events_path, index_path, state_path


def last_loads(spark: SparkSession, base: str) -> dict[str, dt.date]:
    """The day of the last successful load of every source table, by its full name."""
    done = successful_loads(read_ledger(spark, ledger_path(base))).filter(~F.col("schema_name").isin(SILVER_SCHEMA, GOLD_SCHEMA))
    last = done.groupBy("schema_name", "table_name").agg(F.max("ref_date").alias("ref_date"))
    return {f"{r['schema_name']}.{r['table_name']}" if r["schema_name"] else r["table_name"]: r["ref_date"] for r in last.collect()}


def _day(name: str) -> dt.date:
    return dt.date.fromisoformat(name.rpartition("-")[0])


def _expire_versions(spark: SparkSession, path: str, limit: dt.date | None, needed: set[dt.date]) -> list[str]:
    """Drop versions past ``limit`` and those a later one of their day replaced; a needed day keeps its newest."""
    names = version_names(spark, path)
    newest = {_day(n): n for n in names}
    old = [n for n in names if newest[_day(n)] != n or (limit is not None and _day(n) < limit and _day(n) not in needed)]
    drop_versions(spark, path, old)
    return old


def expire_runs(
    spark: SparkSession, base: str, as_of: str | dt.date, days: Mapping[str, int | None] | None = None
) -> dict[str, list[str]]:
    """Remove what is past its layer's retention and not named any more; returns what went,
    by kind. ``days`` are per layer; None keeps a layer. Run it when no run is going on."""
    days = {**LAYER_RETENTION_DAYS, **(days or {})}
    today = dt.date.fromisoformat(str(as_of))
    limit = {layer: None if n is None else today - dt.timedelta(days=n) for layer, n in days.items()}
    last = last_loads(spark, base)
    gone: dict[str, list[str]] = {}

    # Bronze: envelopes of a table and day, and the days' indexes.
    raw, gone["envelopes"] = snapshot_path(base), []
    for name in list_names(spark, raw):
        if name.startswith("_new"):
            delete_path(spark, f"{raw}/{name}")
        if not name.startswith("ref_date=") or limit["bronze"] is None:
            continue
        day = dt.date.fromisoformat(name.removeprefix("ref_date="))
        if day >= limit["bronze"]:
            continue
        tables = [unquote(n.removeprefix("table_name=")) for n in list_names(spark, f"{raw}/{name}") if n.startswith("table_name=")]
        expired = [t for t in tables if last.get(t) != day]
        for table in expired:
            delete_path(spark, partition_path(raw, {"ref_date": day, "table_name": table}))
        if len(expired) == len(tables):
            delete_path(spark, f"{raw}/{name}")
        gone["envelopes"] += [f"{day} {t}" for t in expired]
    index = index_path(base)
    gone["indexes"] = _expire_versions(spark, index, limit["bronze"], set(last.values()))
    gone["indexes"] += drop_unnamed(spark, index, [read_version(spark, index, n)["folder"] for n in version_names(spark, index)])

    # Silver: events, and state versions with what they alone name.
    events = events_path(base)
    for name in list_names(spark, events):
        if name.startswith("_new"):
            delete_path(spark, f"{events}/{name}")
    expired = [] if limit["silver"] is None else expire_partitions(spark, events, "ref_date", as_of, days["silver"])
    gone["events"] = [str(d) for d in expired]
    state = state_path(base)
    newest = {_day(n) for n in version_names(spark, state)[-1:]}
    gone["state"] = _expire_versions(spark, state, limit["silver"], newest)
    named = {e["folder"] for n in version_names(spark, state) for e in read_version(spark, state, n)["tables"].values()}
    gone["state"] += drop_unnamed(spark, state, named)

    # Gold, and the ledger as long as anything it could name.
    gone["gold"] = []
    for table in list_names(spark, f"{base.rstrip('/')}/gold"):
        gone["gold"] += [f"{d} {table}" for d in expire_partitions(spark, gold_path(base, table), "ref_date", as_of, days["gold"])]
    limits = [limit[layer] for layer in ("bronze", "silver")]
    if None not in limits:
        path = ledger_path(base)
        compact_rows(spark, path, INGESTION_CONTROL, "ref_date")
        gone["ledger"] = forget_days(spark, path, min(limits), set(last.values()) | newest)
    return gone



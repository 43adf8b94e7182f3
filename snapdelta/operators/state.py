"""Current state per key, and the collapse rules of stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_date
from ..schemas import CURRENT_STATE, KEYS, column_names
from .delta import one_row_per_key

STATE_COLUMNS = column_names(CURRENT_STATE)


def latest_by_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], latest: bool = True) -> DataFrame:
    """One row per key: the greatest (or least) in ``order_cols``, ties settled by
    the remaining columns (those that have no order, such as maps, by their JSON).

    An aggregate rather than a window: it combines on the map side, so a key
    with very many rows never has to be sorted in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [*order_cols, *[c for c in rest if c not in order_cols]]
    unordered = {f.name for f in df.schema.fields if "map<" in f.dataType.simpleString()}
    if unordered & set(ordered):
        pick = F.max_by if latest else F.min_by
        order = F.struct(*[F.to_json(c).alias(c) if c in unordered else F.col(c) for c in ordered])
        picked = df.groupBy(*keys).agg(pick(F.struct(*ordered), order).alias("_row"))
    else:
        pick = F.max if latest else F.min
        picked = df.groupBy(*keys).agg(pick(F.struct(*ordered)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def collapse_latest(df: DataFrame, keys: Sequence[str], version_col: str) -> DataFrame:
    """Replace rows of equal key by the one with the greatest version."""
    return latest_by_key(df, keys, [version_col])


def collapse_sum(
    df: DataFrame, keys: Sequence[str], sum_cols: Sequence[str], latest_col: str | None = "calculated_at"
) -> DataFrame:
    """Merge rows of equal key by adding their counters; a rerun that appended the
    same rows again therefore doubles them."""
    aggs = [F.sum(c).alias(c) for c in sum_cols]
    if latest_col is not None and latest_col in df.columns:
        aggs.append(F.max(latest_col).alias(latest_col))
    return df.groupBy(*keys).agg(*aggs)


def append_current_state(snapshot: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """State rows of one day's snapshot to append: all active, first and last seen
    that day. Read the appended table through :func:`collapse_latest`; deleted
    keys stay active and the first date is lost, see :func:`maintain_current_state`."""
    return snapshot.select(
        *KEYS,
        "row_hash",
        "data",
        F.col("ref_date").alias("first_seen_date"),
        F.col("ref_date").alias("last_seen_date"),
        F.lit(1).alias("is_active"),
        (F.current_timestamp() if updated_at is None else updated_at).alias("updated_at"),
    )


def maintain_current_state(
    state: DataFrame,
    snapshot: DataFrame,
    ref_date: str | dt.date,
    updated_at: Column | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """The next state version: keeps the first date, advances the last one and
    deactivates keys the snapshot no longer has."""
    day = as_date(ref_date)
    today = one_row_per_key(snapshot, unique_keys=unique_keys).select(
        *KEYS,
        F.col("row_hash").alias("new_hash"),
        F.col("data").alias("new_data"),
        F.lit(True).alias("present"),
    )
    known = state.select(*KEYS, "row_hash", "data", "first_seen_date", "last_seen_date", "is_active", "updated_at")
    present = F.col("present").isNotNull()
    stamp = F.current_timestamp() if updated_at is None else updated_at
    gone = ~present & (F.col("is_active") == 1)
    return known.join(today, KEYS, "full_outer").select(
        *KEYS,
        F.when(present, F.col("new_hash")).otherwise(F.col("row_hash")).alias("row_hash"),
        F.when(present, F.col("new_data")).otherwise(F.col("data")).alias("data"),
        F.least(F.col("first_seen_date"), F.when(present, day)).alias("first_seen_date"),
        F.greatest(F.col("last_seen_date"), F.when(present, day)).alias("last_seen_date"),
        present.cast("int").alias("is_active"),
        F.when(present | gone, stamp).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def apply_delta(
    state: DataFrame, events: DataFrame, ref_date: str | dt.date, updated_at: Column | None = None
) -> DataFrame:
    """The next state version from one day's events instead of its whole snapshot.

    Same result as :func:`maintain_current_state` if ``state`` is the version of
    the day the events compare with. The state is scanned once (and its inactive rows
    once more) and joined with the events; read those back from storage and Catalyst broadcasts them when
    they are small, so the state itself does not shuffle.
    """
    day = as_date(ref_date)
    stamp = F.current_timestamp() if updated_at is None else updated_at
    changes = events.select(
        *KEYS,
        "operation_type",
        F.col("row_hash_after").alias("new_hash"),
        F.col("data_after").alias("new_data"),
    )
    op = F.col("operation_type")
    arrived = op.isNotNull() & op.isin("INSERT", "UPDATE")
    active = F.when(op.isNull(), F.col("is_active") == 1).otherwise(arrived)
    touched = active | (op.isNotNull() & (F.col("is_active") == 1))
    kept = state.join(changes, KEYS, "left").select(
        *KEYS,
        F.when(arrived, F.col("new_hash")).otherwise(F.col("row_hash")).alias("row_hash"),
        F.when(arrived, F.col("new_data")).otherwise(F.col("data")).alias("data"),
        "first_seen_date",
        F.when(active, day).otherwise(F.col("last_seen_date")).alias("last_seen_date"),
        active.cast("int").alias("is_active"),
        F.when(touched, stamp).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    # A key that arrives was missing the day before: the state has it inactive or not at all,
    # so the second look at the state reads inactive rows only.
    inactive = state.filter(F.col("is_active") == 0).select(*KEYS)
    back = inactive.join(events.filter(op == "INSERT").select(*KEYS), KEYS, "left_semi")
    added = state_of_arrivals(events.join(back, KEYS, "left_anti"), ref_date, updated_at)
    return kept.unionByName(added).select(*STATE_COLUMNS)


def state_of_arrivals(events: DataFrame, ref_date: str | dt.date, updated_at: Column | None = None) -> DataFrame:
    """State rows of keys that no earlier state has, from their INSERT events."""
    day = as_date(ref_date)
    return events.filter(F.col("operation_type") == "INSERT").select(
        *KEYS,
        F.col("row_hash_after").alias("row_hash"),
        F.col("data_after").alias("data"),
        day.alias("first_seen_date"),
        day.alias("last_seen_date"),
        F.lit(1).alias("is_active"),
        (F.current_timestamp() if updated_at is None else updated_at).alias("updated_at"),
    )


def state_from_history(snapshots: DataFrame, as_of: str | dt.date, updated_at: Column | None = None) -> DataFrame:
    """The state on ``as_of`` from all snapshots up to it, in one aggregation."""
    day = as_date(as_of)
    order = [c for c in ("ref_date", "ingestion_timestamp") if c in snapshots.columns]
    newest = F.struct(*order, "row_hash")
    rows = (
        snapshots.filter(F.col("ref_date") <= day)
        .groupBy(*KEYS)
        .agg(
            F.max_by("row_hash", newest).alias("row_hash"),
            F.max_by("data", newest).alias("data"),
            F.min("ref_date").alias("first_seen_date"),
            F.max("ref_date").alias("last_seen_date"),
        )
    )
    return rows.withColumns(
        {
            "is_active": (F.col("last_seen_date") == day).cast("int"),
            "updated_at": F.current_timestamp() if updated_at is None else updated_at,
        }
    ).select(*STATE_COLUMNS)

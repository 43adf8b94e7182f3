"""Day-over-day change detection between two snapshots.

A snapshot has ``table_name, primary_key, row_hash`` and usually ``data``. The
key decides what matches; ``table_name`` alone is never a shuffle key, so one
huge table spreads over all partitions.

Keys are meant to be unique but nothing enforces it. Of several rows with one key
the newest load counts, then the greatest hash. That choice is an aggregate,
which combines on the map side: a key held by a large share of the rows leaves
each task as a single row, and there are never more events than keys.
``unique_keys=True`` skips the choice when the source guarantees its key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_date, hash_changed
from ..schemas import KEYS

EVENT_COLUMNS = [
    "ref_date",
    "table_name",
    "primary_key",
    "operation_type",
    "row_hash_before",
    "row_hash_after",
    "data_before",
    "data_after",
]


def _newest(snapshot: DataFrame, order_by: Sequence[str] = ("ingestion_timestamp",)) -> Column:
    """What decides between rows of one key; ends with the hash itself."""
    return F.struct(*[c for c in order_by if c in snapshot.columns], "row_hash")


def one_row_per_key(
    snapshot: DataFrame,
    keys: Sequence[str] = KEYS,
    order_by: Sequence[str] = ("ingestion_timestamp",),
    unique_keys: bool = False,
) -> DataFrame:
    """``keys, row_hash, data`` with the newest row of each key.

    The payload is an aggregate of its own, so Catalyst drops it when nothing
    downstream reads it.
    """
    values = [c for c in ("row_hash", "data") if c in snapshot.columns]
    if unique_keys:
        return snapshot.select(*keys, *values)
    newest = _newest(snapshot, order_by)
    aggs = [F.max(newest).getField("row_hash").alias("row_hash")]
    if "data" in values:
        aggs.append(F.max_by("data", newest).alias("data"))
    return snapshot.groupBy(*keys).agg(*aggs)


def _with_data(snapshot: DataFrame) -> DataFrame:
    return snapshot if "data" in snapshot.columns else snapshot.withColumn("data", F.lit(None).cast("string"))


def _side(snapshot: DataFrame, suffix: str, keys: Sequence[str], unique_keys: bool) -> DataFrame:
    rows = _with_data(one_row_per_key(snapshot, keys, unique_keys=unique_keys))
    return rows.select(
        *keys,
        F.col("row_hash").alias(f"row_hash_{suffix}"),
        F.col("data").alias(f"data_{suffix}"),
        F.lit(True).alias(f"in_{suffix}"),
    )


def _compare_unique(after: DataFrame, before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both sides of every key by a full outer join; each side shuffles once."""
    return _side(after, "after", keys, True).join(_side(before, "before", keys, True), list(keys), "full_outer")


def _compare_any(after: DataFrame, before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both sides of every key by one aggregation of their union: the choice of the
    newest row and the comparison share a single shuffle, and no join is left."""

    def tagged(df: DataFrame, is_after: bool) -> DataFrame:
        df = _with_data(df)
        return df.select(*keys, _newest(df).alias("newest"), "data", F.lit(is_after).alias("is_after"))

    def side(suffix: str, wanted: Column) -> list[Column]:
        newest = F.when(wanted, F.col("newest"))
        return [
            F.max(newest).getField("row_hash").alias(f"row_hash_{suffix}"),
            F.max_by("data", newest).alias(f"data_{suffix}"),
            F.max(newest).isNotNull().alias(f"in_{suffix}"),
        ]

    rows = _align_newest(tagged(after, True), tagged(before, False))
    is_after = F.col("is_after")
    return rows.groupBy(*keys).agg(*side("after", is_after), *side("before", ~is_after))


def _align_newest(after: DataFrame, before: DataFrame) -> DataFrame:
    if after.schema["newest"].dataType.names != before.schema["newest"].dataType.names:
        # Only one snapshot knows when it was loaded; within it the hash decides too.
        hash_only = F.struct(F.col("newest.row_hash").alias("row_hash"))
        after, before = (df.withColumn("newest", hash_only) for df in (after, before))
    return after.unionByName(before)


def _compare(after: DataFrame, before: DataFrame, keys: Sequence[str], unique_keys: bool) -> DataFrame:
    sides = (_compare_unique if unique_keys else _compare_any)(after, before, keys)
    in_after, in_before = (F.coalesce(c, F.lit(False)) for c in ("in_after", "in_before"))
    operation = (
        F.when(~in_before, "INSERT")
        .when(~in_after, "DELETE")
        .when(hash_changed("row_hash_before", "row_hash_after"), "UPDATE")
    )
    return sides.withColumn("operation_type", operation).filter(F.col("operation_type").isNotNull())


def _events(df: DataFrame, ref_date: Column | None = None) -> DataFrame:
    if ref_date is not None:
        df = df.withColumn("ref_date", ref_date)
    empty = F.lit(None).cast("string")
    return df.select(*[F.col(c) if c in df.columns else empty.alias(c) for c in EVENT_COLUMNS])


def detect_delta(
    cur: DataFrame, prev: DataFrame, ref_date: str | dt.date, unique_keys: bool = False
) -> DataFrame:
    """Insert, update and delete events of one day; each snapshot is shuffled once.

    Drop ``data`` from both inputs (or from the result) to compare keys and hashes
    only, and see :func:`attach_payload`.
    """
    return _events(_compare(cur, prev, KEYS, unique_keys), as_date(ref_date))


def detect_delta_range(
    snapshots: DataFrame,
    first: str | dt.date | None = None,
    last: str | dt.date | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """Events of many days at once, as if :func:`detect_delta` had run day by day: a
    backfill in one job.

    Each day compares with the calendar day before it. With ``first`` and
    ``last`` every day between them counts as run, otherwise every day that has a
    snapshot.
    """
    keys = ["ref_date", *KEYS]
    before = snapshots.withColumn("ref_date", F.date_add("ref_date", 1))
    if first is None or last is None:
        # A day without a snapshot deletes nothing: its events go, not the rows before them.
        days = snapshots.select("ref_date").distinct()
        return _events(_compare(snapshots, before, keys, unique_keys)).join(days, "ref_date", "left_semi")
    in_range = F.col("ref_date").between(as_date(first), as_date(last))
    return _events(_compare(snapshots.filter(in_range), before.filter(in_range), keys, unique_keys))


def delta_inserts(cur: DataFrame, prev: DataFrame, ref_date: str | dt.date, unique_keys: bool = False) -> DataFrame:
    """Keys of ``cur`` that ``prev`` lacks."""
    known = prev.select(*KEYS) if unique_keys else prev.select(*KEYS).distinct()
    rows = _side(cur, "after", KEYS, unique_keys).join(known, KEYS, "left_anti")
    return _events(rows.withColumn("operation_type", F.lit("INSERT")), as_date(ref_date))


def delta_updates(cur: DataFrame, prev: DataFrame, ref_date: str | dt.date, unique_keys: bool = False) -> DataFrame:
    """Keys present on both days with different hashes."""
    rows = (
        _side(cur, "after", KEYS, unique_keys)
        .join(_side(prev, "before", KEYS, unique_keys), KEYS, "inner")
        .filter(hash_changed("row_hash_before", "row_hash_after"))
    )
    return _events(rows.withColumn("operation_type", F.lit("UPDATE")), as_date(ref_date))


def delta_deletes(cur: DataFrame, prev: DataFrame, ref_date: str | dt.date, unique_keys: bool = False) -> DataFrame:
    """Keys of ``prev`` that ``cur`` lacks, dated with the current day."""
    known = cur.select(*KEYS) if unique_keys else cur.select(*KEYS).distinct()
    rows = _side(prev, "before", KEYS, unique_keys).join(known, KEYS, "left_anti")
    return _events(rows.withColumn("operation_type", F.lit("DELETE")), as_date(ref_date))


def arrivals(rows: DataFrame, ref_date: str | dt.date) -> DataFrame:
    """Events of a table that had no snapshot before: every row, one per key, is an INSERT."""
    inserted = rows.select(
        *KEYS, F.col("row_hash").alias("row_hash_after"), F.col("data").alias("data_after"), F.lit("INSERT").alias("operation_type")
    )
    return _events(inserted, as_date(ref_date))


def union_events(*parts: DataFrame) -> DataFrame:
    """Change sets as one event table; columns missing from a part are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def split_delta(cur: DataFrame, prev: DataFrame, ref_date: str | dt.date, unique_keys: bool = False) -> DataFrame:
    """The three change sets as separate joins. A full outer join cannot broadcast;
    these can, which pays when one snapshot is below the broadcast threshold."""
    parts = [f(cur, prev, ref_date, unique_keys) for f in (delta_inserts, delta_updates, delta_deletes)]
    return union_events(*parts)


def attach_payload(events: DataFrame, cur: DataFrame, prev: DataFrame) -> DataFrame:
    """Fill ``data_before`` / ``data_after`` of events found without payloads.

    Comparing keys and hashes moves little data; payloads are then needed for
    changed keys only. Pass ``events`` read back from storage: Catalyst knows
    its size and broadcasts it if it fits, so unchanged payloads never shuffle.
    """

    def payload(snapshot: DataFrame, is_after: bool) -> DataFrame:
        return snapshot.select(key, "row_hash", "data", F.lit(is_after).alias("is_after"))

    # A missing key is a value like any other, and so it is in a struct; events without a payload stay. Rows meet
    # by key alone, so that the aggregation finds them where the join has put them.
    key = F.struct(*KEYS).alias("key")
    wanted = events.drop("data_before", "data_after")
    rows = payload(cur, True).unionByName(payload(prev, False)).alias("p")

    def data_of(side: str, is_after: Column) -> Column:
        same = is_after & F.col("p.row_hash").eqNullSafe(F.col(f"row_hash_{side}"))
        return F.max(F.when(same, F.col("data"))).alias(f"data_{side}")

    return (
        wanted.select("*", key)
        .join(rows, "key", "left")
        .groupBy("key", *wanted.columns)
        .agg(data_of("before", ~F.col("is_after")), data_of("after", F.col("is_after")))
        .select(*EVENT_COLUMNS)
    )


def delta_versions(cur: DataFrame, prev: DataFrame) -> DataFrame:
    """How often each version (key and hash) occurs on either day.

    Lossless for duplicate keys and linear in the input: copies of a row combine
    on the map side, and versions of one key spread by their hash.
    """

    def side(df: DataFrame, before: int, after: int) -> DataFrame:
        return df.select(*KEYS, "row_hash", F.lit(before).alias("before"), F.lit(after).alias("after"))

    return (
        side(cur, 0, 1)
        .unionByName(side(prev, 1, 0))
        .groupBy(*KEYS, "row_hash")
        .agg(F.sum("before").alias("rows_before"), F.sum("after").alias("rows_after"))
    )


def row_pair_counts(cur: DataFrame, prev: DataFrame) -> DataFrame:
    """Events per table if every row of a key were compared with every other.

    A row-by-row self-join reports m x n updates for a key with m and n rows.
    The counts follow from the version counts without forming a single pair:
    all pairs of a key less those of equal hash.
    """
    per_key = (
        delta_versions(cur, prev)
        .groupBy(*KEYS)
        .agg(
            F.sum("rows_before").alias("before"),
            F.sum("rows_after").alias("after"),
            F.sum(F.col("rows_before") * F.col("rows_after")).alias("equal_pairs"),
        )
    )
    return per_key.groupBy("table_name").agg(
        F.sum(F.when(F.col("before") == 0, F.col("after")).otherwise(0)).alias("inserts"),
        F.sum(F.col("before") * F.col("after") - F.col("equal_pairs")).alias("updates"),
        F.sum(F.when(F.col("after") == 0, F.col("before")).otherwise(0)).alias("deletes"),
    )


def operation_count(
    events: DataFrame, ref_date: str | dt.date, table_name: str, operation: str
) -> DataFrame:
    """One row: number of events of one kind for a table and day."""
    return events.filter(
        (F.col("ref_date") == as_date(ref_date))
        & (F.col("table_name") == table_name)
        & (F.col("operation_type") == operation)
    ).agg(F.count(F.lit(1)).alias("total"))


def delta_summary(events: DataFrame, ref_date: str | dt.date, table_name: str | None = None) -> DataFrame:
    """Events per operation for one day, and one table if named."""
    rows = events.filter(F.col("ref_date") == as_date(ref_date))
    if table_name is not None:
        rows = rows.filter(F.col("table_name") == table_name)
    return rows.groupBy("operation_type").agg(F.count(F.lit(1)).alias("total"))

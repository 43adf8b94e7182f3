"""Counts, distinct values, deduplication, ordering and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .state import latest_by_key


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def observed_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that fills while an action (such as a write) runs,
    so counting needs no second read: ``observation.get["row_count"]``."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("row_count")), observation


def count_distinct(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_distinct(col).alias(f"{col}_countDistinct"))


def group_count_desc(df: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """Rows per group, most first; equal counts in group order."""
    keys = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), *keys)


def top_groups(df: DataFrame, by: str | Sequence[str], k: int) -> DataFrame:
    return group_count_desc(df, by).limit(k)


def distinct_values(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    names = [cols] if isinstance(cols, str) else list(cols)
    return df.select(*names).distinct()


def sorted_names(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(col)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def deduplicate(df: DataFrame, subset: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per ``subset``: any of them, or the greatest in ``order_by``."""
    if order_by is None:
        return df.dropDuplicates(list(subset))
    return latest_by_key(df, list(subset), list(order_by))


def drop_duplicates_by_hash(
    df: DataFrame, hash_col: str = "row_hash", order_by: Sequence[str] | None = None
) -> DataFrame:
    return deduplicate(df, [hash_col], order_by)


def tables_per_owner(tables: DataFrame) -> DataFrame:
    """Catalog rows and distinct tables of each owner."""
    return tables.groupBy("owner").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("table_name").alias("table_count"),
    )


def reconcile(source: DataFrame, target: DataFrame, sum_cols: Sequence[str]) -> DataFrame:
    """Row count and column totals of both sides: ``metric, source, target, matched``.

    One aggregation over the union of both sides. Pass decimal columns: totals of
    doubles depend on the order of addition.
    """

    def side(df: DataFrame, is_source: bool) -> DataFrame:
        return df.select(F.lit(is_source).alias("is_source"), *sum_cols)

    both = side(source, True).unionByName(side(target, False))
    aggs, entries = [], []
    for metric, value in [("row_count", F.lit(1)), *[(f"{c}_sum", F.col(c)) for c in sum_cols]]:
        for name, wanted in (("source", True), ("target", False)):
            total = F.sum(F.when(F.col("is_source") == wanted, value))
            aggs.append(F.coalesce(total, F.lit(0)).alias(f"{metric}_{name}"))
        # Totals are compared as they are; doubles are for display.
        source, target = F.col(f"{metric}_source"), F.col(f"{metric}_target")
        entries.append(
            F.struct(
                F.lit(metric).alias("metric"),
                source.cast("double").alias("source"),
                target.cast("double").alias("target"),
                (source == target).alias("matched"),
            )
        )
    return both.agg(*aggs).select(F.inline(F.array(*entries)))

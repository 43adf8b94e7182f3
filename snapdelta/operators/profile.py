"""Table profiles: structure, counts and statistics of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import delete_path, new_path
from .aggregates import row_count, sample_rows
from .catalog import list_columns
from .envelope import numeric_columns
from .metrics import mean_of

STATISTICS = ("p50", "mean", "std", "min", "max")


def column_statistics(
    df: DataFrame,
    stats_cols: Sequence[str] | None = None,
    accuracy: int = 10000,
    statistics: Sequence[str] = STATISTICS,
) -> DataFrame:
    """One row with ``row_count`` and ``{c}_p50, {c}_mean, {c}_std, {c}_min, {c}_max``.

    All statistics in one pass. The median is approximate: ``accuracy`` bounds its
    rank error by ``1/accuracy`` and its memory per partition. It costs more than
    the others together, so leave it out of ``statistics`` if it is not needed.
    The deviation is the sample one.
    """
    cols = list(stats_cols) if stats_cols else numeric_columns(df)
    functions = {
        "p50": lambda c: F.percentile_approx(c, 0.5, accuracy),
        "mean": lambda c: mean_of(df, c),
        "std": F.stddev,
        "min": F.min,
        "max": F.max,
    }
    wanted = [functions[s](c).alias(f"{c}_{s}") for s in statistics for c in cols]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *wanted)


def column_statistics_long(
    df: DataFrame,
    stats_cols: Sequence[str] | None = None,
    accuracy: int = 10000,
    statistics: Sequence[str] = STATISTICS,
) -> DataFrame:
    """The same statistics with one row per column, as doubles."""
    cols = list(stats_cols) if stats_cols else numeric_columns(df)
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("row_count"),
            *[F.col(f"{c}_{s}").cast("double").alias(s) for s in statistics],
        )
        for c in cols
    ]
    return column_statistics(df, cols, accuracy, statistics).select(F.inline(F.array(*entries)))


def profile_table(
    df: DataFrame, sample_size: int = 20, stats_cols: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Columns, sample and statistics (with the row count) of a table, all lazy."""
    parts = {
        "columns": list_columns(df),
        "sample": sample_rows(df, sample_size),
        "statistics": row_count(df),
    }
    if stats_cols or numeric_columns(df):
        parts["statistics"] = column_statistics(df, stats_cols)
    return parts


def explore_table(df: DataFrame, sample_size: int = 10) -> dict[str, DataFrame]:
    """Columns, row count and a sample (no rows if the table is empty)."""
    return {"columns": list_columns(df), "row_count": row_count(df), "sample": sample_rows(df, sample_size)}


def exact_median(df: DataFrame, column: str):
    """The value at the middle rank (the lower of two), or None without values. Rows are
    counted per value, values dealt in ranges; only the range that holds the middle is sorted."""
    spark = df.sparkSession
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    path = new_path(spark, "median")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts.repartitionByRange(ranges, "value").withColumn("part", F.spark_partition_id()).write.parquet(path)
    held = spark.read.parquet(path)
    sums = sorted(tuple(r) for r in held.groupBy("part").agg(F.sum("n")).collect())  # a row per range
    middle, value = (sum(n for _, n in sums) + 1) // 2, None
    for part, n in sums:
        if middle <= n:
            upto = F.sum("n").over(Window.orderBy("value"))
            found = held.filter(F.col("part") == part).select("value", upto.alias("upto")).filter(F.col("upto") >= middle)
            value = found.agg(F.min("value")).first()[0]
            break
        middle -= n
    delete_path(spark, path)
    return value

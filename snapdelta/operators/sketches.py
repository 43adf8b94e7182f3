"""Mergeable sketches per day: distinct keys and quantiles of any range of days without a rescan.

A day's sketches are rows of a few kilobytes, whatever the day holds. Stored beside the
daily metrics, they answer for weeks or years by merging them: distinct keys by
HyperLogLog (relative standard error ``1.04 / sqrt(2 ** lg_k)``, 1.6 % at 12), quantiles by KLL (rank error
about ``2.3 / k ** 0.91``, 1.3 % at 300).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
K = 300


def daily_sketches(
    df: DataFrame, by: Sequence[str], distinct: Sequence[str] = (), quantiles: Sequence[str] = (), lg_k: int = LG_K, k: int = K
) -> DataFrame:
    """Rows per group with ``row_count``, ``{c}_hll`` and ``{c}_kll``; each task leaves a sketch per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.hll_sketch_agg(c, lg_k).alias(f"{c}_hll") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(f"{c}_kll") for c in quantiles],
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of several days as one row per group, of the same columns."""
    names = sketches.columns
    return sketches.groupBy(*by).agg(
        F.sum("row_count").alias("row_count"),
        *[F.hll_union_agg(c).alias(c) for c in names if c.endswith("_hll")],
        *[F.kll_merge_agg_double(c).alias(c) for c in names if c.endswith("_kll")],
    )


def read_sketches(merged: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """Figures instead of sketches: ``{c}_distinct`` and ``{c}_p50`` (per quantile)."""
    figures = []
    for c in merged.columns:
        if c.endswith("_hll"):
            figures.append(F.hll_sketch_estimate(c).alias(f"{c.removesuffix('_hll')}_distinct"))
        elif c.endswith("_kll"):
            name = c.removesuffix("_kll")
            figures += [F.kll_sketch_get_quantile_double(c, F.lit(q)).alias(f"{name}_p{round(100 * q)}") for q in quantiles]
        else:
            figures.append(F.col(c))
    return merged.select(*figures)

"""Pages deep inside a sorted table, without sorting up to them in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranges the rows are cut into per pass, and the most rows a page's ranges may hold together (besides the page).
RANGES = 64
MOST = 100_000


def page_ranges(df: DataFrame, order_by: Sequence[str], ranges: int = RANGES) -> list[tuple[int, object, object]]:
    """Rows, first and last key of each of about ``ranges`` ranges in key order; only keys are shuffled."""
    key = F.struct(*order_by)
    cut = df.select(*order_by).repartitionByRange(ranges, *order_by)
    held = cut.groupBy(F.spark_partition_id().alias("range")).agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.max(key).alias("last")
    )
    return [(r["n"], r["first"], r["last"]) for r in held.orderBy("range").collect()]  # a row per range


def read_deep_page(
    df: DataFrame, order_by: Sequence[str], limit: int, offset: int, ranges: int = RANGES, most: int = MOST
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in key order.

    Sums of the rows of key ranges tell in which ranges the page lies, and only these are
    read again; while they hold more than ``most`` rows beside the page, they are cut again.
    So a task sorts ``most`` rows and the page at most (more only if that many rows have one key),
    however deep the page is. Reads the source ``log(rows / most) / log(ranges)`` times
    and once more; with the key of the previous page, ``read_page(after=...)`` reads it once.
    """
    key = F.struct(*order_by)
    while True:
        found = page_ranges(df, order_by, ranges)
        before, chosen = 0, []
        for n, first, last in found:
            if before + n > offset and (not chosen or before < offset + limit):
                if not chosen:
                    skip = offset - before
                chosen.append((n, first, last))
            before += n
        if not chosen or limit <= 0:
            return df.limit(0)
        held = sum(n for n, _, _ in chosen)
        whole = len(chosen) == len(found)
        if not whole:
            low, high = chosen[0][1], chosen[-1][2]
            at = lambda row: F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order_by, row, strict=True)])
            df = df.filter((key >= at(low)) & (key <= at(high)))
            offset = skip
        if held <= most + limit or whole:
            ordered = df.orderBy(*order_by)
            return (ordered.offset(offset) if offset else ordered).limit(limit)

"""Row identity: content hashes, key text and JSON payloads."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

#: JSON with timestamps to the microsecond; Spark's default stops at milliseconds.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
SEPARATOR = "|||"
STAGING_SEPARATOR = "||"


def _columns(cols: Iterable[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def text_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[Column]:
    """Columns of ``df`` as text: nested values become JSON, the rest is cast."""
    names = df.columns if cols is None else cols
    nested = (StructType, ArrayType, MapType)
    return [
        (F.to_json(c, JSON_OPTIONS) if isinstance(df.schema[c].dataType, nested) else F.col(c).cast("string")).alias(c)
        for c in names
    ]


def row_hash(cols: Iterable[str | Column], sep: str = SEPARATOR, null_safe: bool = False) -> Column:
    """SHA-256 over the columns joined by ``sep``.

    ``concat_ws`` skips NULLs, so ``(x, NULL, y)`` and ``(x, y, NULL)`` share a
    hash; ``null_safe`` puts a mask of the NULL positions in front. A separator
    inside the data can still make two rows collide.
    """
    columns = _columns(cols)
    joined = F.concat_ws(sep, *columns)
    if null_safe:
        mask = F.concat(*[F.isnull(c).cast("int").cast("string") for c in columns])
        joined = F.concat(mask, F.lit(sep), joined)
    return F.sha2(joined, 256)


def add_row_hash(df: DataFrame, exclude: Iterable[str] | None = None, hash_col: str = "row_hash") -> DataFrame:
    """SHA-256 of the row as JSON, columns in name order, NULL fields left out."""
    skipped = set(exclude or ())
    names = sorted(c for c in df.columns if c not in skipped)
    return df.withColumn(hash_col, F.sha2(F.to_json(F.struct(*names), JSON_OPTIONS), 256))


def primary_key(cols: Iterable[str | Column], sep: str = SEPARATOR) -> Column:
    return F.concat_ws(sep, *_columns(cols))


def row_json(cols: Iterable[str | Column]) -> Column:
    return F.to_json(F.struct(*_columns(cols)), JSON_OPTIONS)

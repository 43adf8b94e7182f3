"""Row-wise transforms: envelopes, metadata columns, projections and filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_date, load_timestamp, primary_key, row_hash, row_json, text_columns
from ..functions.hashing import STAGING_SEPARATOR

#: Fractions and zones that payloads may have or lack.
PARSE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
}


def to_envelope(
    df: DataFrame,
    table_name: str,
    primary_keys: Sequence[str],
    ref_date: str | dt.date | Column,
    null_safe: bool = False,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Any table as ``snapshot_raw`` rows: key text, content hash, JSON payload.

    A pure projection, so it fuses with the scan. ``ref_date`` may be a column
    when ``df`` holds several days; that column then stays out of the payload.
    """
    day = ref_date if isinstance(ref_date, Column) else as_date(ref_date)
    names = [c for c in df.columns if c != "ref_date"] if isinstance(ref_date, Column) else df.columns
    return df.select(
        day.alias("ref_date"),
        F.lit(table_name).alias("table_name"),
        primary_key(primary_keys).alias("primary_key"),
        row_hash(text_columns(df, names), null_safe=null_safe).alias("row_hash"),
        row_json(names).alias("data"),
        (load_timestamp() if loaded_at is None else loaded_at).alias("ingestion_timestamp"),
    )


def parse_payload(df: DataFrame, schema: str | T.StructType, data_col: str = "data") -> DataFrame:
    """Replace the JSON payload by its typed fields; a field that does not parse is NULL.
    Timestamps may have microseconds, milliseconds or neither."""
    kept = [c for c in df.columns if c != data_col]
    parsed = F.from_json(F.col(data_col), schema, {"mode": "PERMISSIVE", **PARSE_OPTIONS})
    return df.select(*kept, parsed.alias("_payload")).select(*kept, "_payload.*")


def with_ingestion_metadata(
    df: DataFrame, source: str, source_table: str, reference_date: str | dt.date
) -> DataFrame:
    return df.withColumns(
        {
            "_ingestion_timestamp": load_timestamp(),
            "reference_date": as_date(reference_date),
            "_source": F.lit(source),
            "_source_table": F.lit(source_table),
        }
    )


def with_snapshot_hash(df: DataFrame, snapshot_date: str | dt.date, cols: Sequence[str] | None = None) -> DataFrame:
    """Staging columns: snapshot date and a hash over all (or the named) columns as text."""
    names = df.columns if cols is None else list(cols)
    return df.withColumns(
        {
            "snapshot_date": as_date(snapshot_date),
            "record_hash": row_hash(text_columns(df, names), sep=STAGING_SEPARATOR),
        }
    )


def rename_project(df: DataFrame, mapping: Mapping[str, str], loaded_at_col: str | None = None) -> DataFrame:
    """Keep the mapped columns under their new names, plus a load time if named."""
    columns = [F.col(old).alias(new) for old, new in mapping.items()]
    if loaded_at_col:
        columns.append(load_timestamp().alias(loaded_at_col))
    return df.select(*columns)


def has_columns(df: DataFrame, required: Iterable[str]) -> bool:
    """Whether ``df`` has all required columns, ignoring case."""
    return {c.lower() for c in required} <= {c.lower() for c in df.columns}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def for_snapshot(
    df: DataFrame, ref_date: str | dt.date, table_name: str | None = None, date_col: str = "ref_date"
) -> DataFrame:
    """Rows of one day, and of one table if named; prunes partitions on both."""
    rows = df.filter(F.col(date_col) == as_date(ref_date))
    return rows if table_name is None else rows.filter(F.col("table_name") == table_name)


def name_like(df: DataFrame, pattern: str, col: str = "table_name") -> DataFrame:
    """Rows whose name matches a LIKE pattern; the pattern is upper-cased first."""
    return df.filter(F.col(col).like(pattern.upper()))


def name_in(df: DataFrame, names: Sequence[str], negate: bool = False, col: str = "table_name") -> DataFrame:
    listed = F.col(col).isin(*names)
    return df.filter(~listed if negate else listed)

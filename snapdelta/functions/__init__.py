from .hashing import add_row_hash, primary_key, row_hash, row_json, text_columns
from .scalar import (
    as_date,
    clean_strings,
    error_text,
    hash_changed,
    is_blank,
    load_timestamp,
    normalize_case,
    quality_score,
    resolve_ref_date,
    sanitize_name,
    valid_operation,
    with_year_month,
    year_month,
)
from .types import build_schema, cast_to, catalog_type, warehouse_type

__all__ = [
    "add_row_hash",
    "as_date",
    "build_schema",
    "cast_to",
    "catalog_type",
    "clean_strings",
    "error_text",
    "hash_changed",
    "is_blank",
    "load_timestamp",
    "normalize_case",
    "primary_key",
    "quality_score",
    "resolve_ref_date",
    "row_hash",
    "row_json",
    "sanitize_name",
    "text_columns",
    "valid_operation",
    "warehouse_type",
    "with_year_month",
    "year_month",
]

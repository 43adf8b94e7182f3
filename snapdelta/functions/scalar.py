"""Scalar expressions and date helpers."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import OPERATIONS

# Characters replaced in identifiers and what replaces them.
# Only these accents are folded; others stay as they are.
NAME_FROM = " -çéóºáíú"
NAME_TO = "__ceooaiu"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def error_text(e: BaseException) -> str:
    """An exception with its type, whole, also if it has no message."""
    return f"{type(e).__name__}: {e}"


def hash_changed(before: str | Column, after: str | Column) -> Column:
    """NULL-safe inequality of two hashes."""
    return ~_col(before).eqNullSafe(_col(after))


def is_blank(c: str | Column) -> Column:
    c = _col(c)
    return c.isNull() | (c == "")


def clean_strings(df: DataFrame, columns: Iterable[str], trim: bool = True, upper: bool = False) -> DataFrame:
    def cleaned(name: str) -> Column:
        c = F.col(name)
        c = F.trim(c) if trim else c
        return F.upper(c) if upper else c

    return df.withColumns({name: cleaned(name) for name in columns})


def sanitize_name(c: str | Column) -> Column:
    """Lower-case identifier without spaces, hyphens and common accents."""
    return F.translate(F.lower(_col(c)), NAME_FROM, NAME_TO)


def normalize_case(c: str | Column, upper: bool = True) -> Column:
    return F.upper(_col(c)) if upper else F.lower(_col(c))


def as_date(text: str | dt.date | Column) -> Column:
    """ISO text, a Python date or a column as DATE."""
    if isinstance(text, Column):
        return text.cast("date")
    return F.lit(str(text)).cast("date")


def load_timestamp() -> Column:
    return F.current_timestamp()


def year_month(c: str | Column) -> Column:
    """Year and month as a number, e.g. 202403."""
    c = _col(c)
    return F.year(c) * 100 + F.month(c)


def with_year_month(df: DataFrame, date_col: str, name: str = "year_month") -> DataFrame:
    """Adds the month a row is partitioned by."""
    return df.withColumn(name, year_month(date_col))


def quality_score(nulls: str | Column, duplicates: str | Column, total: str | Column) -> Column:
    """Percentage of rows that are neither blank nor duplicate; NULL without rows."""
    bad = (_col(nulls) + _col(duplicates)).cast("double")
    return F.lit(100.0) * (F.lit(1.0) - bad / F.nullif(_col(total), F.lit(0)))


def valid_operation(c: str | Column) -> Column:
    return _col(c).isin(*OPERATIONS)


def resolve_ref_date(token: str | dt.date | None, as_of: str | dt.date) -> dt.date:
    """A reference date: ``D-n`` counts back from ``as_of``, an ISO date stands
    for itself, and None means the day before ``as_of``."""
    base = dt.date.fromisoformat(str(as_of))
    if token is None:
        return base - dt.timedelta(days=1)
    text = str(token).strip()
    relative = re.fullmatch(r"[Dd](?:\s*-\s*(\d+))?", text)
    if relative:
        return base - dt.timedelta(days=int(relative.group(1) or 0))
    return dt.date.fromisoformat(text)

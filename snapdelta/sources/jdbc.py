"""Relational sources over Spark's JDBC reader."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import build_schema, cast_to, error_text

FETCH_SIZE = 10000


@dataclass(frozen=True)
class JdbcSource:
    """Where and as whom to connect; further reader options go in ``options``."""

    spark: SparkSession
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def reader_options(self, **extra) -> dict[str, str]:
        base = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        merged = {**base, **self.options, **extra}
        return {k: str(v) for k, v in merged.items() if v is not None}

    def load(self, **extra) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.reader_options(**extra)).load()


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _subquery(sql: str, alias: str = "src") -> str:
    return f"({sql.strip().rstrip(';')}) {alias}"


def _bound(value) -> str:
    """A column's smallest or largest value as the reader expects a bound."""
    if isinstance(value, (decimal.Decimal, float)):
        return str(int(value))
    if isinstance(value, dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S")
    return str(value)


def partition_bounds(source: JdbcSource, table: str, column: str) -> tuple[str, str] | None:
    """Smallest and largest value of a column, asked of the source as one row."""
    sql = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    lo, hi = source.load(dbtable=_subquery(sql, "bounds")).first()
    return None if lo is None else (_bound(lo), _bound(hi))


def read_table(
    source: JdbcSource,
    table: str,
    schema: str | None = None,
    partition_column: str | None = None,
    num_partitions: int = 1,
    fetch_size: int = FETCH_SIZE,
    lower: str | None = None,
    upper: str | None = None,
) -> DataFrame:
    """A whole table, read in parallel ranges of ``partition_column``.

    The reader needs bounds to form ranges; without them they are asked of the
    source first. They only set the stride, so rows outside are still read.
    """
    name = f"{schema}.{table}" if schema else table
    options = {"dbtable": name, "fetchsize": fetch_size}
    if partition_column and num_partitions > 1:
        if lower is None or upper is None:
            bounds = partition_bounds(source, name, partition_column)
        else:
            bounds = (str(lower), str(upper))
        if bounds is not None:
            options |= {
                "partitionColumn": partition_column,
                "lowerBound": bounds[0],
                "upperBound": bounds[1],
                "numPartitions": num_partitions,
            }
    return source.load(**options)


def read_partitioned(
    source: JdbcSource,
    query: str,
    column: str,
    lower,
    upper,
    num_partitions: int,
    fetch_size: int = FETCH_SIZE,
) -> DataFrame:
    """A query's result, read in parallel ranges of one of its columns."""
    return source.load(
        dbtable=_subquery(query),
        partitionColumn=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=num_partitions,
        fetchsize=fetch_size,
    )


def read_query(source: JdbcSource, sql: str, as_subquery: bool = True, fetch_size: int = FETCH_SIZE) -> DataFrame:
    """Run ``sql`` at the source, as a derived table or through the ``query`` option."""
    if as_subquery:
        return source.load(dbtable=_subquery(sql), fetchsize=fetch_size)
    return source.load(query=sql, fetchsize=fetch_size)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str]) -> DataFrame:
    return spark.read.jdbc(url, table, properties=dict(properties))


def read_declared(source: JdbcSource, query: str, definition: Iterable[Mapping], **ranges) -> DataFrame:
    """A query's result with a declared schema; ``ranges`` as in :func:`read_partitioned`.

    The reader refuses a schema that differs from the source's, so the declared
    one is a cast projection, which still prunes columns at the source.
    """
    df = read_partitioned(source, query, **ranges) if ranges else read_query(source, query)
    return cast_to(df, build_schema(definition))


def list_tables(source: JdbcSource, owner: str, like: str | None = None, catalog: str = "all_tables") -> DataFrame:
    """Table names of one schema, optionally by LIKE pattern, sorted."""
    sql = f"SELECT table_name FROM {catalog} WHERE owner = {_literal(owner.upper())}"
    if like:
        sql += f" AND table_name LIKE {_literal(like.upper())}"
    return _lower_names(read_query(source, sql)).orderBy("table_name")


def list_owners(source: JdbcSource, owners: Sequence[str] | None = None, catalog: str = "all_tables") -> DataFrame:
    """Distinct schema names, all or those listed, sorted."""
    sql = f"SELECT DISTINCT owner FROM {catalog}"
    if owners:
        sql += f" WHERE owner IN ({', '.join(_literal(o.upper()) for o in owners)})"
    return _lower_names(read_query(source, sql)).orderBy("owner")


def table_stats(source: JdbcSource, owner: str, like: str | None = None, catalog: str = "all_tables") -> DataFrame:
    """The source's own statistics: tablespace, row estimate and when it was taken."""
    sql = (
        "SELECT owner, table_name, tablespace_name, num_rows, last_analyzed "
        f"FROM {catalog} WHERE owner = {_literal(owner.upper())}"
    )
    if like:
        sql += f" AND table_name LIKE {_literal(like.upper())}"
    return _lower_names(read_query(source, sql)).orderBy("table_name")


def list_columns(
    source: JdbcSource, owner: str, table: str | None = None, catalog: str = "all_tab_columns"
) -> DataFrame:
    """Columns of one table or of a whole schema, in column order."""
    sql = (
        "SELECT owner, table_name, column_id, column_name, data_type, data_length, "
        f"data_precision, data_scale, nullable FROM {catalog} WHERE owner = {_literal(owner.upper())}"
    )
    if table:
        sql += f" AND table_name = {_literal(table.upper())}"
    return _lower_names(read_query(source, sql)).orderBy("table_name", "column_id")


def probe(source: JdbcSource, sql: str | None = None) -> DataFrame:
    """One row telling whether the source answers: ``reachable, error, checked_at``."""
    error = None
    if sql is None:
        sql = "SELECT 1 AS ok" + (" FROM dual" if source.url.lower().startswith("jdbc:oracle") else "")
    try:
        reachable = not source.load(dbtable=_subquery(sql, "probe")).isEmpty()
    except Exception as e:  # the failure is the result
        reachable, error = False, error_text(e)
    rows = [(source.url, reachable, error)]
    return source.spark.createDataFrame(rows, "url STRING, reachable BOOLEAN, error STRING").withColumn(
        "checked_at", F.current_timestamp()
    )


def _lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])

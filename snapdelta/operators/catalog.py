"""Catalog, coverage, metadata and lineage tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_date
from ..schemas import LINEAGE, TABLE_METADATA, column_names
from .state import latest_by_key

METADATA_KEYS = ["domain", "layer", "name"]

# Defaults of a metadata record.
METADATA_DEFAULTS = {"pii": False, "retention_days": 365}

COLUMNS_SCHEMA = (
    "column_id INT, column_name STRING, data_type STRING, data_length INT, "
    "data_precision INT, data_scale INT, nullable STRING"
)


def list_columns(df: DataFrame, table_name: str | None = None) -> DataFrame:
    """Columns of a table in order, from its schema alone."""

    def row(i: int, f: T.StructField) -> tuple:
        sized = isinstance(f.dataType, T.DecimalType)
        return (
            i,
            f.name,
            f.dataType.simpleString(),
            None,
            f.dataType.precision if sized else None,
            f.dataType.scale if sized else None,
            "Y" if f.nullable else "N",
        )

    rows = [row(i, f) for i, f in enumerate(df.schema.fields, start=1)]
    columns = df.sparkSession.createDataFrame(rows, COLUMNS_SCHEMA)
    if table_name is None:
        return columns
    return columns.select(F.lit(table_name).alias("table_name"), "*")


def table_counts(tables: Mapping[str, DataFrame], owner: str, analyzed_at: Column | None = None) -> DataFrame:
    """``owner, table_name, num_rows, last_analyzed`` for several tables in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(owner).alias("owner"), F.lit(name).alias("table_name"), "num_rows"
        )
        for name, df in sorted(tables.items())
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.withColumn("last_analyzed", F.current_timestamp() if analyzed_at is None else analyzed_at)


def missing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` lacks. Copies combine before the join."""
    return left.distinct().subtract(right.distinct())


def coverage(source: DataFrame, target: DataFrame, name_col: str = "table_name") -> DataFrame:
    """Names on one side only: ``missing`` in the target or ``extra`` in it.

    One aggregation of both sides; repeated names combine on the map side.
    """

    def side(df: DataFrame, in_source: bool) -> DataFrame:
        return df.select(F.col(name_col), F.lit(in_source).alias("s"), F.lit(not in_source).alias("t"))

    flags = (
        side(source, True)
        .unionByName(side(target, False))
        .groupBy(name_col)
        .agg(F.bool_or("s").alias("s"), F.bool_or("t").alias("t"))
    )
    return flags.filter(F.col("s") != F.col("t")).select(
        name_col, F.when(F.col("s"), "missing").otherwise("extra").alias("status")
    )


def register_table(metadata: DataFrame, records: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Upsert metadata records by domain, layer and name.

    The newest record wins; the earliest creation time of a table is kept.
    """
    stamp = F.current_timestamp() if updated_at is None else updated_at
    new = records.withColumns(
        {
            **{c: F.coalesce(F.col(c), F.lit(v)) for c, v in METADATA_DEFAULTS.items()},
            "updated_at": stamp,
            "created_at": F.coalesce("created_at", stamp),
        }
    )
    columns = column_names(TABLE_METADATA)
    rows = metadata.select(*columns, F.lit(0).alias("_new")).unionByName(
        new.select(*columns, F.lit(1).alias("_new"))
    )
    others = [c for c in columns if c not in (*METADATA_KEYS, "created_at", "updated_at")]
    return (
        rows.groupBy(*METADATA_KEYS)
        .agg(
            F.max(F.struct("updated_at", "_new", *others)).alias("_row"),
            F.min("created_at").alias("created_at"),
        )
        .select(*[F.col(c) if c in (*METADATA_KEYS, "created_at") else F.col(f"_row.{c}") for c in columns])
    )


def table_metadata(metadata: DataFrame, domain: str, layer: str, name: str) -> DataFrame:
    return metadata.filter((F.col("domain") == domain) & (F.col("layer") == layer) & (F.col("name") == name))


def generate_catalog(metadata: DataFrame, as_of: str | dt.date) -> DataFrame:
    """The newest record of every table as known at the end of ``as_of``."""
    known = metadata.filter(F.col("updated_at") < F.date_add(as_date(as_of), 1).cast("timestamp"))
    return latest_by_key(known, METADATA_KEYS, ["updated_at"]).withColumn("generated_for", as_date(as_of))


def register_lineage(lineage: DataFrame, edges: DataFrame) -> DataFrame:
    columns = column_names(LINEAGE)
    return lineage.select(*columns).unionByName(edges.select(*columns))


def lineage_of(lineage: DataFrame, table: str) -> DataFrame:
    """Edges where the table is the source or the target."""
    return lineage.filter((F.col("source_table") == table) | (F.col("target_table") == table))


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)

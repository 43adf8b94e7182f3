"""Table definitions: session catalog tables and warehouse DDL text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import catalog_type, sanitize_name, warehouse_type
from ..functions.types import CATALOG_TYPES
from ..schemas import MEDALLION, STORED_BY

# The text of a generated bronze table around its own columns.
BRONZE_DDL_HEAD = "CREATE TABLE IF NOT EXISTS "
BRONZE_DDL_TAIL = """,
    _ingestion_timestamp DateTime DEFAULT now(),
    reference_date Date,
    _source String,
    _source_table String,
    row_hash String
)
ENGINE = MergeTree()
PARTITION BY toYYYYMM(reference_date)
ORDER BY (reference_date, row_hash)
SETTINGS index_granularity = 8192;
"""


def create_tables(spark: SparkSession, layer: str, prefix: str = "", base: str | None = None) -> list[str]:
    """Create a layer's database and tables if absent; returns the table names.

    Partitions are those that the jobs write, and the order they sort by is the property
    ``sort_by``. With the jobs' ``base`` the tables lie over their folders and show all that is
    stored there (of ``current_state`` every version; ``read_state`` gives that of a day);
    run ``MSCK REPAIR TABLE`` after a job to add its partitions.
    """
    database = f"{prefix}{layer}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for table, (columns, order) in MEDALLION[layer].items():
        stored_by = STORED_BY.get(table, "ref_date")
        if stored_by.startswith("version"):
            columns = f"{columns}, version STRING"
        where = f"LOCATION '{base.rstrip('/')}/{layer}/{table}'" if base else ""
        names.append(f"{database}.{table}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {names[-1]} ({columns}) USING parquet PARTITIONED BY ({stored_by}) {where} "
            f"TBLPROPERTIES ('sort_by' = '{', '.join(order)}')"
        )
    return names


def schema_to_ddl(
    schema: T.StructType,
    table: str,
    order_by: Sequence[str],
    partition_by: str = "snapshot_date",
) -> str:
    """Warehouse DDL of a staging table: the schema's columns, then snapshot date
    and record hash."""
    columns = [f"{f.name} {warehouse_type(f.dataType)}" for f in schema.fields]
    columns += ["snapshot_date Date", "record_hash FixedString(64)"]
    return (
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) ENGINE = MergeTree "
        f"PARTITION BY {partition_by} ORDER BY ({','.join(order_by)}) SETTINGS index_granularity = 8192"
    )


def schema_to_spark_ddl(schema: T.StructType, table: str, partition_by: Sequence[str] = ("snapshot_date",)) -> str:
    """The same table for the session catalog."""
    columns = [f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields]
    columns += ["snapshot_date DATE", "record_hash STRING"]
    return (
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) "
        f"USING parquet PARTITIONED BY ({', '.join(partition_by)})"
    )


def catalog_to_ddl(
    columns: DataFrame,
    type_map: Mapping[str, str] = CATALOG_TYPES,
    database: str = "bronze",
    sized_types: bool = False,
) -> DataFrame:
    """DDL text of every table in a source catalog, in one job.

    ``columns`` has ``owner, table_name, column_id, column_name, data_type``. A
    group is the columns of one table, which the source's column limit bounds.
    """
    line = F.concat(
        F.lit("    "), sanitize_name("column_name"), F.lit(" "), catalog_type("data_type", type_map, sized_types)
    )
    target = F.concat(F.lower("owner"), F.lit("_"), F.lower("table_name"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("column_id", "line"))), lambda c: c["line"])
    body = F.array_join(lines, ",\n")
    return (
        columns.filter(F.col("column_name").isNotNull() & F.col("data_type").isNotNull())
        .withColumn("line", line)
        .groupBy("owner", "table_name")
        .agg(body.alias("body"))
        .select(
            "owner",
            "table_name",
            target.alias("target_table"),
            F.concat(
                F.lit(f"{BRONZE_DDL_HEAD}{database}."), target, F.lit("\n(\n"), F.col("body"), F.lit(BRONZE_DDL_TAIL)
            ).alias("ddl"),
        )
    )

"""Tables stored by the hash of their key: one sorted file per bucket.

Two of them with equal keys and bucket numbers join without moving or sorting a row, and
a digest per bucket tells which files need not be read at all. The digest is a count
and a sum of row hashes, so it does not depend on the order of rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import column_names
from ..session import CODEC
from .versions import list_names

BUCKETS = 64
DIGESTS = "table_name STRING, bucket INT, copies BIGINT, rows BIGINT, digest DECIMAL(38,0)"
#: A bucket's single file is sorted; Spark only counts on it if told to look.
ORDERING = "spark.sql.legacy.bucketedTableScan.outputOrdering"
FILE_BUCKET = re.compile(r"_(\d+)(?:\..*)?$")


def bucket_of(keys: Sequence[str], n: int) -> Column:
    """The bucket a row is stored in."""
    return F.pmod(F.hash(*keys), F.lit(n))


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], n: int) -> None:
    """Write ``df`` in ``n`` buckets of ``keys``, each a file sorted by them. Rows should be
    unique by key: those of one key share a file."""
    spark, name = df.sparkSession, f"buckets_{uuid.uuid4().hex}"
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).options(path=path, compression=CODEC).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay


def read_buckets(
    spark: SparkSession, path: str, columns: str, keys: Sequence[str], n: int, only: Sequence[int] | None = None
) -> DataFrame:
    """A table of :func:`write_buckets`; with ``only``, the files of these buckets."""
    spark.conf.set(ORDERING, "true")
    name = f"buckets_{hashlib.md5(path.encode()).hexdigest()}"
    by = ", ".join(keys)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {n} BUCKETS LOCATION '{path}'"
    )
    df = spark.table(name)
    if only is None:
        return df
    wanted = set(only)
    files = [f for f in list_names(spark, path) if (m := FILE_BUCKET.search(f)) and int(m[1]) in wanted]
    return df.filter(F.col("_metadata.file_name").isin(files)).select(*column_names(columns)) if files else df.limit(0)


def digests(index: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Rows and digest of every bucket and table of a key index."""
    row = F.xxhash64(*keys, "row_hash").cast("decimal(38,0)")
    return index.groupBy("table_name", bucket_of(keys, n).alias("bucket")).agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"), F.sum(row).alias("digest")
    )


def changed_buckets(after: DataFrame, before: DataFrame, tables: Sequence[str]) -> list[int]:
    """Buckets in which any of the tables differs between two sets of digests."""
    sides = [
        d.filter(F.col("table_name").isin(*tables)).select("table_name", "bucket", F.struct("rows", "digest").alias(name))
        for d, name in ((after, "after"), (before, "before"))
    ]
    both = sides[0].join(sides[1], ["table_name", "bucket"], "full_outer")
    differ = both.filter(~F.col("after").eqNullSafe(F.col("before"))).select("bucket").distinct()
    return sorted(r["bucket"] for r in differ.collect())  # at most n

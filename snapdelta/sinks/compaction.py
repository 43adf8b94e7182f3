"""Appended metrics whose repeats do not count twice, and whose small files become one.

A run's rows of a partition are written under its own id: repeating the run replaces them.
Compaction collapses all runs of a partition into one folder and notes which runs it took in;
from then on a repeat of such a run is recognised and adds nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path
from .layers import overwrite_partition
from .versions import drop_unnamed, drop_versions, list_names, next_name, read_version, version_names, write_version

RUN = "run_id="


def _partition(path: str, partition: str) -> str:
    return f"{path.rstrip('/')}/{partition}"


def append_run(df: DataFrame, path: str, partition: str, run_id: str) -> bool:
    """Write one run's rows of a partition; False if a compaction already took that run in."""
    if not run_id or "/" in run_id:
        raise ValueError("a run id is a file name")
    where = _partition(path, partition)
    version = read_version(df.sparkSession, where)
    if version and run_id in version["runs"]:
        return False
    overwrite_partition(df, where, {"run_id": run_id})
    return True


def _open_runs(spark: SparkSession, where: str, version: dict | None) -> list[str]:
    taken = set(version["runs"]) if version else set()
    return [n for n in list_names(spark, where) if n.startswith(RUN) and n.removeprefix(RUN) not in taken]


def read_runs_of(spark: SparkSession, path: str, partition: str, schema: str) -> DataFrame:
    """Rows of a partition: those compacted, and those of the runs since."""
    where = _partition(path, partition)
    version = read_version(spark, where)
    paths = [f"{where}/{n}" for n in _open_runs(spark, where, version)]
    paths += [f"{where}/{version['folder']}"] if version else []
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def compact_partition(
    spark: SparkSession, path: str, partition: str, schema: str, collapse: Callable[[DataFrame], DataFrame]
) -> int:
    """Collapse a partition's runs (``collapse_sum`` or ``collapse_latest`` over its keys) into one
    folder; returns how many runs it took in. A compaction that dies changes nothing."""
    where = _partition(path, partition)
    version = read_version(spark, where)
    runs = _open_runs(spark, where, version)
    if runs:
        folder = f"version={uuid.uuid4().hex}"
        collapse(read_runs_of(spark, path, partition, schema)).coalesce(1).write.parquet(f"{where}/{folder}")
        taken = sorted({*(version["runs"] if version else []), *[n.removeprefix(RUN) for n in runs]})
        write_version(spark, where, next_name(spark, where), {"folder": folder, "runs": taken})
        version = {"folder": folder, "runs": taken}
    if version:  # also what an earlier compaction had no time to remove
        for name in list_names(spark, where):
            if name.startswith(RUN) and name.removeprefix(RUN) in set(version["runs"]):
                delete_path(spark, f"{where}/{name}")
        drop_versions(spark, where, version_names(spark, where)[:-1])
        drop_unnamed(spark, where, [version["folder"]])
    return len(runs)

"""Versions of a stored table: a small file names the folders a version is made of.

Folders are written first and never changed; a version counts once its file has its
name, which is one rename. So a table's partitions change together or not at all, what
did not change is named again instead of copied, and a run that dies leaves folders that no
version names. One writer per table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from typing import Any

from pyspark.sql import SparkSession

from ..session import path_exists

FOLDER = "_versions"


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    if not path_exists(spark, path):
        return []
    fs, target = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target))


def version_names(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of the table at ``path``, oldest first."""
    names = list_names(spark, f"{path.rstrip('/')}/{FOLDER}")
    return [n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith((".", "_"))]


def read_version(spark: SparkSession, path: str, name: str | None = None) -> dict[str, Any] | None:
    """Content of a version (the newest if not named); None if there is none."""
    if name is None:
        names = version_names(spark, path)
        if not names:
            return None
        name = names[-1]
    fs, target = _fs(spark, f"{path.rstrip('/')}/{FOLDER}/{name}.json")
    stream = fs.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_version(spark: SparkSession, path: str, name: str, content: dict[str, Any]) -> None:
    """Commit a version; names sort by age. A name that exists stays as it is: an error."""
    folder = f"{path.rstrip('/')}/{FOLDER}"
    fs, beside = _fs(spark, f"{folder}/.new-{uuid.uuid4().hex}")
    stream = fs.create(beside)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    target = _fs(spark, f"{folder}/{name}.json")[1]
    if fs.exists(target) or not fs.rename(beside, target):
        fs.delete(beside, False)
        raise OSError(f"version {name} of {path} could not be committed")


def next_name(spark: SparkSession, path: str, label: str = "") -> str:
    """A name after all others of this label; labels (such as days) sort before the counter."""
    own = [n for n in version_names(spark, path) if n.rpartition("-")[0] == label]
    last = int(own[-1].rpartition("-")[2]) if own else -1
    return f"{label}-{last + 1:09d}"


def drop_versions(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    """Forget versions; their folders stay until :func:`drop_unnamed`."""
    for name in names:
        fs, target = _fs(spark, f"{path.rstrip('/')}/{FOLDER}/{name}.json")
        fs.delete(target, False)


def drop_unnamed(spark: SparkSession, path: str, named: Iterable[str], prefix: str = "version=") -> list[str]:
    """Delete the version folders below ``path`` that no one names; returns them."""
    keep = set(named)
    gone = [n for n in list_names(spark, path) if n.startswith(prefix) and n not in keep]
    for name in gone:
        fs, target = _fs(spark, f"{path.rstrip('/')}/{name}")
        fs.delete(target, True)
    return gone

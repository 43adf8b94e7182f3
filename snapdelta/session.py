"""Session defaults and the shared folder used for staging."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# No master, memory or shuffle-partition setting: those belong to the cluster,
# and AQE sizes shuffles at run time.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: Codec of stored rows. Half of an envelope is its hash as hexadecimal text, which snappy leaves at its
#: full length and zstd's entropy coding brings to half.
CODEC = "zstd"

_local_dirs: dict[str, str] = {}


def get_session(
    app_name: str = "snapdelta",
    broadcast_threshold: int | str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the library's defaults.

    ``broadcast_threshold`` (bytes, or a size such as ``"64m"``) is the largest
    side Catalyst may broadcast; it compares it with the measured size of the
    side, so no operator here forces a broadcast with a hint.
    """
    settings = {**DEFAULTS, **(conf or {})}
    if broadcast_threshold is not None:
        settings["spark.sql.autoBroadcastJoinThreshold"] = str(broadcast_threshold)
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in
    ``spark.checkpoint.dir``. Only a local master may fall back to a temporary
    folder of this machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="snapdelta-")
    return _local_dirs[app]


class RunScope:
    """Owns the paths that :func:`new_path` gives while it is open, and removes what lies there when
    it is closed: on success and on failure, so nothing staged outlives its run.

    A result that still reads staged rows keeps its scope open: leave it with
    :meth:`detach`, and :meth:`close` it when the result is used up.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> RunScope:
        _scopes.append(self)
        return self

    def __exit__(self, kind, *_) -> None:
        if self in _scopes:  # not detached
            _scopes.remove(self)
            self.close()

    def detach(self) -> RunScope:
        """Take no further paths; those taken stay until :meth:`close`."""
        _scopes.remove(self)
        return self

    def close(self) -> None:
        while self.paths:
            delete_path(self.spark, self.paths.pop())


_scopes: list[RunScope] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, owned by the innermost open :class:`RunScope`."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].paths.append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a finished folder to ``target``, instead of what is there."""
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(old.getParent())
    fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"{source} could not be moved to {target}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staged result that is no longer read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

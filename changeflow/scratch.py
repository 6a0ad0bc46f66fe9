"""Places in the cluster's shared folder, and size checks on plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Inputs below this many bytes (by the optimizer's own statistics) fit one task comfortably.
SMALL_INPUT_BYTES = 64 * 1024 * 1024
# Largest table, by the same statistics, that is sent to every executor on request.
BROADCAST_BYTES = 32 * 1024 * 1024

_local_dirs: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; in local mode a fresh one when it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="changeflow-")
    return _local_dirs[app]


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder; ``clear`` removes it."""
    path = f"{shared_dir(spark)}/changeflow/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear(spark: SparkSession) -> int:
    """Delete the tables this session has written to the shared folder, and return their number.

    Call it when no result that reads from them is used any more.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove(spark, path)
    return len(paths)


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a DataFrame in bytes; no job is run."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small(df: DataFrame, limit: int = SMALL_INPUT_BYTES) -> bool:
    return plan_bytes(df) <= limit


def exists(spark: SparkSession, path: str) -> bool:
    return _folder(spark, path)[0].exists(_folder(spark, path)[1])


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when the folder does not exist."""
    fs, folder = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote."""
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder

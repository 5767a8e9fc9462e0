"""Intermediate tables in the folder that all machines of a cluster share.

A staged table cuts lineage: a lost executor costs the tasks it was running,
never the stages before them.  Files go to ``spark.checkpoint.dir``; only a
local session without that setting gets a temporary folder of its own.  Tables that
are still there when the driver's process ends are deleted then.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
_STAGED: dict[str, SparkSession] = {}


@atexit.register
def _clean() -> None:
    for path, spark in _STAGED.items():
        with contextlib.suppress(Exception):  # the JVM may have ended before
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session, without a trailing slash."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="zonekeep-")
        atexit.register(shutil.rmtree, _LOCAL_ROOTS[app], ignore_errors=True)
    return f"file://{_LOCAL_ROOTS[app]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and return a scan of the files."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _STAGED[path] = spark
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def scratch(spark: SparkSession, label: str) -> str:
    """A folder for files that are not tables, deleted like staged tables."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _STAGED[path] = spark
    return path


def discard(df: DataFrame | None) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    path = getattr(df, "_staged_at", None)
    if path:
        _delete(df.sparkSession, path)
        _STAGED.pop(path, None)

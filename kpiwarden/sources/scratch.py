"""Where multi-step jobs keep tables between their steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession


#: Set to true where a local or file: path is a mount that all executors share.
SHARED = "spark.kpiwarden.scratch.shared"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_TRIED: dict[tuple[str, str], bool] = {}


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path in the shared folder named by ``spark.checkpoint.dir``.

    Where that is not set, a local master, with which driver and executors are one process,
    takes a temporary folder, and a cluster the folder of its warehouse. On a cluster of
    several machines a local folder is taken if ``SHARED`` says that it is a common mount,
    or if tasks and driver see in it what other tasks wrote; the local file system counts
    as the default if Hadoop's configuration says so.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    one_process = master == "local" or master.startswith("local[")
    if not base and one_process:
        base = Path(tempfile.mkdtemp(prefix="kpiwarden-")).as_uri()
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = f"{warehouse.rstrip('/')}/kpiwarden-scratch"
    if not master.startswith("local"):
        root = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        scheme = urlsplit(base).scheme or urlsplit(root).scheme
        told = spark.conf.get(SHARED, "false").lower() == "true"
        if scheme == "file" and not told and not _seen_by_all(spark, base):
            raise ValueError(f"{base} is a local folder; if all executors share it, set {SHARED}")
    return _unused(base, purpose)


def _unused(base: str, purpose: str) -> str:
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _seen_by_all(spark: SparkSession, base: str) -> bool:
    """Whether tasks on all cores, and the driver, find in the folder what other tasks wrote there; tried once."""
    try:
        key = (spark.sparkContext.applicationId, base)
        if key not in _TRIED:
            tasks, path = 2 * spark.sparkContext.defaultParallelism, _unused(base, "seen-by-all")
            _TRIED[key] = False
            spark.range(0, tasks, 1, tasks).write.parquet(path)
            _TRIED[key] = spark.read.parquet(path).where("id >= 0").count() == tasks
            _delete(spark, path)
        return _TRIED[key]
    except Exception:  # whatever fails here, the folder cannot be used
        return False


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Have Spark remove the shuffle files of each job when it ends, not when the driver happens to drop its plan."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, computed once, written to scratch and read from there.

    Spark knows the size of what it reads back and can choose joins by it. The shuffles
    behind the rows are not needed again.
    """
    path = scratch_path(df.sparkSession, purpose)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._scratch_path = path
    return found


def removed(df: DataFrame | None) -> None:
    """Delete what ``stored`` wrote, once nothing can read it any more."""
    if df is not None:
        _delete(df.sparkSession, df._scratch_path)


def exists(spark: SparkSession, path: str) -> bool:
    system, there = _file_system(spark, path)
    return system.exists(there)


def _delete(spark: SparkSession, path: str) -> None:
    system, there = _file_system(spark, path)
    system.delete(there, True)


def _file_system(spark: SparkSession, path: str) -> tuple:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), there

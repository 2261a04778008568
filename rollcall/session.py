"""Session helpers.

``build_session`` is for tests and the bench (local mode).  On a cluster the
session comes from the launcher; library code only reads its settings.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import threading
from collections.abc import Iterator

from pyspark.sql import SparkSession

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING = threading.RLock()
_freeing = {"depth": 0, "before": None}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rollcall") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    parts = shuffle_partitions or int(os.environ.get("ROLLCALL_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ROLLCALL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset in local mode (tests) a scratch folder
    is created and set.  Elsewhere a folder of the driver's own disk would be of no use to the executors.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="rollcall-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes begun inside leave no shuffle files behind: Spark removes a query's shuffles when its write has ended, where it
    would else keep them until the driver happens to collect its garbage.  What was written is read from its files from then on."""
    with _FREEING:
        if not _freeing["depth"]:
            _freeing["before"] = spark.conf.get(_FREE_SHUFFLES, None)
            spark.conf.set(_FREE_SHUFFLES, "true")
        _freeing["depth"] += 1
    try:
        yield
    finally:
        with _FREEING:
            _freeing["depth"] -= 1
            if not _freeing["depth"]:
                if _freeing["before"] is None:
                    spark.conf.unset(_FREE_SHUFFLES)
                else:
                    spark.conf.set(_FREE_SHUFFLES, _freeing["before"])


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder written by this library that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time) of what a folder of any store holds, by name."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found)

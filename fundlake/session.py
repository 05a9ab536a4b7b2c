"""Session defaults, lineage cuts and shared scratch folders."""

from __future__ import annotations

import shutil
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "fundlake", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every plan here assumes (UTC dates, AQE on)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession, folder: str) -> str:
    """Bring this package to executors that do not have it installed: a zip in ``folder``, added to the session's files."""
    archive = shutil.make_archive(f"{folder.rstrip('/')}/fundlake", "zip", Path(__file__).parent.parent, "fundlake")
    spark.sparkContext.addPyFile(archive)
    return archive


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """One setting of the session, put back at the end."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def brief_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, a query's shuffle files are deleted when it ends.

    Otherwise they stay until the driver's memory is next collected, which on a large heap is after the whole run. A
    DataFrame that is run a second time shuffles anew.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, one in the warehouse.

    Both are reachable by every executor. The choice is made once for a context.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` reliably, so later uses neither recompute it nor disagree."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's part of the shared folder."""
    return f"{shared_folder(spark)}/scratch/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application put below ``scratch_path``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/scratch")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", memory: str = "12g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash rows over the session's shuffle partitions, before work that multiplies them."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a session in one process (``local`` or ``local[n]``), such as a test's, may
    fall back to a temporary folder of its own; ``local-cluster`` may not.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever reused or overwritten."""
    app = spark.sparkContext.applicationId
    return os.path.join(shared_folder(spark), "tidemark", app, f"{label}-{uuid.uuid4().hex[:12]}")


# Options of large tables of ids: whole numbers are written as differences, which for ordered ids take hardly a bit.
COMPACT = {"parquet.writer.version": "v2", "compression": "zstd"}


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a columnar table that survives the loss of any
    executor, so several consumers read it instead of recomputing it.
    """
    path = new_folder(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete everything this application has staged. Results that still read it must have been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(shared_folder(spark), "tidemark", spark.sparkContext.applicationId))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_VERSION = "_version="


def versions(spark: SparkSession, path: str) -> list[int]:
    """The finished versions below ``path``: folders ``_version=n`` whose write was committed."""
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    folders = [f.getPath() for f in fs.listStatus(base) if f.getPath().getName().startswith(_VERSION)]
    done = [f for f in folders if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted(int(f.getName()[len(_VERSION) :]) for f in done)


def next_version(spark: SparkSession, path: str) -> str:
    """A folder above all begun ones, finished or not, for the next version."""
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    begun = [f.getPath().getName() for f in fs.listStatus(base)] if fs.exists(base) else []
    return f"{path}/{_VERSION}{max([0, *(int(n[len(_VERSION) :]) for n in begun if n.startswith(_VERSION))]) + 1}"


def write_version(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a new version below ``path`` and read it back.

    Spark marks a folder when its write is committed, and readers take the last
    marked one. Older versions stay, so a table may be rebuilt from itself and a
    write that dies leaves the last version in place.
    """
    folder = next_version(df.sparkSession, path)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def read_version(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{_VERSION}{versions(spark, path)[-1]}")


def stage_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage tables that do not read one another, their jobs side by side."""
    with ThreadPoolExecutor(max_workers=max(1, min(8, len(tables)))) as pool:
        return dict(zip(tables, pool.map(lambda name: stage(tables[name], name), tables)))

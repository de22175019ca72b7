"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(app: str = "panelweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only where unset."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc._jsc.sc().getCheckpointDir()
    if not root and current.isDefined():
        root = current.get()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="panelweave-")
    if not current.isDefined():
        sc.setCheckpointDir(root)
    return root


_made: dict[tuple[str, str], str] = {}


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme of the file system it lies in, so that what is no Spark reader opens the same place."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def run_folder(spark: SparkSession) -> str:
    """This application's own folder under the shared one, as a full URI; it goes when the driver's JVM ends."""
    key = shared_folder(spark), spark.sparkContext.applicationId
    if key not in _made:
        folder = qualified(spark, "/".join(key))
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _made[key] = folder
    return _made[key]


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Each job's shuffle files go when it ends, not when the driver's collector finds its plan: for steps that stage what they keep."""
    was = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, was)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    Cuts lineage in a way that survives executor loss, fixes any
    order-dependent choice made upstream, and gives Catalyst the true file
    size, so a later join broadcasts it only when it really is small.
    """
    path = f"{run_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete what ``stage`` wrote for ``df``, which no later step may read."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if folder.rpartition("/")[2].startswith("stage-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

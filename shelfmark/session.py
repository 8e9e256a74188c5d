"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from functools import cache

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(app_name: str = "shelfmark", **conf: str) -> SparkSession:
    """Get or create a session. The master and the memory are the deployment's choice."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {"spark.sql.adaptive.enabled": "true", **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session, where all tasks see the same disk, may go without the setting.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"Set {CHECKPOINT_CONF} to a folder that all executors can reach.")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="shelfmark-")


@cache
def _scratch_dir(spark_id: str, folder: str) -> str:
    """The application's own folder, which goes with it: tables that a lazy result still reads can't
    be deleted before."""
    spark = SparkSession.active()
    path = f"{folder}/shelfmark-{spark_id}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)
    return path


def scratch_dir(spark: SparkSession) -> str:
    """Where :func:`scratch_path` puts its paths; deleted when the application ends."""
    return _scratch_dir(spark.sparkContext.applicationId, shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders, wherever they are; what isn't there is passed over."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, by Spark's writer."""
    row = spark.range(1, numPartitions=1).select(F.lit(text).alias("value"))
    row.write.mode("overwrite").text(path)


def read_note(spark: SparkSession, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.text(path).collect())

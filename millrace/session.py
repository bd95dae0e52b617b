"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution does the run-time work this library relies on: it turns a join into a broadcast join
# only when the measured side is small, splits skewed join partitions and sizes shuffle partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a temporary folder; on a cluster a missing setting is an error,
    because a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses. It is scratch: it goes when the session's driver ends."""
    root = f"{shared_dir(spark)}/millrace/{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(at)
    files.deleteOnExit(at)
    return f"{root}/{name}"

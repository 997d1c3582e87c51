"""Intermediate tables on shared storage.

A staged table replaces lineage: it survives the loss of executors, is read
back column by column, and every reader sees the same rows. It goes to the
folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from portolan.sinks.writers import write_parquet


@functools.cache
def _local_root(application_id: str) -> str:
    folder = tempfile.mkdtemp(prefix="portolan-stage-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables.

    The cluster's setting is taken as it is; a ``file:`` folder there has to be
    mounted on all machines. Without it only a local session, where driver and
    executors are one process, may fall back to a temporary folder, which is
    deleted when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/") + "/portolan"
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _local_root(context.applicationId)


class Staging:
    """A fresh folder below the staging root, owned by one run."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.folder = f"{root or staging_root(spark)}/{uuid.uuid4().hex}"

    def path(self, label: str) -> str:
        """A path not used before."""
        return f"{self.folder}/{label}-{uuid.uuid4().hex[:8]}"

    def write(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` once and return the stored table."""
        path = self.path(label)
        write_parquet(df, path)
        # The schema is known, so no footer has to be read to infer it.
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete this run's folder; frames returned by ``write`` end here."""
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.folder)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        target.getFileSystem(conf).delete(target, True)

"""Session construction and shared scratch locations.

Scratch data (lake writes in examples, lineage cuts) lives under the cluster-wide
``spark.checkpoint.dir``. Where that is not set, a session on a local master (tests, laptops) gets a
folder of its own, removed when the process ends; on a cluster that is an error.
"""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # reliable checkpoints (lineage cuts) are removed once their data is unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "martline", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster. Only on a local master, where one is not set, a folder of this
    machine is taken; on a cluster executors couldn't see it, so there the setting is required."""
    root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="martline-checkpoints-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(root)
    return (spark.sparkContext.getCheckpointDir() or root).rstrip("/")


_KEPT: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint folder, in a folder of the application's own that the driver deletes when
    it ends (what a killed driver leaves is there by its application's id)."""
    own = f"{checkpoint_root(spark)}/martline/{spark.sparkContext.applicationId}"
    if own not in _KEPT:
        _KEPT.add(own)
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder (of a scratch path that nothing reads any more); none is no error."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffles' files when they end; otherwise Spark keeps them until the driver collects its
    garbage, so those of many steps lie on the disks together. A frame that runs twice inside writes its shuffles twice."""
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if was is None else spark.conf.set(SHUFFLE_CLEANUP, was)

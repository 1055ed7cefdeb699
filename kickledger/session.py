"""Session defaults and the shared folder that writes and checkpoints go to.

Every write the library makes lands under the folder the cluster names in
``spark.checkpoint.dir`` (a shared file system on a real cluster), never in
a machine-local temporary folder. Only a local-mode session without that
setting, as in tests, gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning: AQE coalesces tiny shuffle partitions, converts a
# sort-merge join to a broadcast join when the measured side is small, and
# splits skewed join partitions (a hot club or league holding a third of all
# rows). Timestamps are compared as UTC so results match the SQL oracle.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app_name: str = "kickledger",
                  extra: dict | None = None, scratch: str | None = None) -> SparkSession:
    """A session for local runs and tests; ``scratch`` names the shared folder (``spark.checkpoint.dir``)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    if scratch:
        conf["spark.checkpoint.dir"] = scratch
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where it is unset.

    On a cluster the folder must come from ``spark.checkpoint.dir``; a missing
    setting is an error there, because a local temporary folder would not be
    visible to the other machines.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        configured = tempfile.mkdtemp(prefix="kickledger-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/kickledger/{name}-{uuid.uuid4().hex[:12]}"


def expire(spark: SparkSession, hours: float, folder: str | None = None) -> list[str]:
    """Delete what this library stored under the shared folder and nobody changed for ``hours``; returns the names.

    Only its own folder ``<shared>/kickledger`` is looked at (or ``folder``).
    Run it when no job that may still read those frames is running.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/kickledger")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    oldest = (time.time() - hours * 3600) * 1000
    gone = []
    for status in fs.listStatus(root) if fs.exists(root) else []:
        if status.getModificationTime() < oldest:
            fs.delete(status.getPath(), True)
            gone.append(status.getPath().getName())
    return sorted(gone)


def together(*steps: Callable[[], object]) -> list:
    """Results of steps that need nothing of each other, each run by a thread of its own.

    Their jobs share the cluster: tasks of one take the cores that the last
    tasks of another, or its planning and commit, leave idle. All steps run
    to their end; then the first error, in the order given, is raised.
    """
    session = SparkSession.getActiveSession()
    inherit = inheritable_thread_target(session) if session else (lambda step: step)
    with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
        running = [pool.submit(inherit(step)) for step in steps]
    return [step.result() for step in running]


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Compute ``df`` once into a Parquet table in the shared folder and read it back.

    For small frames that several parts of one plan read (the league x
    month rollup of a report): the plan above it scans the stored rows
    instead of recomputing them per use. The files outlive a lost executor,
    unlike a cache or a local checkpoint, and one job both computes and
    stores the rows (an eager ``checkpoint()`` of an unpersisted frame
    computes it twice). Each call leaves one small folder under the shared
    checkpoint folder; the returned DataFrame reads it lazily, so it is not
    removed here; ``expire`` clears them by age.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

"""Session construction, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Spark's setting that removes a query's shuffle files as soon as the query has ended.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings every plan in this package relies on. AQE stays on so join strategy, partition coalescing and
# skew splitting are decided from measured shuffle sizes, not from guesses made here.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "tessera",
                extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the package defaults.

    On a cluster ``master`` stays None and the launcher's settings win; locally pass e.g. ``local[8]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # Local mode runs every task inside the driver JVM: give it a real heap (the default is 1 GiB).
        conf["spark.driver.memory"] = "16g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, name: str = "") -> str:
    """A fresh folder under the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The setting is read from the session. Where it is unset, a folder is created and registered if the master is
    local; on a cluster that raises, since each machine would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    # One folder per application: everything a run wrote can be removed together once the run is over.
    app = spark.sparkContext.applicationId
    return os.path.join(base, f"tessera-{app}", f"{name or 'tmp'}-{uuid.uuid4().hex[:12]}")


def cleanup(spark: SparkSession) -> bool:
    """Remove what this application has written to its scratch folder: lineage cuts and stored tables. Call it once
    results that read them have been written. Returns whether there was anything."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        return False
    folder = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(base, f"tessera-{spark.sparkContext.applicationId}"))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df, spark: SparkSession | None = None):
    """Cut the lineage of ``df``: write it once as a Parquet table in the shared checkpoint folder and read it
    back (never a local checkpoint, never a machine-local folder on a cluster).

    A written table costs one pass over the plan; ``DataFrame.checkpoint`` would run the plan twice (once for
    the action, once more to write the checkpoint) unless the frame were also cached. A task that is lost
    later re-reads the table instead of recomputing the plan from the raw sources.

    The shuffle files of the write go when it has ended: nothing reads them any more, and a run of many cuts would
    keep them all on the executors' disks until the driver happens to collect garbage.
    """
    spark = spark or df.sparkSession
    path = scratch_dir(spark, "table")
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)
    return spark.read.parquet(path)

"""Session helpers: builder defaults, session pinning and the shared scratch root.

All engine time is UTC (the wire contract carries UTC epoch millis), so every entry
point pins ``spark.sql.session.timeZone`` to UTC. Scratch space for stream
checkpoints, upsert logs and lineage cuts lives under the cluster-wide
``spark.checkpoint.dir``; a local temporary folder is only created when that
setting is absent (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small inputs still spread over the cores (only matters below ~1 MB per core)
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # RocksDB keeps streaming window/increment state off the JVM heap, which matters
    # once the symbol set (state keys) grows.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app_name: str = "quotebars",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the engine relies on (UTC time zone)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def is_local(spark: SparkSession) -> bool:
    """True when driver and tasks share one machine (``local``, ``local[N]``)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    A local temporary folder stands in only when the setting is unset *and* the master is
    local; on a cluster every executor would write to its own disk, so that raises."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="quotebars-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # a core setting may be read-only at runtime
            pass
    # keep RDD/DataFrame.checkpoint() pointed at the same place
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the checkpoint root for one run of one job."""
    root = checkpoint_root(spark)
    path = f"{root}/quotebars/{purpose}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors once per application, so that Python
    workers can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quotebars-src-"), "quotebars_src.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)

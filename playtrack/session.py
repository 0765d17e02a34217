"""Session defaults and the shared scratch folder.

All scratch output (CSV round trips, written intermediate tables) goes under
the folder the cluster names in ``spark.checkpoint.dir``.  Only when that
setting is absent in local mode (tests) is a private folder created and registered.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this library expects.  AQE re-plans joins from measured
# shuffle sizes (a broadcast happens only when a side is proven small at run
# time) and splits skewed join partitions; partial aggregation is Spark's
# default for every groupBy.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Local mode: the driver JVM is the only executor; ignored on a cluster
    # once the driver is running.
    "spark.driver.memory": "16g",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "playtrack", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Only in local mode, where all executors share the machine, is a private
    folder registered when the setting is unset; a cluster must name one.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if configured is None:
            if not sc.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="playtrack-ckpt-")
        sc.setCheckpointDir(configured)
    return configured or sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, removed when the driver ends."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "playtrack-scratch", f"{label}-{uuid.uuid4().hex}")
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    _REMOVED_AT_END.append((store, place))
    if len(_REMOVED_AT_END) == 1:
        atexit.register(_remove_scratch)
    return path


_REMOVED_AT_END: list = []


def _remove_scratch() -> None:
    """At the driver's end, while its JVM still answers: delete what this process wrote."""
    from py4j.protocol import Py4JError

    for store, place in _REMOVED_AT_END:
        try:
            store.delete(place, True)
        except (Py4JError, OSError):         # the session was closed first
            return

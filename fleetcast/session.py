"""Session construction and cluster-facing settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every fleetcast job relies on.  UTC keeps timestamp arithmetic
# identical on every executor; AQE re-plans shuffles and splits skewed joins.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files (cut lineage) are deleted once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "fleetcast", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with fleetcast's settings.

    On a cluster, ``master`` stays None and the launcher decides.  Tests pass
    ``local[N]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when none is set.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    always wins.  Only unconfigured local sessions (unit tests) get a fresh local
    folder; on a cluster that names none, this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="fleetcast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, for tables a job writes and reads back."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/fleetcast-{name}-{uuid.uuid4().hex[:12]}"

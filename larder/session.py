"""Session helpers.

The library never creates a session of its own inside an operator; these
helpers exist for tests, the bench and command-line use.  On a cluster the
caller's session is used as is: only settings that are unset get a default.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE is what turns the
# data-dependent small sides (peer-group statistics, bucket offsets) into
# broadcast joins at run time, *after* their real size is known, and what
# splits skewed join partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "larder") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LARDER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", None)
    if master is None:
        try:
            master = spark.sparkContext.master
        except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext
            master = ""
    return str(master).startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; a cluster session without one is an error, since a folder on one
    machine would be lost with that machine.  Only a local-mode session
    without one (tests, the bench) gets a fresh scratch folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext, conf only
        sc = None
    sc_dir = sc.getCheckpointDir() if sc is not None else None
    if sc_dir:
        return sc_dir
    if conf_dir:
        if sc is not None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: staged tables and "
                           "stream checkpoints are written there")
    local_dir = tempfile.mkdtemp(prefix="larder-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local_dir)
    if sc is not None:
        sc.setCheckpointDir(local_dir)
    return local_dir

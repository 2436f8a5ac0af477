"""Spark session helpers.

The library never creates a session behind the caller's back: every public
function takes a ``SparkSession`` or a DataFrame.  ``local_session`` is for
tests, the bench and the smoke entry point only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every query in the package relies on.  They are runtime SQL
# settings, so ``ensure_conf`` can apply them to a session the caller built.
_REQUIRED_CONF = {
    # Dates are derived from timestamp columns; pin the zone so a date is the
    # same on every executor and in the oracle.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    for key, value in _REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "basinflow") -> SparkSession:
    """Session for tests and the bench (``local[cores]``, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.default.parallelism", str(cores))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python call-site capture for error messages costs ~0.7 s of driver
        # time per flagship plan; off for tests and the bench.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in _REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder and
    is used as is; running without it is an error there, since a driver-local
    folder is invisible to executors.  Only a local session (tests, the bench)
    gets a fresh scratch folder when the setting is unset.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or S3)")
        current = tempfile.mkdtemp(prefix="basinflow-ckpt-",
                                   dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current

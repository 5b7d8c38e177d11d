"""Session settings the plans rely on, and the shared folder for written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"

# AQE coalesces and splits shuffle partitions at run time, so the static number only has to be large enough: it is the
# upper bound on reducers. Raise it with the data (about one per 200 MB of shuffle). UTC keeps timestamps comparable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str = "starledger", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above; ``conf`` adds to them and wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path for a table that several executors write and read; it goes when the session ends.

    It lies in the folder set by ``SparkContext.setCheckpointDir``, else in the one the cluster names in
    ``spark.checkpoint.dir``. A local session with neither keeps it in its warehouse. On a cluster that would be a folder
    of each machine's own, so there one of the two has to be set.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
        root = f"{spark.conf.get(WAREHOUSE_DIR)}/_shared"
    folder = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder

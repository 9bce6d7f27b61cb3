"""Session helpers for tests, the bench and local runs.

Library functions never create a session; they receive DataFrames. This
module is only for entry points that need one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins from runtime sizes
# (size-checked broadcast with a sort-merge fallback) and splits skewed
# join partitions; UTC because raw timestamps carry no zone.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fieldlake") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("FIELDLAKE_DRIVER_MEM", "16g"))
               .config("spark.driver.host", "127.0.0.1")
               .config("spark.driver.bindAddress", "127.0.0.1"))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder, setting a scratch one only when
    the session has none (local tests). On a cluster the shared folder named
    by ``spark.checkpoint.dir`` is used as is."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="fieldlake-ckpt-")  # unset: local runs and tests only
        path = sc._jvm.org.apache.hadoop.fs.Path(current)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


_scratch: dict[str, str] = {}  # application -> its scratch folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint folder (shared on a cluster), in one
    of this application that is deleted when it ends."""
    import uuid
    sc = spark.sparkContext
    if sc.applicationId not in _scratch:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fieldlake-{sc.applicationId}-{uuid.uuid4().hex[:8]}"
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _scratch[sc.applicationId] = root
    return f"{_scratch[sc.applicationId]}/{name}-{uuid.uuid4().hex[:12]}"

"""Session helpers: a local builder for tests/bench, and the shared scratch folder.

On a cluster the session is built by the caller; the library only reads
``spark.checkpoint.dir`` from it. A default is set only when that setting is
absent (local tests), never overriding what the cluster names.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "canonix") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        current = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
        if not current:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            # Local tests and bench.
            current = tempfile.mkdtemp(prefix="canonix-ckpt-")
            spark.conf.set(_CHECKPOINT_KEY, current)
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/canonix-scratch/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem, so it works for any shared store."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def hadoop_list(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(path, is_file) for the direct children of a folder (driver-side listing of names only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    return [(st.getPath().toString(), st.isFile()) for st in fs.listStatus(p)]


def basename(path: str) -> str:
    return os.path.basename(path.rstrip("/"))

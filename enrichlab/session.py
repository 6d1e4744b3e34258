"""Session helpers: the few settings every plan relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library needs for correct results; applied at runtime if absent.
REQUIRED_CONF = {
    # every timestamp rule (text parsing, hour lags, formatting) is defined in UTC
    "spark.sql.session.timeZone": "UTC",
}

# Settings that shape the physical plan at scale.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "enrichlab") -> SparkSession:
    """A local session for tests and the bench (a cluster passes its own session, whose
    ``spark.checkpoint.dir`` names the shared folder)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ENRICHLAB_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="enrichlab-ckpt-"))
    )
    for k, v in {**REQUIRED_CONF, **SCALE_CONF}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.  Where none is set, a local session
    gets a scratch folder; on a cluster that is an error, since executors share no local disk."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="enrichlab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def folder_state(spark: SparkSession, path: str) -> tuple:
    """Name, length and time of every entry of a folder, whatever store it is in."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    entries = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    return tuple(sorted((e.getPath().getName(), e.getLen(), e.getModificationTime()) for e in entries))


def forget_at_exit(spark: SparkSession, path: str) -> None:
    """Have an intermediate folder deleted when the application ends, whatever store it is in."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)


def materialize(df, how: str = "table"):
    """Materialize an intermediate that several branches / jobs read.

    ``table`` (default): write it as parquet under the shared checkpoint folder and read it
    back - computed once, lineage cut, survives lost executors, holds no executor memory.
    ``persist``: cache it (the caller must ``unpersist``).  ``none``: recompute per use."""
    if how == "table":
        import uuid

        spark = df.sparkSession
        path = f"{checkpoint_dir(spark).rstrip('/')}/enrichlab-{uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(path)
        forget_at_exit(spark, path)
        return spark.read.parquet(path)
    if how == "persist":
        return df.persist()
    return df


#: Large fits, groups of trees of a large forest, or models to score that run side by side.
SIDE_BY_SIDE = 4


def side_by_side(spark: SparkSession, run, items) -> list:
    """``run`` of every item, some at a time: small jobs of different items share the cluster."""
    if len(items) < 2:
        return [run(i) for i in items]
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    with ThreadPool(min(SIDE_BY_SIDE, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(run), items, chunksize=1)

"""Session construction and the shared scratch folder.

Scratch output (written tables, stream checkpoints, lineage cuts) always goes
below the folder the cluster names in ``spark.checkpoint.dir``. Where that is
unset it goes below the warehouse folder, which executors share as well; never
into a machine's own temporary folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins from runtime sizes (so a
# join side is broadcast only after Spark has measured it), coalesces small
# shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "ballotbox") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for scratch output."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"{warehouse.rstrip('/')}/_scratch"
    return root.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and the path in it, as Spark's readers resolve it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_folder(spark: SparkSession, path: str, sizes: bool = False) -> list[tuple]:
    """(name, full path, is a folder[, bytes]) of what lies directly below ``path``
    (of ``path`` itself if it is a file); empty if there is nothing."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), s.getPath().toString(), s.isDirectory(), *([s.getLen()] if sizes else []))
                  for s in fs.listStatus(p))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/ballotbox/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Takes a folder away, if there is one: scratch output that nothing reads any more."""
    fs, p = file_system(spark, path)
    if fs.exists(p):
        fs.delete(p, True)

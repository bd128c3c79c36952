"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where one machine runs all, as in tests, an unset one gets a folder of that machine."""
    path, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not path and master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (path or "file://" + tempfile.mkdtemp(prefix="stallwatch-")).rstrip("/")


def remove(spark: SparkSession, folder: str) -> None:
    """Removes a folder, in whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

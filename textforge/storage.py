"""Cutting lineage with tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDER: list[str] = []


def shared_folder(spark: SparkSession) -> str | None:
    """The folder named by spark.checkpoint.dir; a temporary one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        return None
    if not _LOCAL_FOLDER:
        _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="textforge-"))
        atexit.register(shutil.rmtree, _LOCAL_FOLDER[0], ignore_errors=True)
    return _LOCAL_FOLDER[0]


def materialize(df: DataFrame) -> DataFrame:
    """Write df once and read it back, so several consumers share one evaluation.

    A Parquet table keeps column pruning and statistics, and survives lost executors.
    A cluster must name a shared folder: without one every consumer would evaluate the plan anew.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{folder.rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that materialize wrote and that nothing reads any more."""
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        if folder.rpartition("/")[2].startswith("stage-"):
            context = df.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Repartition an input of fewer partitions than cores; larger inputs stay as scanned.

    The scan cuts files into 128 MB parts, so this only moves data that is small for the cluster.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)

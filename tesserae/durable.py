"""Cutting lineage, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Where none is set, one is made for a local master; on a cluster that is an
    error, as no folder of one machine would do."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """``df``, written to the shared folder, without its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder through the file system that Spark itself uses for it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def forget(*frames: DataFrame) -> None:
    """Remove the files that ``durable`` wrote for ``frames``. Only for frames that nothing reads any more, lazily defined frames included."""
    for df in frames:
        place = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if place.isDefined():
            remove_folder(df.sparkSession, place.get())

"""Folders that driver and executors share, and tables as streams."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for checkpoints and tables of a run, under ``spark.checkpoint.dir``; only local runs without it use a temporary one."""
    context = spark.sparkContext
    base = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tallyflow-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of a folder, a Parquet file or a folder of such, as a stream of its files."""
    path = f"{folder}/{name}.parquet"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return reader.parquet(path) if files.getFileStatus(place).isDirectory() else reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def drained(writer, checkpoint: str) -> None:
    """Runs a stream's writer over what is there, to the end."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

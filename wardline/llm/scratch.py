"""Written tables and cut lineage in the folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The shared folder. A folder of its own is made only where none is set and Spark is local."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="wardline-shared-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends at the files."""
    folder = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

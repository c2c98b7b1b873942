"""Session settings and shared-folder checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast on request only below this number of short rows.
BROADCAST_ROWS = 500_000
# Removes a query's shuffle files when it ends; else they stay until the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def builder(app: str = "wardline") -> SparkSession.Builder:
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # the sequence models build long expressions; tracing each one's call site is slow
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Times are zone-less; truncation to the hour passes through the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; make a temporary one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="wardline-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise to the checkpoint folder, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_dropped() -> Iterator[None]:
    """Queries made and ended meanwhile leave no shuffle files; what is used later must be written or cached."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def written(df: DataFrame) -> DataFrame:
    """As :func:`cut_lineage`, but packed, for large tables that are read often; :func:`dropped` removes it."""
    ensure_checkpoint_dir(df.sparkSession)
    folder = f"{df.sparkSession.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def dropped(table: DataFrame) -> None:
    """Removes the files of a table from :func:`written`, which nothing may read any more."""
    jvm = table.sparkSession._jvm
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table of known length when it is short, else leave the join to the planner."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

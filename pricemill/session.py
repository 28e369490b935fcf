"""Session settings the operators rely on, and reliable lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

Keep = Callable[[DataFrame], DataFrame]

# Runtime-settable only.  Broadcasts are left to the size check that Catalyst and AQE make against
# spark.sql.autoBroadcastJoinThreshold: no operator carries a broadcast hint.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where an aggregation on the same key follows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Without one, executors could not read what the others wrote; only a local master, whose threads share one machine,
    gets a temporary folder instead.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder once and read it back afterwards.

    For a frame that several later branches read: it is computed once and, unlike a cached block,
    survives the loss of the executors that computed it.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of writes that are run inside are deleted when the write ends.

    Else they stay on the disks until the driver happens to collect its garbage.  A write plans its frame anew, so that nothing
    reads these files again.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def write_out(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read it back afterwards.

    As `cut_lineage`, for lines: files hold a fraction of the bytes of checkpointed rows, branches read only their columns, and
    later joins know the size.  Neither the order of rows nor their partitions are kept.  The shuffle files of the write go with it.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same_frame(df: DataFrame) -> DataFrame:
    """No cut: the frame as it is."""
    return df

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Set for every session this package builds itself. A session handed in by the
# caller keeps its own settings, except those the results depend on.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even when that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # An overflow is an error, never a wrapped sum.
    "spark.sql.ansi.enabled": "true",
}
# For a write, whose exchanges nothing reads again: their files go when it has ended, not when
# the driver next collects its memory, so that the disk holds those of one write at a time.
# Not for a frame that a caller may run again: that would have to be exchanged anew.
ONE_USE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Ranges and groups that an exchange makes at most. The adaptive planner merges small
# ones but splits none, so this has to grow with the data: rows over it fit one task.
EXCHANGE_PARTITIONS = "2000"


def build_session(
    app: str = "demandloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings above; ``master`` stays with spark-submit if None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    parts = str(shuffle_partitions or EXCHANGE_PARTITIONS)
    builder = builder.config("spark.sql.shuffle.partitions", parts)
    for key, value in {**SCALE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on in a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    return spark


@contextmanager
def settings(spark: SparkSession, given: Mapping[str, str]) -> Iterator[None]:
    """The session with other settings for as long as a write takes."""
    before = {key: spark.conf.get(key, None) for key in given}
    for key, value in given.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors both see, from ``spark.checkpoint.dir``.

    Only a session in one process without that setting gets a temporary folder; on
    a cluster an unset folder is an error, since a machine-local one would be lost
    with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="demandloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage the way a checkpoint does (a lost executor re-reads files
    instead of re-running the plan) and, unlike a checkpoint, lets every later
    use prune columns and push filters into the scan.
    """
    path = scratch_path(df.sparkSession, label)
    with settings(df.sparkSession, ONE_USE):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

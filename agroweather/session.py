"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
# A table by days has thousands of folders; as many tasks to list them cost more than the listing.
LISTING_TASKS = 64


def build_session(
    app_name: str = "agroweather",
    *,
    master: str | None = None,
    initial_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with adaptive execution on.

    ``initial_partitions`` is the number of shuffle partitions adaptive
    execution starts from before it merges small ones; on a cluster take about
    input bytes / 128 MiB, so that no partition outgrows executor memory.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TARGET_PARTITION_BYTES))
        .config("spark.sql.files.maxPartitionBytes", str(TARGET_PARTITION_BYTES))
    )
    if master:
        builder = builder.master(master)
    if initial_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(initial_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def configure(spark: SparkSession) -> SparkSession:
    """Settings a session may get after it was started.

    Load stamps are UTC instants, so the session has to render them in UTC. The
    folders of a table are listed by a few tasks, not by one task a folder; a session
    that asks for fewer keeps its number.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    spark.conf.set(listing, str(min(int(spark.conf.get(listing)), LISTING_TASKS)))
    return spark


def scratch_path(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A fresh folder for intermediate tables, on storage every executor can reach.

    The cluster names that storage in ``spark.checkpoint.dir``, a caller may name
    another. Only a local session may fall back to a temporary folder of the
    machine. A finished run may delete its folders with :func:`remove_folder`.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a shared folder for intermediate tables")
        root = os.path.join(tempfile.gettempdir(), "agroweather-scratch")
    return f"{root.rstrip('/')}/agroweather/{name}-{uuid.uuid4().hex}"


def file_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in the storage that the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables once its readers are done."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

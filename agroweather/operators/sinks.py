"""Writers of the lake layers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agroweather.operators.probes import high_watermark
from agroweather.operators.publish import (
    REPLACE_PARTITIONS,
    REPLACE_TABLE,
    discard,
    incoming,
    publish,
    recover,
)
from agroweather.schemas import INGEST_STAMP, required_columns
from agroweather.sources.lake import is_committed, read_table


# Columns looked up by value, with the number of values a file may hold: their Bloom filters
# tell which files of a partition split over many can hold a value. Where a file repeats
# its values, Parquet stores their dictionary instead, which serves the same purpose.
LOOKED_UP = {"fips": 4096}


class RequiredFieldError(ValueError):
    """A required column holds NULLs."""


def write_beside(
    df: DataFrame,
    path: str,
    partition_by: str,
    cluster_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Hive-partitioned Parquet in the table's ``incoming`` folder, to be published or discarded.

    Rows within a file are ordered by ``cluster_by``; those of these columns that are
    ``LOOKED_UP`` get Bloom filters. Rebalancing brings a
    partition value together in one file where it is small and lets adaptive
    execution split it over tasks where it is large, so that one huge day does
    not end in one task. A frame read from files already laid out by
    ``partition_by`` needs no such shuffle (``rebalance=False``). The overwrite
    mode is set on the writer because the session default would decide otherwise.
    """
    recover(df.sparkSession, path)
    placed = df.hint("rebalance", F.col(partition_by)) if rebalance else df
    filters = {
        option: value
        for name, values in LOOKED_UP.items()
        if name in cluster_by
        for option, value in (
            (f"parquet.bloom.filter.enabled#{name}", "true"),
            (f"parquet.bloom.filter.expected.ndv#{name}", str(values)),
        )
    }
    (
        placed.sortWithinPartitions(partition_by, *cluster_by)
        .write.options(**filters)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(partition_by)
        .parquet(incoming(path))
    )


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: str,
    cluster_by: Sequence[str] = (),
    replace: str = REPLACE_TABLE,
    rebalance: bool = True,
    drop: Sequence[str] = (),
) -> None:
    """A partitioned table written beside its place (:func:`write_beside`) and published.

    ``replace="table"`` replaces everything, also with an empty frame;
    ``replace="partitions"`` replaces exactly the partitions present in ``df``
    and deletes those named in ``drop`` (as ``column=value``), unless no write of
    the table was finished before. Until the new files are complete the old
    table stays as it is; what an interruption cuts off, the next write finishes.
    """
    spark = df.sparkSession
    write_beside(df, path, partition_by, cluster_by, rebalance)
    if not is_committed(spark, path):
        replace = REPLACE_TABLE  # nothing finished is there to keep
    publish(spark, path, replace, drop)


def write_table(df: DataFrame, path: str) -> None:
    """A table without partitions, written beside its place and swapped in."""
    spark = df.sparkSession
    recover(spark, path)
    df.write.mode("overwrite").parquet(incoming(path))
    publish(spark, path)


def land_bronze(df: DataFrame, path: str, partition_by: str) -> None:
    """Replace the landed files of a source, one folder per partition value.

    An empty frame clears the folder and lands nothing.
    """
    write_partitioned(df, path, partition_by)


def _null_totals(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(name).isNull()).alias(name) for name in columns]


def _refuse_nulls(totals: dict, columns: Sequence[str]) -> None:
    found = {name: totals[name] for name in columns if totals[name]}
    if found:
        raise RequiredFieldError(f"NULLs in required columns: {found}")


def require_not_null(df: DataFrame, columns: Sequence[str]) -> int:
    """Raise when a required column holds a NULL; otherwise the row count.

    One pass that reads those columns only.
    """
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), *_null_totals(columns)).head()
    _refuse_nulls(totals.asDict(), columns)
    return totals["n_rows"]


def log_load(spark: SparkSession, path: str, n_rows: int, latest: datetime | None, replace: str) -> None:
    """Note a finished load: its rows and its greatest stamp.

    A load that replaces the table starts the log anew, others add to it.
    """
    row = spark.range(1).select(
        F.lit(n_rows).cast("long").alias("n_rows"), F.lit(latest).cast("timestamp").alias("latest")
    )
    if replace == REPLACE_TABLE:
        write_table(row, path)
    else:
        recover(spark, path)
        row.write.mode("append").parquet(path)


def load_raw(
    spark: SparkSession,
    bronze_path: str,
    raw_path: str,
    schema: StructType,
    *,
    partition_by: str,
    cluster_by: Sequence[str],
    replace: str = REPLACE_TABLE,
    log_path: str | None = None,
) -> int:
    """Bronze files to the raw table under its explicit schema; returns the row count.

    Bronze is read once: rows, required NULLs and the greatest stamp are observed
    while the new files are written beside the table. A failing gate discards
    them, so the old table stays readable as it was; so it does without bronze
    rows. Bronze is laid out by the same column, so the load is a map-only job
    that orders the rows of each file. ``log_path`` names the load log.
    """
    required = required_columns(schema)
    bronze = read_table(spark, bronze_path, schema)
    seen = Observation()
    totals = [F.count(F.lit(1)).alias("n_rows"), F.max(INGEST_STAMP).alias("latest"), *_null_totals(required)]
    write_beside(bronze.observe(seen, *totals), raw_path, partition_by, cluster_by, rebalance=False)
    found = seen.get
    try:
        _refuse_nulls(found, required)
        if not found["n_rows"]:
            raise FileNotFoundError(f"no bronze rows under {bronze_path}")
    except (RequiredFieldError, FileNotFoundError):
        discard(spark, raw_path)
        raise
    if not is_committed(spark, raw_path):
        replace = REPLACE_TABLE
    publish(spark, raw_path, replace)
    if log_path:
        log_load(spark, log_path, found["n_rows"], found["latest"], replace)
    return found["n_rows"]


def refresh_from_watermark(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    *,
    watermark: str,
    cluster_by: Sequence[str],
    rebalance: bool = True,
) -> None:
    """Incremental table: replace the partitions from the greatest loaded value on.

    The first build takes everything. Later builds recompute the rows at or
    after the greatest ``watermark`` in the table and replace exactly the
    partitions present in that result; earlier partitions are never touched. A
    finished but empty table has no greatest value and stays empty; what an
    interrupted first build left behind is built anew. A refresh that was cut off
    between two partitions is finished before the greatest value is taken, so
    the days it had not yet moved are not passed over.

    The greatest value is read to the driver first (one value), so the write
    does not read the table it replaces and the filter prunes the scan.
    """
    recover(spark, path)
    if not is_committed(spark, path):
        write_partitioned(source, path, watermark, cluster_by, rebalance=rebalance)
        return
    latest = high_watermark(spark, path, watermark)
    if latest is None:
        return
    write_partitioned(
        source.filter(F.col(watermark) >= F.lit(latest)),
        path,
        watermark,
        cluster_by,
        REPLACE_PARTITIONS,
        rebalance,
    )

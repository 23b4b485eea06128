"""Helpers shared by the text operators."""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agroweather.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back.

    Cuts the lineage: what is read is committed output, so a lost executor
    costs no recomputation and a second reader sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


Model = TypeVar("Model")


def shared_model(spark: SparkSession, model: Model) -> Callable[[], Model]:
    """Broadcast a model together with its class; workers call the result to get it.

    A plain broadcast names the class by its module, which executors need not have.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(model))
    return lambda: pickle.loads(packed.value)


def free_name(taken: list[str], name: str) -> str:
    """``name``, lengthened until no column of ``taken`` has it, whatever the case of letters."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name += "_"
    return name


def set_aside(docs: DataFrame, helpers: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns that are named like a helper renamed, and how to name them back."""
    back: dict[str, str] = {}
    for name in docs.columns:
        if name.lower() in helpers:
            back[free_name([*docs.columns, *helpers, *back], name)] = name
    return docs.withColumnsRenamed({old: new for new, old in back.items()}), back


def fold(doc_id: Column, parts: int) -> Column:
    """Remainder of the CRC-32 of the id's decimal text; NULL for a NULL id."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(parts))


def in_fold(doc_id: object, parts: int, part: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == part


def bounded_sample(rows: DataFrame, group: str, rows_each: int, bytes_each: int) -> DataFrame:
    """Rows ``group, order, text`` for fitting a model: the smallest ``order`` of each group first.

    A group gives at most ``rows_each`` texts of ``bytes_each`` together; a text
    over a 64th of that is not taken, so a few long texts cannot fill the driver.
    Rows of one group and order are one, the smallest text. Sizes are ranked, not texts.
    """
    one = stored(rows.groupBy(group, "order").agg(F.min("text").alias("text")), "sample")
    first = Window.partitionBy(group).orderBy("order")
    taken = (
        one.select(group, "order", F.octet_length("text").cast("long").alias("size"))
        .where(F.coalesce("size", F.lit(0)) <= bytes_each // 64)
        .select(group, "order", F.row_number().over(first).alias("place"), F.sum("size").over(first).alias("size"))
        .where((F.col("place") <= rows_each) & (F.coalesce("size", F.lit(0)) <= bytes_each))
    )
    return one.join(taken.select(group, "order"), [group, "order"])


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut to about ``size`` bytes each, one row at least.

    A worker turns one slice at a time into Python objects, so its memory does
    not grow with the length of the texts beyond the longest one.
    """
    for batch in batches:
        rows = max(1, int(batch.num_rows * size / max(batch.nbytes, size)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts(batch: pa.RecordBatch, index: int) -> list[str]:
    """A text column as strings, NULL as the empty string."""
    return [value or "" for value in batch.column(index).to_pylist()]

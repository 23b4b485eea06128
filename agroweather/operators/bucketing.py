"""Tables stored by buckets of their join key, so that joins on it need no shuffle.

Spark keeps the bucket layout of a table in its catalog, not in the files, so such
a table has a name beside its folder; another session declares it again with
:func:`bucketed_table`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def bucket_count(stored_bytes: int, bucket_bytes: int) -> int:
    """Buckets of about ``bucket_bytes``; a power of two, so that tables of two counts still meet."""
    return 1 << max(0, (max(1, -(-stored_bytes // bucket_bytes)) - 1).bit_length())


def bucketed_table(
    spark: SparkSession, name: str, path: str, schema: StructType, keys: Sequence[str], buckets: int
) -> DataFrame:
    """The bucketed table in the folder ``path``, declared under ``name`` if the catalog lacks it."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
        by = ", ".join(f"`{key}`" for key in keys)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
            f"INTO {int(buckets)} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Replace the bucketed table ``name`` in the folder ``path`` by ``df`` and return it.

    Rows are placed by the hash that names the buckets before they are written, so
    each bucket is one file and a read of it one task.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)

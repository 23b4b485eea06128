"""Where the layers live, and how a table is read back under its contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from agroweather.session import file_exists


@dataclass(frozen=True)
class Lake:
    """Parquet layers under one root folder."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def bronze(self, table: str) -> str:
        return self.path("bronze", table)

    def raw(self, table: str) -> str:
        return self.path("raw", table)

    def loads(self, table: str) -> str:
        """The log of finished loads of a raw table."""
        return self.path("loads", table)

    def staging(self, table: str) -> str:
        return self.path("staging", table)

    def mart(self, table: str) -> str:
        return self.path("marts", table)


def read_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Table in contract order and types.

    The schema is given, not discovered: an empty table stays readable, and a
    partition column gets its contract type and place instead of the inferred
    type at the end.
    """
    found = spark.read.schema(schema).parquet(path)
    return found if isinstance(schema, str) else found.select(*schema.names)


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether a write of the table has been finished.

    A whole-table write leaves its marker last and removes the old one first,
    so a folder without it is what an interrupted write left behind.
    """
    return file_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def table_or_none(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame | None:
    """The table, or None where no write has been finished yet."""
    return read_table(spark, path, schema) if is_committed(spark, path) else None

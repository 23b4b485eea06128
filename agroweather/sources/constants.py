"""Small relations written in the code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def constant_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """A few given rows as literals of the plan, so that the planner knows they are small."""
    structs = [
        F.struct(
            *[
                F.lit(value).cast(field.dataType).alias(field.name)
                for value, field in zip(row, schema.fields, strict=True)
            ]
        )
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs))).select(*schema.names)

"""Group ordered points into request batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BATCH_SIZE = 50


def _with_position(points: DataFrame) -> DataFrame:
    """Zero-based position of each point in ``fips`` order.

    One global row number would sort the whole table in one task. Instead rows
    are counted per county code; running sums within a state (up to 1,000 codes)
    and over the states (two characters) give every code its first position.
    Points without a code come first.
    """
    per_code = (
        points.groupBy("fips")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("state", F.substring("fips", 1, 2))
    )
    earlier = (Window.unboundedPreceding, -1)
    in_state = Window.partitionBy("state").orderBy("fips").rowsBetween(*earlier)
    over_states = Window.orderBy("state").rowsBetween(*earlier)

    state_starts = (
        per_code.groupBy("state")
        .agg(F.sum("n").alias("n"))
        .select("state", F.coalesce(F.sum("n").over(over_states), F.lit(0)).alias("state_start"))
    )
    code_starts = (
        per_code.withColumn("in_state", F.coalesce(F.sum("n").over(in_state), F.lit(0)))
        .join(
            state_starts.withColumnRenamed("state", "of_state"),
            F.col("state").eqNullSafe(F.col("of_state")),
        )
        .select(F.col("fips").alias("code"), (F.col("state_start") + F.col("in_state")).alias("start"))
    )
    in_code = Window.partitionBy("fips").orderBy("lat", "lon")
    return (
        points.select("fips", "lat", "lon")
        .withColumn("rank", F.row_number().over(in_code) - 1)
        .join(code_starts, F.col("fips").eqNullSafe(F.col("code")))
        .select("fips", "lat", "lon", (F.col("start") + F.col("rank")).alias("position"))
    )


def point_batches(points: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """``(fips, lat, lon)`` to ``(batch_id, fips_list, latitudes, longitudes)``.

    Consecutive runs of ``batch_size`` points in ``fips`` order, with the
    coordinates as the comma-joined text a request takes.
    """
    in_order = F.sort_array(F.collect_list(F.struct("position", "fips", "lat", "lon")))
    return (
        _with_position(points)
        .groupBy(F.floor(F.col("position") / F.lit(batch_size)).alias("batch_id"))
        .agg(in_order.alias("points"))
        .select(
            "batch_id",
            F.col("points.fips").alias("fips_list"),
            F.concat_ws(",", F.col("points.lat").cast("array<string>")).alias("latitudes"),
            F.concat_ws(",", F.col("points.lon").cast("array<string>")).alias("longitudes"),
        )
    )

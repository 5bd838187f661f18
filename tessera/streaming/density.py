"""Point density over event-time windows, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.grid import col_of, row_of


def windowed_density(points: DataFrame, tier: str = "1deg", window: str = "1 day", late: str = "2 days") -> DataFrame:
    """(start, r, c, n): counts commute, so the closed windows of a stream are those of a batch."""
    if points.isStreaming:
        points = points.withWatermark("ts", late)
    out = points.groupBy(F.window("ts", window).alias("w"), row_of(F.col("lat"), tier).alias("r"), col_of(F.col("lon"), tier).alias("c")).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), "r", "c", "n")

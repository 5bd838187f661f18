"""Neighbourhood operators on dense (r, c, z) grids, longitude wrapping."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.grid import RADIUS_KM
from tessera.operators.stats import exact_quantiles, finite


def _wrapped(grid: DataFrame, nlon: int) -> DataFrame:
    """With columns -1 and nlon as copies of the far edge."""
    edge = F.when(F.col("c") == 0, nlon).when(F.col("c") == nlon - 1, -1)
    return grid.union(grid.where(F.col("c").isin(0, nlon - 1)).withColumn("c", edge.cast("int")).select(grid.columns))


def slope(grid: DataFrame, nlat: int, nlon: int, z: str = "z") -> DataFrame:
    """Degrees: central differences, one-sided in the first and last row; a grid of one row has no gradient along columns."""
    res = 180.0 / nlat
    step = RADIUS_KM * 1000 * math.radians(res)
    row, col = Window.partitionBy("r").orderBy("c"), Window.partitionBy("c").orderBy("r")
    out = _wrapped(grid.select("r", "c", z), nlon).withColumns({"_e": F.lead(z).over(row), "_w": F.lag(z).over(row)}).where(F.col("c").between(0, nlon - 1))
    out = out.withColumns({"_n": F.lead(z).over(col), "_s": F.lag(z).over(col)})
    gx = (F.col("_e") - F.col("_w")) / (2 * step * F.cos(F.radians((F.col("r") + 0.5) * res - 90)))
    gy = F.when(F.col("r") == 0, (F.col("_n") - F.col(z)) / step).when(F.col("r") == nlat - 1, (F.col(z) - F.col("_s")) / step).otherwise((F.col("_n") - F.col("_s")) / (2 * step))
    gy = F.lit(0.0) if nlat == 1 else gy
    return out.select("r", "c", F.degrees(F.atan(F.hypot(gx, gy))).alias("slope"))


def relief(grid: DataFrame, nlon: int, z: str = "z") -> DataFrame:
    """Range of the 3 x 3 neighbourhood, clipped at the first and last row: a pass along rows, one along columns."""
    row = Window.partitionBy("r").orderBy("c").rowsBetween(-1, 1)
    col = Window.partitionBy("c").orderBy("r").rowsBetween(-1, 1)
    out = _wrapped(grid.select("r", "c", z), nlon).withColumns({"_h": F.max(z).over(row), "_l": F.min(z).over(row)}).where(F.col("c").between(0, nlon - 1))
    return out.select("r", "c", (F.max("_h").over(col) - F.min("_l").over(col)).alias("relief"))


def seams(grid: DataFrame, nlon: int, tile: int, z: str = "z", q: float = 0.999) -> DataFrame:
    """(is_seam, n, p): exact quantile of steps between columns across tile edges and within tiles."""
    step = grid.withColumn("_d", F.abs(F.lead(z).over(Window.partitionBy("r").orderBy("c")) - F.col(z))).where(finite(F.col("_d")))
    step = step.withColumn("is_seam", (F.col("c") + 1) % tile == 0)
    return step.groupBy("is_seam").agg(F.count("*").alias("n")).join(exact_quantiles(step, "_d", [q], "is_seam"), "is_seam").select("is_seam", "n", F.col("value").alias("p"))


def windings(points: DataFrame, line: str, order: str, lon: str = "lon") -> DataFrame:
    """(line, winding): turns round the globe of each closed line, east positive; a double winding raises."""
    out = unwind(points, line, order, lon).groupBy(line).agg(F.round((F.max_by("unwound", order) - F.min_by("unwound", order)) / 360).cast("int").alias("winding"))
    if twice := out.where(F.abs("winding") > 1).select(line).limit(5).collect():
        raise ValueError(f"lines that wind round twice: {', '.join(str(x[0]) for x in twice)}")
    return out


def valid_windows(grid: DataFrame, size: int, valid: str, n: int) -> DataFrame:
    """(wr, wc): of the windows of size x size cells that are all valid, n evenly picked in row-major order."""
    whole = grid.groupBy(F.expr(f"int(r div {size})").alias("wr"), F.expr(f"int(c div {size})").alias("wc")).agg(F.count("*").alias("k"), F.min(F.col(valid).cast("int")).alias("ok"))
    whole = whole.where((F.col("k") == size * size) & (F.col("ok") == 1)).select("wr", "wc")
    # a row for each window, thousands of cells each
    ranked = whole.withColumn("i", F.row_number().over(Window.orderBy("wr", "wc")) - 1).withColumn("total", F.count("*").over(Window.partitionBy()))
    picks = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.rint(k * (F.col("total") - 1) / max(1, n - 1)))
    return ranked.where(F.array_contains(picks, F.col("i").cast("double"))).select("wr", "wc")


def unwind(points: DataFrame, line: str, order: str, lon: str = "lon") -> DataFrame:
    """Longitudes without jumps of more than 180 degrees along each line."""
    w = Window.partitionBy(line).orderBy(order)
    d = F.col(lon) - F.lag(lon).over(w)
    turn = F.when(d > 180, -360).when(d < -180, 360).otherwise(0)
    return points.withColumn("_t", turn).withColumn("unwound", F.col(lon) + F.sum("_t").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_t")

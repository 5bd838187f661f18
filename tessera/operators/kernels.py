"""Resampling kernels on (r, c, value) tables: one shuffle on the target cell, partial sums first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.grid import UNITS
from tessera.operators.stats import finite


def whole_blocks(nlat: int, nlon: int, factor: int) -> int:
    """``factor`` if it divides both sides of a grid; raises otherwise."""
    if factor < 1 or nlat % factor or nlon % factor:
        raise ValueError(f"{nlat} x {nlon} cells do not make blocks of {factor}")
    return factor


def _block(factor: int) -> list[Column]:
    return [F.expr(f"int(r div {factor})").alias("r"), F.expr(f"int(c div {factor})").alias("c")]


def block_sum(df: DataFrame, factor: int, value: str = "n") -> DataFrame:
    """Count-conserving sum of factor x factor cells."""
    return df.groupBy(*_block(factor)).agg(F.sum(F.col(value).cast("long")).alias(value))


def block_mode(df: DataFrame, factor: int, value: str = "v", nodata: int | None = None) -> DataFrame:
    """Commonest class of a block, the smallest of ties; ``nodata`` cells do not vote, a block of nothing else is nodata."""
    vote = F.col(value) if nodata is None else F.when(F.col(value) != nodata, F.col(value))
    votes = df.groupBy(*_block(factor), vote.alias("w")).agg(F.count("*").alias("n"))
    best = F.max(F.when(F.col("w").isNotNull(), F.struct("n", (-F.col("w")).alias("w"))))
    out = votes.groupBy("r", "c").agg((-best["w"]).alias(value))
    return out if nodata is None else out.withColumn(value, F.coalesce(value, F.lit(nodata)))


def block_weighted(df: DataFrame, factor: int, value: str = "v", weight: str = "w") -> DataFrame:
    """Weighted mean of the cells that have a finite value."""
    some = finite(F.col(value))
    w = F.when(some, F.col(weight))
    return df.groupBy(*_block(factor)).agg((F.sum(F.when(some, F.col(value)) * w) / F.sum(w)).alias(value))


def overlaps(df: DataFrame, x0: Column, x1: Column, y0: Column, y1: Column, tier_units: int) -> DataFrame:
    """Source cells with edges in units (1/UNITS degree from -180, -90), once for each target cell they meet; columns tr, tc, w.

    Longitude wraps. w is overlap length times the difference of the latitudes' sines. The explosion is by cell
    ratio, so it makes an equi-join of a range join.
    """
    nlon = 360 * UNITS // tier_units
    cells = lambda a, b: F.sequence(F.floor(a / tier_units), F.floor((b - 1) / tier_units))
    df = df.withColumns({"_x0": x0, "_x1": x1, "_y0": y0, "_y1": y1})
    df = df.withColumn("_i", F.explode(cells(F.col("_x0"), F.col("_x1")))).withColumn("_j", F.explode(cells(F.col("_y0"), F.col("_y1"))))
    width = F.least("_x1", (F.col("_i") + 1) * tier_units) - F.greatest("_x0", F.col("_i") * tier_units)
    sine = lambda y: F.sin(F.radians(y / F.lit(float(UNITS)) - 90))
    height = sine(F.least("_y1", (F.col("_j") + 1) * tier_units)) - sine(F.greatest("_y0", F.col("_j") * tier_units))
    return df.withColumns({"tr": F.col("_j").cast("int"), "tc": F.pmod("_i", F.lit(nlon)).cast("int"), "w": width * height}).drop("_x0", "_x1", "_y0", "_y1", "_i", "_j")


def overlap_mean(cells: DataFrame, value: str = "v", keys: tuple[str, ...] = ()) -> DataFrame:
    """Conservative mean over ``overlaps``: valid weight only, so holes do not dilute. keys: depth, time or the like."""
    some = cells.where(finite(F.col(value)))
    return some.groupBy(*keys, F.col("tr").alias("r"), F.col("tc").alias("c")).agg((F.sum(F.col(value) * F.col("w")) / F.sum("w")).alias(value), F.sum("w").alias("weight"))


def overlap_mean_by_axis(df: DataFrame, x0: Column, x1: Column, y0: Column, y1: Column, tier_units: int, value: str = "v", keys: tuple[str, ...] = ()) -> DataFrame:
    """``overlap_mean`` of ``overlaps`` in two steps: source columns into target columns, then source rows into target rows.

    An overlap's weight is a width times a height, so the sums over a target column
    may be taken first, within each source row. A source cell is exploded to the
    columns it meets, and only a row of target columns to the rows it meets: a + b
    steps for a x b, and the second shuffle carries target columns alone. Edges in
    columns must depend on the column only, edges in rows on the row.
    """
    nlon = 360 * UNITS // tier_units
    met = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / tier_units), F.floor((F.col(b) - 1) / tier_units)))
    some = df.where(finite(F.col(value))).select(*keys, F.col(value).cast("double").alias("_v"), x0.alias("_x0"), x1.alias("_x1"), y0.alias("_y0"), y1.alias("_y1")).withColumn("_i", met("_x0", "_x1"))
    width = (F.least("_x1", (F.col("_i") + 1) * tier_units) - F.greatest("_x0", F.col("_i") * tier_units)).cast("double")
    column = F.pmod("_i", F.lit(nlon)).cast("int").alias("c")
    rows = some.groupBy(*keys, "_y0", "_y1", column).agg(F.sum(F.col("_v") * width).alias("_s"), F.sum(width).alias("_w")).withColumn("_j", met("_y0", "_y1"))
    sine = lambda y: F.sin(F.radians(y / F.lit(float(UNITS)) - 90))
    height = sine(F.least("_y1", (F.col("_j") + 1) * tier_units)) - sine(F.greatest("_y0", F.col("_j") * tier_units))
    return rows.groupBy(*keys, F.col("_j").cast("int").alias("r"), "c").agg((F.sum(F.col("_s") * height) / F.sum(F.col("_w") * height)).alias(value), F.sum(F.col("_w") * height).alias("weight"))


def axial_mean(theta: Column, w: Column) -> Column:
    """Mean direction of axes (period 180 degrees)."""
    t = F.radians(2 * theta)
    return F.pmod(F.degrees(F.atan2(F.sum(w * F.sin(t)), F.sum(w * F.cos(t)))) / 2, F.lit(180.0))


def resultant_length(theta: Column) -> Column:
    """Of the doubled angles: 1 where all axes agree."""
    t = F.radians(2 * theta)
    return F.hypot(F.avg(F.cos(t)), F.avg(F.sin(t)))


def corner_mode(nodes: DataFrame, nlat: int, nlon: int, value: str = "v") -> DataFrame:
    """Cells from nodes: the commonest of the four corners, the smallest of ties, plus 1; longitude wraps."""
    near = nodes.withColumn("d", F.explode(F.array(*[F.struct(F.lit(a).alias("r"), F.lit(b).alias("c")) for a in (0, 1) for b in (0, 1)])))
    near = near.select((F.col("r") - F.col("d.r")).alias("r"), F.pmod(F.col("c") - F.col("d.c"), F.lit(nlon)).alias("c"), value)
    near = near.where(F.col("r").between(0, nlat - 1))
    return block_mode(near, 1, value).withColumn(value, F.col(value) + 1)

"""Nested global grids: tiers, cells, coordinates and areas as column expressions."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# fixed values: resolutions of the tiers in degrees, and the authalic radius in km
TIERS = {"1deg": Fraction(1), "30min": Fraction(1, 2), "6min": Fraction(1, 10), "3min": Fraction(1, 20), "30sec": Fraction(1, 120)}
RADIUS_KM = 6371.0071810
#: Edges of sources and tiers are whole multiples of 1/UNITS degree.
UNITS = 2400


def shape(tier: str) -> tuple[int, int]:
    """(rows, columns); row 0 is south, column 0 west."""
    return int(180 / TIERS[tier]), int(360 / TIERS[tier])


def factor(coarse: str, fine: str) -> int:
    """Cells of ``fine`` along a side of a cell of ``coarse``; raises unless whole."""
    f = TIERS[coarse] / TIERS[fine]
    if f.denominator != 1:
        raise ValueError(f"{coarse} is no whole multiple of {fine}")
    return int(f)


def wrap_lon(lon: Column) -> Column:
    """To [-180, 180): 180 is -180."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def _cell(x: Column, per_degree: int, n: int) -> Column:
    return F.least(F.greatest(F.floor(x * per_degree), F.lit(0)), F.lit(n - 1)).cast("int")


def valid_lat(lat: Column) -> Column:
    """On the globe; null and NaN are not."""
    return F.coalesce((lat >= -90) & (lat <= 90) & ~F.isnan(lat.cast("double")), F.lit(False))


def valid_lon(lon: Column) -> Column:
    """Finite, of any turn."""
    return F.coalesce((F.abs(lon) < float("inf")) & ~F.isnan(lon.cast("double")), F.lit(False))


def row_of(lat: Column, tier: str) -> Column:
    """Null off the globe."""
    return F.when(valid_lat(lat), _cell(lat + 90, TIERS[tier].denominator, shape(tier)[0]))


def col_of(lon: Column, tier: str) -> Column:
    """Null where the longitude is not finite."""
    return F.when(valid_lon(lon), _cell(wrap_lon(lon) + 180, TIERS[tier].denominator, shape(tier)[1]))


def point_cells(df: DataFrame, tier: str, lat: str = "lat", lon: str = "lon", drop: bool = False) -> DataFrame:
    """``df`` with r and c. A point off the globe or not finite raises, or goes with ``drop``."""
    good = valid_lat(F.col(lat)) & valid_lon(F.col(lon))
    if not drop and (wrong := df.agg(F.count_if(~good)).first()[0]):
        raise ValueError(f"{wrong} points without a cell")
    return df.where(good).withColumns({"r": row_of(F.col(lat), tier), "c": col_of(F.col(lon), tier)})


def node_edges(spark: SparkSession, nlat: int) -> DataFrame:
    """(r, lat, south, north): nodes from pole to pole and the edges halfway between them, clamped to the poles."""
    step = 180.0 / (nlat - 1)
    lat = F.col("id") * step - 90
    return spark.range(nlat).select(F.col("id").cast("int").alias("r"), lat.alias("lat"), F.greatest(lat - step / 2, F.lit(-90.0)).alias("south"), F.least(lat + step / 2, F.lit(90.0)).alias("north"))


def nearest_line(x: Column, origin: float, step: float, n: int) -> tuple[Column, Column]:
    """(index of the nearest of n lines of a regular grid, distance to it)."""
    k = F.least(F.greatest(F.rint((x - origin) / step), F.lit(0)), F.lit(n - 1)).cast("int")
    return k, F.abs(x - (origin + k * step))


def ring_column(x: Column, step: float, n: int) -> Column:
    """Column of a cell's western edge on a ring of n cells from -180; what lies beyond the dateline wraps."""
    return F.pmod(F.rint((x + 180) / step).cast("int"), F.lit(n))


def require_contiguous(df: DataFrame, group: str, n: int, c: str = "c") -> DataFrame:
    """``df`` if each group's columns are neighbours on the ring of n; raises for one with a gap inside."""
    w = Window.partitionBy(group)
    each = df.select(group, c).distinct().withColumn("gap", F.coalesce(F.lead(c).over(w.orderBy(c)) - F.col(c), F.min(c).over(w) + n - F.col(c)))
    torn = each.groupBy(group).agg(F.count_if(F.col("gap") > 1).alias("gaps")).where("gaps > 1").select(group).limit(5).collect()
    if torn:
        raise ValueError(f"columns with gaps: {', '.join(str(x[0]) for x in torn)}")
    return df


def axis_attributes(axis: str) -> dict[str, str]:
    """What a level axis says of itself in the manifest."""
    return {"time": {"units": "Ma", "long_name": "geologic age before present", "direction": "increasing age (into the past)"}, "depth": {"units": "km", "positive": "down", "long_name": "depth"}}[axis]


def pixel_key(x: Column, per_degree: int = 10) -> Column:
    """Cell number after rounding to 6 decimals, half to even, so that decimal boundaries hold."""
    return F.floor(F.rint(x * per_degree * 1e6) / 1e6).cast("long")


def area_km2(low: Column, high: Column, dlon: float) -> Column:
    """Of a cell between two latitudes."""
    return F.lit(RADIUS_KM * RADIUS_KM * math.radians(dlon)) * (F.sin(F.radians(high)) - F.sin(F.radians(low)))


def dense_grid(spark: SparkSession, tier: str) -> DataFrame:
    """(r, c) of every cell."""
    nlat, nlon = shape(tier)
    return spark.range(nlat * nlon).select((F.col("id") / nlon).cast("int").alias("r"), (F.col("id") % nlon).cast("int").alias("c"))


def row_areas(spark: SparkSession, tier: str) -> DataFrame:
    """(r, lat, area_km2) of every row of cells."""
    nlat, _ = shape(tier)
    res = float(TIERS[tier])
    r = F.col("id").cast("int")
    return spark.range(nlat).select(r.alias("r"), (r * res - 90 + res / 2).alias("lat"), area_km2(r * res - 90, (r + 1) * res - 90, res).alias("area_km2"))

"""Layer builders on the stand-in sources: f(spark, data folder, tier) gives (r, c, v), with k for layers that have levels.

Count and class layers come from their home tier, means from the source itself, slope and
relief from the tier's own elevation, distances from the lines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.grid import UNITS, TIERS, col_of, dense_grid, factor, row_of, shape
from tessera.operators import fidelity, kernels, lines, merge, windows
from tessera.plans import adapters

#: Cells of the stand-in rasters, in degrees.
COARSE = 5
HOME = "30min"
#: Elevation above which the stand-in is land.
SEA_LEVEL = 100.0


@dataclass(frozen=True)
class Builder:
    kind: str
    make: Callable[[SparkSession, str, str], DataFrame]


BUILDERS: dict[str, Builder] = {}


def builder(layer: str, kind: str):
    """Register a layer's builder. kind chooses its fidelity checks: count, mean, class, distance, levels or derived."""

    def add(f):
        BUILDERS[layer] = Builder(kind, f)
        return f

    return add


def _met(cells: DataFrame, tier: str) -> DataFrame:
    step = COARSE * UNITS
    return kernels.overlaps(cells, F.col("c") * step, (F.col("c") + 1) * step, F.col("r") * step, (F.col("r") + 1) * step, int(TIERS[tier] * UNITS))


def on_tier(cells: DataFrame, tier: str, keys: tuple[str, ...] = (), axial: bool = False, value: str = "v") -> DataFrame:
    """Cells of COARSE degrees to a tier: area-weighted mean, or mean direction of axes."""
    if axial:
        some = _met(cells, tier).where(F.col(value).isNotNull())
        return some.groupBy(*keys, F.col("tr").alias("r"), F.col("tc").alias("c")).agg(kernels.axial_mean(F.col(value), F.col("w")).alias("v"))
    step = COARSE * UNITS
    c, r = F.col("c").cast("long"), F.col("r").cast("long")
    found = kernels.overlap_mean_by_axis(cells, c * step, (c + 1) * step, r * step, (r + 1) * step, int(TIERS[tier] * UNITS), value, keys)
    return found.select(*keys, "r", "c", F.col(value).alias("v"))


def source_weights(cells: DataFrame) -> DataFrame:
    """``cells`` of COARSE degrees with ``w``, their area on the unit sphere."""
    sine = lambda r: F.sin(F.radians(r * COARSE - 90.0))
    return cells.withColumn("w", (sine(F.col("r") + 1) - sine(F.col("r"))) * F.radians(F.lit(float(COARSE))))


def _density_home(spark: SparkSession, data: str) -> DataFrame:
    return adapters.points(spark, data).groupBy(row_of(F.col("lat"), "3min").alias("r"), col_of(F.col("lon"), "3min").alias("c")).agg(F.count("*").alias("n"))


@builder("point_density", "count")
def point_density(spark, data, tier):
    return kernels.block_sum(_density_home(spark, data), factor(tier, "3min")).select("r", "c", F.col("n").cast("double").alias("v"))


def elevation_source(spark: SparkSession, data: str) -> DataFrame:
    return adapters.raster(spark, data).withColumn("v", F.col("v").cast("double"))


@builder("elevation", "mean")
def elevation(spark, data, tier):
    return on_tier(elevation_source(spark, data), tier)


def _class_home(spark: SparkSession, data: str) -> DataFrame:
    # the smallest quantity wins a cell, the later site of equal ones; codes 1 to 7
    hits = adapters.primary(spark, data).select(row_of(F.col("lat"), HOME).alias("r"), col_of(F.col("lon"), HOME).alias("c"), "q", "id", (F.col("id") % 7 + 1).cast("int").alias("v"))
    return merge.smallest_wins(hits, "q", "id", "v").select("r", "c", "v")


@builder("site_class", "class")
def site_class(spark, data, tier):
    return kernels.block_mode(_class_home(spark, data), factor(tier, HOME), nodata=0).select("r", "c", F.col("v").cast("double").alias("v"))


def line_source(spark: SparkSession, data: str) -> DataFrame:
    return adapters.extra(spark, data).select("lat", "lon", (F.col("lat") * 0.9).alias("lat2"), (F.col("lon") + 3).alias("lon2"))


@builder("line_distance", "distance")
def line_distance(spark, data, tier):
    chain = [20, 5, 1, *(x for x in sorted(TIERS.values(), reverse=True) if TIERS[tier] <= x < 1 and (1 / x) % 1 == 0)]
    chain = [x for i, x in enumerate(chain) if all((Fraction(x) / Fraction(y)).denominator == 1 for y in chain[i + 1 :])]
    return lines.distance_pyramid(line_source(spark, data), chain).select("r", "c", F.col("km").alias("v"))


def merged_zones(spark: SparkSession, data: str) -> DataFrame:
    return merge.shallowest(adapters.zones(spark, data), payload=("dip",)).select("r", "c", F.col("dep").cast("double").alias("v"), (F.col("dip") * 25.0).alias("strike"), "n_zones")


@builder("slab_depth", "mean")
def slab_depth(spark, data, tier):
    return on_tier(merged_zones(spark, data), tier)


@builder("slab_strike", "derived")
def slab_strike(spark, data, tier):
    return on_tier(merged_zones(spark, data), tier, axial=True, value="strike")


def levels_source(spark: SparkSession, data: str) -> DataFrame:
    return adapters.zones(spark, data).select(F.col("zone").cast("double").alias("k"), "r", "c", F.col("dep").cast("double").alias("v"))


@builder("zone_levels", "levels")
def zone_levels(spark, data, tier):
    return on_tier(levels_source(spark, data), tier, keys=("k",))


def _dense(spark, data, tier) -> DataFrame:
    return dense_grid(spark, tier).join(elevation(spark, data, tier), ["r", "c"], "left").select("r", "c", F.coalesce("v", F.lit(0.0)).alias("z"))


@builder("land_mask", "derived")
def land_mask(spark, data, tier):
    # the source is judged, not its mean: what lies at sea level stays there whatever a mean's last bit says; ties are sea
    met = _met(elevation_source(spark, data).withColumn("land", F.coalesce(F.col("v") > SEA_LEVEL, F.lit(False))), tier)
    land = met.groupBy(F.col("tr").alias("r"), F.col("tc").alias("c")).agg((F.sum(F.when(F.col("land"), F.col("w")).otherwise(0.0)) > F.sum("w") / 2).alias("land"))
    return dense_grid(spark, tier).join(land, ["r", "c"], "left").select("r", "c", F.coalesce(F.col("land").cast("double"), F.lit(0.0)).alias("v"))


@builder("slope", "derived")
def slope(spark, data, tier):
    return windows.slope(_dense(spark, data, tier), *shape(tier)).select("r", "c", F.col("slope").alias("v"))


@builder("relief", "derived")
def relief(spark, data, tier):
    return windows.relief(_dense(spark, data, tier), shape(tier)[1]).select("r", "c", F.col("relief").alias("v"))


#: Sources of the layers whose integrals are checked.
SOURCES = {"elevation": elevation_source, "slab_depth": merged_zones, "zone_levels": levels_source}


def checks(spark: SparkSession, layer: str, data: str, stored: dict[str, DataFrame]) -> DataFrame:
    """Fidelity checks of a layer, (name, status, summary); stored: its cells by tier.

    Values of sums in double precision depend on the order of rows, so means are compared after rounding to 9 digits.
    """
    known = BUILDERS[layer]
    keys = ("k", "r", "c") if known.kind == "levels" else ("r", "c")
    near = lambda x: x.withColumn("v", F.round("v", 9))
    found = []
    for tier, cells in stored.items():
        found.append(fidelity.same_cells(near(cells), near(known.make(spark, data, tier)), f"{tier} recomputed", keys))
        if known.kind == "count":
            found.append(fidelity.counts_kept(_density_home(spark, data).withColumnRenamed("n", "v"), cells, f"{tier} counts"))
        elif known.kind in ("mean", "levels"):
            source = SOURCES[layer](spark, data)
            found.append(fidelity.integral_kept(source_weights(source), fidelity.area_weighted(cells, tier), f"{tier} integral"))
            found.append(fidelity.quantile_shift(source, cells, f"{tier} quantiles", 0.0, 1e7 if layer != "elevation" else 1e4, 1.0))
            if known.kind == "levels":
                found.append(fidelity.level_curves(source_weights(source), fidelity.area_weighted(cells, tier), f"{tier} level means", 1.0))
        elif known.kind == "class":
            found.append(fidelity.in_codes(cells, list(range(8)), f"{tier} codes"))
            found.append(fidelity.share_drift(_class_home(spark, data), cells.where("v > 0"), f"{tier} shares"))
        elif known.kind == "distance":
            found.append(fidelity.distances_hold(cells, line_source(spark, data), f"{tier} sampled distances", tier))
            found.append(fidelity.in_range(cells, 0.0, 20038.0, f"{tier} range"))
    return reduce(DataFrame.union, found)

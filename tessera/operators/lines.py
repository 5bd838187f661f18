"""Lines on grids: cells that they cross, burning, and distance to the nearest segment down nested grids."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.grid import RADIUS_KM
from tessera.operators.geometry import cross, haversine, segment_distance, unit_vector
from tessera.sources.scratch import dealt, kept


def crossed_cells(segs: DataFrame, res: float, nlat: int, nlon: int) -> DataFrame:
    """A row for each cell that a segment passes, with ``r`` and ``c``.

    A segment is cut where it meets grid lines, and each cut's middle names its
    cell, so no cell that it passes is missed. Segments do not cross the dateline
    (``split_dateline`` first); a null coordinate passes no cell.
    """
    x0, x1 = (F.col("lon") + 180) / res, (F.col("lon2") + 180) / res
    y0, y1 = (F.col("lat") + 90) / res, (F.col("lat2") + 90) / res

    def cuts(a: Column, b: Column) -> Column:
        low, high = F.ceil(F.least(a, b)), F.floor(F.greatest(a, b))
        return F.when((low <= high) & (a != b), F.transform(F.sequence(low, high), lambda k: (k - a) / (b - a))).otherwise(F.array().cast("array<double>"))

    whole = segs.where("lat is not null and lon is not null and lat2 is not null and lon2 is not null")
    at = whole.withColumn("_t", F.array_sort(F.concat(F.array(F.lit(0.0)), cuts(x0, x1), cuts(y0, y1), F.array(F.lit(1.0)))))
    middles = F.zip_with(F.slice("_t", 1, F.size("_t") - 1), F.slice("_t", 2, F.size("_t") - 1), lambda a, b: F.when(b > a, (a + b) / 2))
    out = at.withColumn("_m", F.explode(F.array_compact(middles)))
    cell = lambda a, b, n: F.least(F.greatest(F.floor(a + F.col("_m") * (b - a)), F.lit(0)), F.lit(n - 1)).cast("int")
    return out.withColumns({"r": cell(y0, y1, nlat), "c": cell(x0, x1, nlon)}).drop("_t", "_m")


def walked_cells(segs: DataFrame, res: float, nlat: int, nlon: int) -> DataFrame:
    """A row for each cell of a segment's walk, with ``r`` and ``c``: one cell for each column, or for each row where it is steeper.

    The trace of one cell's width from the first end's cell to the last one's that a
    raster library draws by default: after i of the longer side's n steps the shorter
    side has gone floor((2 i m + n - 1) / 2 n) of its m. Every cell that it has is one
    beside the segment or passed by it; of those that ``crossed_cells`` gives it
    leaves out the corners. A row's upper edge belongs to it, counted from the north.
    """
    col = lambda x: F.floor((F.col(x) + 180) / res)
    row = lambda y: nlat - 1 - F.floor((90 - F.col(y)) / res)
    whole = segs.where("lat is not null and lon is not null and lat2 is not null and lon2 is not null")
    at = whole.withColumns({"_x": col("lon"), "_y": row("lat"), "_dx": col("lon2") - col("lon"), "_dy": row("lat2") - row("lat")})
    flat = F.abs("_dx") >= F.abs("_dy")
    at = at.withColumns({"_n": F.greatest(F.abs("_dx"), F.abs("_dy")), "_m": F.least(F.abs("_dx"), F.abs("_dy"))}).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n"))))
    gone = F.when(F.col("_n") == 0, F.lit(0)).otherwise(F.floor((2 * F.col("_i") * F.col("_m") + F.col("_n") - 1) / F.when(F.col("_n") > 0, 2 * F.col("_n"))))
    step = lambda long, d: F.signum(F.col(d)) * F.when(long, F.col("_i")).otherwise(gone)
    out = at.withColumns({"r": (F.col("_y") + step(~flat, "_dy")).cast("int"), "c": (F.col("_x") + step(flat, "_dx")).cast("int")})
    return out.where(F.col("r").between(0, nlat - 1) & F.col("c").between(0, nlon - 1)).drop("_x", "_y", "_dx", "_dy", "_n", "_m", "_i")


def burn_lines(segs: DataFrame, res: float, nlat: int, nlon: int, line: str = "line", code: str = "code", length: str = "length", nodata: int = 0, cells=crossed_cells) -> DataFrame:
    """(r, c, code, overlap): a cell takes the code of its shortest line (of equal ones the last); overlap: more than one line is there.

    cells: ``crossed_cells``, all that a segment passes, or ``walked_cells``.

    Lines of code ``nodata`` burn nothing. Lines are ranked first, so that a cell's
    best is the least of whole numbers, combined in a hash map before anything is
    sorted or leaves its task, however many lines meet in a cell.
    """
    some = segs.where(F.col(code) != nodata)
    keys = [F.col(length), F.col(line), F.col(code)]
    order = [F.desc_nulls_last(-F.col(length)), F.desc_nulls_last(line), F.desc_nulls_last(code)]
    ranked = kept(some.select(*keys).distinct().orderBy(*order).select("*", F.monotonically_increasing_id().alias("_rank")), "ranks")
    told = ranked.select(*[x.alias(f"_{i}") for i, x in enumerate(keys)], "_rank")
    same = [x.eqNullSafe(F.col(f"_{i}")) for i, x in enumerate(keys)]
    met = cells(some.join(told, same[0] & same[1] & same[2]).drop("_0", "_1", "_2"), res, nlat, nlon)
    best = met.groupBy("r", "c").agg(F.min("_rank").alias("_rank"), (F.min(line) != F.max(line)).alias("overlap"))
    return best.join(ranked.select("_rank", code), "_rank").select("r", "c", code, "overlap")


def _reach(res: float) -> Column:
    """Kilometres from the centre of a cell of row ``r`` to its farthest point, one of its corners (with room for rounding)."""
    lat = (F.col("r") + 0.5) * res - 90
    return 1.001 * F.greatest(*[haversine(lat, F.lit(0.0), lat + d, F.lit(res / 2)) for d in (-res / 2, res / 2)])


def distance_pyramid(segs: DataFrame, chain: list[int | Fraction], inside: DataFrame | None = None) -> DataFrame:
    """(r, c, km) of the finest grid of ``chain`` (degrees, whole or fractions, each a whole multiple of the next).

    On the coarsest grid each segment meets every cell (a fixed number), below that
    a cell's segments are those within its parent's least distance plus twice the
    parent's reach: the nearest one of every point of the parent is among them.
    Rows grow with segments, not with their square; least distances are combined
    map-side. The segments that a level keeps are written once, before they meet the
    cells of the next one, so no level is computed anew for those below it, and small
    files of segments are dealt to many tasks first. inside: (r, c) of cells whose
    distance is 0.
    """
    steps_down = [Fraction(a) / Fraction(b) for a, b in zip(chain[:-1], chain[1:])]
    if any(x.denominator != 1 for x in steps_down) or (180 / Fraction(chain[0])).denominator != 1:
        raise ValueError(f"{chain}: each must be a whole multiple of the next")
    a, b, n, p = ([F.col(f"_{v}{k}") for k in "xyz"] for v in "abnp")
    named = lambda vector, name: [x.alias(f"_{name}{k}") for x, k in zip(vector, "xyz")]
    ends = [*named(unit_vector(F.col("lat"), F.col("lon")), "a"), *named(unit_vector(F.col("lat2"), F.col("lon2")), "b")]
    near = dealt(segs.select("lat", "lon", "lat2", "lon2")).select(*ends).select(*a, *b, *named(cross(a, b), "n"))
    nlon = int(360 / Fraction(chain[0]))
    near = near.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(nlon // 2 * nlon - 1)))).select(*a, *b, *n, (F.col("_i") / nlon).cast("int").alias("r"), (F.col("_i") % nlon).cast("int").alias("c"))
    for i, res in enumerate(chain):
        # the vectors are columns, so that each is computed once a row
        centre = unit_vector((F.col("r") + 0.5) * float(res) - 90, (F.col("c") + 0.5) * float(res) - 180)
        met = near.select("*", *named(centre, "p")).withColumn("km", segment_distance(p, a, b, n))
        least = met.groupBy("r", "c").agg(F.min("km").alias("least"))
        if i == len(chain) - 1:
            out = least.select("r", "c", F.col("least").alias("km"))
            break
        k = int(steps_down[i])
        steps = F.sequence(F.lit(0), F.lit(k - 1))
        held = met.join(kept(least.withColumn("least", F.col("least") + 2 * _reach(float(res))), "least"), ["r", "c"]).where("km <= least")
        near = dealt(kept(held.select(*a, *b, *n, "r", "c"), "near"))
        near = near.withColumn("_a", F.explode(steps)).withColumn("_b", F.explode(steps)).select(*a, *b, *n, (F.col("r") * k + F.col("_a")).alias("r"), (F.col("c") * k + F.col("_b")).alias("c"))
    if inside is None:
        return out
    zero = inside.select("r", "c", F.lit(0.0).alias("_zero")).distinct()
    return out.join(zero, ["r", "c"], "left").select("r", "c", F.coalesce("_zero", "km").alias("km"))


# fixed values: WGS84
WGS84_A_KM, WGS84_E2 = 6378.137, 0.0066943799901413165


def _q(s: Column) -> Column:
    e = math.sqrt(WGS84_E2)
    return (1 - WGS84_E2) * (s / (1 - WGS84_E2 * s * s) + F.atanh(e * s) / e)


def ring_area_km2(ring: str) -> Column:
    """Area of a closed ring of struct(x, y) on WGS84, without sign: spherical excess over authalic latitudes.

    Edges are great circles of the authalic sphere in place of geodesics; by how much
    that moves an area is not measured. A ring round a pole is not meant.
    """
    e = math.sqrt(WGS84_E2)
    pole = 1 + (1 - WGS84_E2) * math.atanh(e) / e
    half = lambda p: F.tan(F.asin(F.least(F.greatest(_q(F.sin(F.radians(p.y))) / pole, F.lit(-1.0)), F.lit(1.0))) / 2)
    turn = lambda a, b: F.radians(F.pmod(b.x - a.x + 180, F.lit(360.0)) - 180)
    excess = lambda a, b: 2 * F.atan2(F.tan(turn(a, b) / 2) * (half(a) + half(b)), 1 + half(a) * half(b))
    n = F.size(ring)
    parts = F.zip_with(F.slice(ring, 1, n - 1), F.slice(ring, 2, n - 1), excess)
    return F.abs(F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)) * (WGS84_A_KM**2 * pole / 2)

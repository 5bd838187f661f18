"""Polygons on grids by scanlines: edges, their crossings with rows of cell centres, and runs of columns between crossings.

Rings are arrays of struct(x, y), closed or not. An edge leaves its polygon as a row
and is exploded to the rows of the grid that it crosses, so a polygon of any size is
filled by many tasks; a polygon's crossings with one row meet in a task, no more. A
point is inside by the even-odd rule, on the same side of every edge as a ray cast
has it: an edge holds its lower end, and a column its western crossing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.scratch import dealt

_ROW = "_polygon"


def edges(polygons: DataFrame, rings: str = "rings") -> DataFrame:
    """All other columns, and x1, y1, x2, y2 of every edge of an array of rings; the last vertex is joined to the first."""
    flat = polygons.withColumn("_ring", F.explode(rings)).drop(rings)
    after = F.concat(F.slice("_ring", 2, F.greatest(F.size("_ring") - 1, F.lit(0))), F.slice("_ring", 1, 1))
    flat = flat.withColumn("_e", F.explode(F.arrays_zip(F.col("_ring").alias("a"), after.alias("b")))).drop("_ring")
    rest = [c for c in flat.columns if c != "_e"]
    return flat.select(*rest, F.col("_e.a.x").alias("x1"), F.col("_e.a.y").alias("y1"), F.col("_e.b.x").alias("x2"), F.col("_e.b.y").alias("y2"))


def first_centre(v: Column, res: float, origin: float) -> Column:
    """Number of the first cell whose centre is at ``v`` or beyond; centres are (k + 0.5) * res - origin."""
    centre = lambda k: (k + 0.5) * res - origin
    k = F.ceil((v + origin) / res - 0.5)
    return F.when(centre(k - 1) >= v, k - 1).when(centre(k) < v, k + 1).otherwise(k)


def crossings(edge_rows: DataFrame, res: float, nlat: int, carry: list[str]) -> DataFrame:
    """(carry, r, x) of each row of cell centres that an edge crosses; res: a row's height."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    a, b = F.greatest(first_centre(low, res, 90.0), F.lit(0)), F.least(first_centre(high, res, 90.0) - 1, F.lit(nlat - 1))
    some = edge_rows.withColumns({"_a": a, "_b": b}).where("_a <= _b").withColumn("r", F.explode(F.sequence("_a", "_b")))
    y = (F.col("r") + 0.5) * res - 90
    x = (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    return some.select(*carry, F.col("r").cast("int").alias("r"), x.alias("x"))


def runs(edge_rows: DataFrame, res: float, nlat: int, nlon: int, carry: list[str], height: float | None = None) -> DataFrame:
    """(carry, r, c0, c1): the columns of cell centres inside, first and last, of each polygon and row; ``carry`` names a polygon.

    height: of rows, where it is not that of columns.
    """
    met = crossings(edge_rows, height or res, nlat, carry).groupBy(*carry, "r").agg(F.array_sort(F.collect_list("x")).alias("_x"))
    pairs = F.transform(F.sequence(F.lit(0), F.expr("size(_x) div 2 - 1")), lambda k: F.struct(F.get("_x", 2 * k).alias("a"), F.get("_x", 2 * k + 1).alias("b")))
    out = met.where(F.size("_x") > 1).withColumn("_p", F.explode(pairs))
    c0, c1 = F.greatest(first_centre(F.col("_p.a"), res, 180.0), F.lit(0)), F.least(first_centre(F.col("_p.b"), res, 180.0) - 1, F.lit(nlon - 1))
    return out.select(*carry, "r", c0.cast("int").alias("c0"), c1.cast("int").alias("c1")).where("c0 <= c1")


def fill(polygons: DataFrame, res: float, nlat: int, nlon: int, rings: str = "rings") -> DataFrame:
    """All other columns of ``polygons``, r and c, for each cell whose centre is inside; rows of equal columns are polygons of their own."""
    rest = [c for c in polygons.columns if c != rings]
    named = polygons.select(F.monotonically_increasing_id().alias(_ROW), F.struct(*rest).alias("_rest"), rings)
    told = runs(edges(named, rings), res, nlat, nlon, [_ROW, "_rest"])
    return told.select("_rest.*", "r", F.explode(F.sequence("c0", "c1")).alias("c"))


def burn_codes(cells: DataFrame, codes: list[str], size: str, order: str, nodata: int = 0) -> DataFrame:
    """(r, c, codes, n_hits): several layers burnt in one aggregation, each with the code of the cell's smallest polygon (of equal ones the last).

    A polygon whose code is ``nodata`` takes no part in that layer, and still counts
    as a hit; a cell without another has ``nodata`` there.
    """
    by = F.struct(F.col(size), (-F.col(order)).alias("o"))
    best = [F.coalesce(F.min_by(F.when(F.col(c) != nodata, F.col(c)), F.when(F.col(c) != nodata, by)), F.lit(nodata)).alias(c) for c in codes]
    return cells.groupBy("r", "c").agg(*best, F.count("*").alias("n_hits"))


def burn_counts(burnt: DataFrame, nlat: int, nlon: int) -> DataFrame:
    """(overlap, uncovered): cells that several polygons hold, and cells of the grid that none does."""
    return burnt.agg(F.count_if(F.col("n_hits") > 1).alias("overlap"), (F.lit(nlat * nlon) - F.count("*")).alias("uncovered"))


def half_plane(ring: Column, axis: str, bound: float, keep_above: bool) -> Column:
    """A closed or open ring cut at x (or y) = ``bound``: what lies on one side, led along the cut.

    One step along the edges: a vertex that is kept stays, and an edge that crosses
    adds its crossing. Parts that the cut separates stay joined by edges along it, of
    no area. A ring wholly on the other side becomes empty.
    """
    other = "y" if axis == "x" else "x"
    kept = (lambda p: p[axis] >= bound) if keep_above else (lambda p: p[axis] <= bound)
    after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    point = lambda p: F.struct(p.x.alias("x"), p.y.alias("y"))

    def crossing(a, b):
        across = a[other] + (b[other] - a[other]) * (bound - a[axis]) / F.when(b[axis] != a[axis], b[axis] - a[axis])
        at = {axis: F.lit(float(bound)), other: across}
        return F.struct(at["x"].alias("x"), at["y"].alias("y"))

    step = lambda a, b: F.concat(F.when(kept(a), F.array(point(a))).otherwise(F.array().cast("array<struct<x:double,y:double>>")), F.when(kept(a) != kept(b), F.array(crossing(a, b))).otherwise(F.array().cast("array<struct<x:double,y:double>>")))
    return F.flatten(F.zip_with(ring, after, step))


def clipped(polygons: DataFrame, ring: str = "ring", west: float = -180.0, south: float = -90.0, east: float = 180.0, north: float = 90.0) -> DataFrame:
    """``polygons`` with a ring cut to a window, four half planes one after another; rings without a part in it go.

    Each cut is a row of its own generator, so that the next one reads its ring and
    does not compute it anew wherever it names it.
    """
    out = dealt(polygons)
    for axis, bound, above in (("x", west, True), ("x", east, False), ("y", south, True), ("y", north, False)):
        cut = F.array(half_plane(F.col(ring), axis, bound, above))
        out = out.withColumn(ring, F.explode(cut))
    return out.where(F.size(ring) > 2)


def plane_area(ring: Column) -> Column:
    """Area in square degrees, positive for a ring that runs counterclockwise; open and closed rings alike."""
    after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.aggregate(F.zip_with(ring, after, lambda a, b: a.x * b.y - b.x * a.y), F.lit(0.0), lambda s, v: s + v) / 2

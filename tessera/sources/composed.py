"""Readers put together from byte-range grids and axes, with their contracts, up to cells that builders take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.stats import finite
from tessera.sources.binary import geotiff_frames, netcdf_axis
from tessera.sources.readers import SourceMismatch, require
from tessera.sources.strips import grid_strips
from tessera.sources.tables import SourceNotReady, zone_lattice


def _axes(spark: SparkSession, folder: str, x: str, y: str, glob: str) -> DataFrame:
    """(file, axis, i, at) of both axes of every file; names without their folders."""
    name = F.regexp_extract("file", r"([^/]+)$", 1).alias("file")
    one = lambda v, a: netcdf_axis(spark, folder, v, glob).select(name, F.lit(a).alias("axis"), "i", F.col("x").alias("at"))
    return one(x, "x").union(one(y, "y"))


def regular_axes(axes: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """(file, axis, first, step, n) of axes that ascend by one step; others raise. A file's axes are held by one row each."""
    shape = axes.groupBy("file", "axis").agg(F.min_by("at", "i").alias("first"), F.max_by("at", "i").alias("last"), F.count("*").alias("n"))
    shape = shape.withColumn("step", (F.col("last") - F.col("first")) / F.when(F.col("n") > 1, F.col("n") - 1))
    met = axes.join(shape, ["file", "axis"])
    off = F.abs(F.col("at") - (F.col("first") + F.col("i") * F.col("step")))
    require(met, step=F.coalesce(F.min("step") > 0, F.lit(True)), regular=F.coalesce(F.max(off) <= F.greatest(F.lit(tolerance), F.max("step") * 1e-6), F.lit(True)))
    return shape.drop("last")


def zone_grids(spark: SparkSession, folder: str, parts: tuple[str, ...], steps: tuple[float, ...] = (0.05, 0.02), glob: str = "*.grd", pattern: str = r"([a-z]+)_[^/]*?_([a-z]+)_[^/]*$", expected: list[str] | None = None) -> DataFrame:
    """(zone, step, r, c, parts) of regional grids, a file for each zone and part, on the lattice of the zone's step.

    All parts of a zone are there and share one grid, whose axes ascend by one of
    ``steps`` on whole multiples of it, within the poles; ``expected`` names the zones.
    Depth turns positive and strike an axis. A node without any part has no row.
    """
    zone, part = (F.regexp_extract(F.regexp_extract("file", r"([^/]+)$", 1), pattern, k) for k in (1, 2))
    axes = regular_axes(_axes(spark, folder, "x", "y", glob)).withColumns({"zone": zone, "part": part})
    shapes = axes.groupBy("zone", "part").agg(
        F.max(F.when(F.col("axis") == "x", F.struct("first", "step", "n"))).alias("x"), F.max(F.when(F.col("axis") == "y", F.struct("first", "step", "n"))).alias("y")
    )
    zones = shapes.where(F.col("part").isin(*parts)).groupBy("zone").agg(F.count("*").alias("have"), F.min(F.struct("x", "y")).alias("least"), F.max(F.struct("x", "y")).alias("most")).withColumns({"x": F.col("least.x"), "y": F.col("least.y")})
    step = F.coalesce(*[F.when(F.abs(F.col("x.step") - s) <= 1e-9, F.lit(s)) for s in steps])
    zones = zones.withColumn("step", step)
    found = zones.select("zone", "have").collect()  # a row for each zone
    missing = [z for z in (expected or ()) if z not in {r.zone for r in found}] + [r.zone for r in found if r.have != len(parts)]
    if missing or not found:
        raise SourceNotReady(f"zones without all parts: {', '.join(sorted(missing)) or 'no zone'}")
    edge = lambda a: F.abs(F.col(f"{a}.first") / F.col("step") - F.rint(F.col(f"{a}.first") / F.col("step")))
    require(
        zones,
        **{
            "one grid": F.count_if(F.col("least") != F.col("most")) == 0,
            "step": F.count_if(F.col("step").isNull() | (F.abs(F.col("y.step") - F.col("step")) > 1e-9)) == 0,
            "lattice": F.coalesce(F.max(F.greatest(edge("x"), edge("y"))) < 1e-6, F.lit(True)),
            "poles": F.count_if((F.col("y.first") - F.col("step") / 2 < -90) | (F.col("y.first") + F.col("y.step") * (F.col("y.n") - 1) + F.col("step") / 2 > 90)) == 0,
        },
    )
    cells = grid_strips(spark, folder, "z", glob).withColumns({"zone": zone, "part": part}).where(F.col("part").isin(*parts) & finite(F.col("v")))
    rows = cells.groupBy("zone", "r", "c").agg(*[F.max(F.when(F.col("part") == p, F.col("v"))).alias(p) for p in parts])
    nodes = rows.join(zones.select("zone", "step", "x", "y"), "zone")
    nodes = nodes.select("zone", "step", (F.col("x.first") + F.col("c") * F.col("step")).alias("_x"), (F.col("y.first") + F.col("r") * F.col("step")).alias("_y"), *parts)
    out = None
    for s in steps:
        some = zone_lattice(nodes.where(F.col("step") == s), s, "zone", "_x", "_y").select("zone", "step", "r", "c", *parts)
        out = some if out is None else out.union(some)
    return out


def identical(df: DataFrame, a: str, b: str) -> DataFrame:
    """``df`` if two columns hold the same numbers in every row, missing where the other is missing."""
    return require(df, identical=F.count_if(~F.col(a).eqNullSafe(F.col(b))) == 0)


def named_axis(axis: DataFrame, first: float, step: float, n: int, defects: dict[int, float] | None = None) -> DataFrame:
    """(i, x) of a regular axis, by its numbers; a source's own value may differ only where ``defects`` says so, and just as it says."""
    known = F.create_map(*[F.lit(v) for kv in (defects or {-1: 0.0}).items() for v in kv])
    right = first + step * F.col("i")
    wrong = (F.col("x") != right) & ~F.coalesce(F.try_element_at(known, F.col("i")) == F.col("x"), F.lit(False))
    require(axis, axis=(F.count("*") == n) & (F.count_distinct("i") == n) & F.coalesce(F.min("i") == 0, F.lit(False)) & F.coalesce(F.max("i") == n - 1, F.lit(False)), **{"unknown defects": F.count_if(wrong) == 0})
    return axis.select("i", right.alias("x"))


def image_grid(spark: SparkSession, path: str, nlat: int, nlon: int, west: float = -180.0, north: float = 90.0, glob: str = "*.tif*") -> DataFrame:
    """(file, r, c, v), south first, of one-band images of the whole globe: size and corner are checked, and every cell has a finite value."""
    dx, dy = 360.0 / nlon, 180.0 / nlat
    corner = (F.abs(F.col("west") - west) < 1e-9) & (F.abs(F.col("north") - north) < 1e-9) & (F.abs(F.col("dx") - dx) < 1e-9) & (F.abs(F.col("dy") - dy) < 1e-9)
    require(geotiff_frames(spark, path, glob), files=F.count("*") > 0, size=F.count_if((F.col("nlat") != nlat) | (F.col("nlon") != nlon)) == 0, corner=F.count_if(~F.coalesce(corner, F.lit(False))) == 0)
    cells = grid_strips(spark, path, glob=glob)
    require(cells, values=F.count_if(~finite(F.col("v"))) == 0)
    return cells.select("file", (nlat - 1 - F.col("r")).alias("r"), "c", "v")


def closed_rings(points: DataFrame, titles: str, expected: int | None = None) -> DataFrame:
    """Vertex lists (line, title, seq, x, y) whose titles match and differ, and whose last vertex is the first; as many as ``expected``."""
    ends = points.groupBy("line").agg(F.min("title").alias("title"), F.min_by(F.struct("x", "y"), "seq").alias("a"), F.max_by(F.struct("x", "y"), "seq").alias("b"), F.count("*").alias("n"))
    rules = {"closed": F.count_if((F.col("a") != F.col("b")) | (F.col("n") < 4)) == 0, "titles": (F.count_if(~F.col("title").rlike(titles)) == 0) & (F.count_distinct("title") == F.count("*"))}
    if expected is not None:
        rules["number of rings"] = F.count("*") == expected
    require(ends, **rules)
    return points


__all__ = ["SourceMismatch", "closed_rings", "identical", "image_grid", "named_axis", "regular_axes", "zone_grids"]

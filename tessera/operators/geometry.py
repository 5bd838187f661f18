"""Spherical geometry and containment as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.grid import RADIUS_KM
from tessera.operators.polygons import fill


def unit_vector(lat: Column, lon: Column) -> list[Column]:
    a, b = F.radians(lat), F.radians(lon)
    return [F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)]


def dot(a: list[Column], b: list[Column]) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def _unit(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(-1.0)), F.lit(1.0))


def segments(points: DataFrame, line: str, order: str) -> DataFrame:
    """(line, lat, lon, lat2, lon2) of consecutive vertices; repeated vertices make none."""
    w = Window.partitionBy(line).orderBy(order)
    out = points.select(line, order, "lat", "lon", F.lead("lat").over(w).alias("lat2"), F.lead("lon").over(w).alias("lon2"))
    return out.where("lat2 is not null and not (lat = lat2 and lon = lon2)")


def segment_distance(p: list[Column], a: list[Column], b: list[Column], n: list[Column] | None = None) -> Column:
    """Kilometres from a point to a great-circle segment: to its foot, or to the nearer end. n: ``cross(a, b)`` where it is a column already."""
    n = n or cross(a, b)
    size = F.sqrt(dot(n, n))
    foot = (dot(cross(n, p), a) <= 0) & (dot(cross(n, p), b) >= 0)
    return F.when(foot & (size > 0), F.lit(RADIUS_KM) * F.abs(F.asin(_unit(dot(p, n) / size)))).otherwise(F.lit(RADIUS_KM) * F.acos(_unit(F.greatest(dot(p, a), dot(p, b)))))


def haversine(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    h = F.pow(F.sin(F.radians(lat2 - lat) / 2), F.lit(2)) + F.cos(F.radians(lat)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon) / 2), F.lit(2))
    return F.lit(2 * RADIUS_KM) * F.asin(F.sqrt(_unit(h)))


def inside(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd ray cast against a closed ring of struct(x, y)."""
    after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    crossed = F.zip_with(ring, after, lambda a, b: ((a.y > y) != (b.y > y)) & (x < (b.x - a.x) * (y - a.y) / F.when(b.y != a.y, b.y - a.y) + a.x))
    return F.size(F.filter(crossed, lambda v: F.coalesce(v, F.lit(False)))) % 2 == 1


def inside_rings(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd cast against a polygon's exterior and interior rings: a point in a hole is outside."""
    return F.size(F.filter(rings, lambda ring: inside(x, y, ring))) % 2 == 1


def close_pole(ring: Column, winding: Column) -> Column:
    """An unwound closed ring of struct(x, y) that goes round the globe once, as a polygon: it is led along its pole's parallel.

    winding: 1 of a ring that runs eastward round the north pole, -1 of one that runs
    westward round the south pole, so that its inside is on its left; 0 leaves the ring.
    """
    pole = F.when(winding > 0, 90.0).otherwise(-90.0)
    corner = lambda p: F.struct(p.x.alias("x"), pole.alias("y"))
    last, first = F.element_at(ring, -1), F.element_at(ring, 1)
    return F.when(winding == 0, ring).otherwise(F.concat(ring, F.array(corner(last), corner(first), first)))


def turned_copies(polygons: DataFrame, ring: str = "ring") -> DataFrame:
    """Each unwound ring as it is and a turn east and west, where such a copy meets [-180, 180]; column turn."""
    out = polygons.withColumn("turn", F.explode(F.array(F.lit(-360.0), F.lit(0.0), F.lit(360.0))))
    out = out.withColumn(ring, F.transform(ring, lambda p: F.struct((p.x + F.col("turn")).alias("x"), p.y.alias("y"))))
    xs = F.transform(ring, lambda p: p.x)
    return out.where((F.array_max(xs) > -180) & (F.array_min(xs) < 180))


def burn_rings(polygons: DataFrame, res: float, nlat: int, nlon: int, rings: str = "rings") -> DataFrame:
    """Cells of polygons with holes, an array of rings, as ``polygons.fill`` finds them: all other columns, r and c."""
    return fill(polygons, res, nlat, nlon, rings)


def segment_faults(segs: DataFrame) -> DataFrame:
    """(dropped, long): segments shorter than 1e-12 of the radius, which ``segments`` should not make, and those of 90 degrees or more."""
    a, b = unit_vector(F.col("lat"), F.col("lon")), unit_vector(F.col("lat2"), F.col("lon2"))
    n = cross(a, b)
    return segs.agg(F.count_if((F.sqrt(dot(n, n)) < 1e-12) & (dot(a, b) > 0)).alias("dropped"), F.count_if(dot(a, b) <= 0).alias("long"))


def require_short(segs: DataFrame) -> DataFrame:
    """``segs`` if all are shorter than 90 degrees."""
    if wrong := segment_faults(segs).first()["long"]:
        raise ValueError(f"{wrong} segments of 90 degrees or more")
    return segs


def cross_track(p_lat: Column, p_lon: Column, lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres from a point to the great circle of a segment, by bearings."""
    def bearing(a, b, c, d):
        return F.atan2(F.sin(F.radians(d - b)) * F.cos(F.radians(c)), F.cos(F.radians(a)) * F.sin(F.radians(c)) - F.sin(F.radians(a)) * F.cos(F.radians(c)) * F.cos(F.radians(d - b)))

    arc = haversine(lat, lon, p_lat, p_lon) / RADIUS_KM
    return F.abs(F.asin(_unit(F.sin(arc) * F.sin(bearing(lat, lon, p_lat, p_lon) - bearing(lat, lon, lat2, lon2))))) * RADIUS_KM


def burn(polygons: DataFrame, res: float, nlat: int, nlon: int, ring: str = "ring") -> DataFrame:
    """``burn_rings`` of polygons of one ring."""
    return fill(polygons.withColumn(ring, F.array(ring)), res, nlat, nlon, ring)


def split_dateline(segs: DataFrame) -> DataFrame:
    """Segments that cross the dateline become two, cut at the interpolated latitude."""
    jump = F.abs(F.col("lon2") - F.col("lon")) > 180
    side = F.when(F.col("lon") > 0, 180.0).otherwise(-180.0)
    reach = F.col("lon2") + 2 * side - F.col("lon")
    cut = F.when(reach != 0, F.col("lat") + (F.col("lat2") - F.col("lat")) * (side - F.col("lon")) / reach).otherwise(F.col("lat"))
    part = lambda a, b, c, d: F.struct(a.alias("lat"), b.alias("lon"), c.alias("lat2"), d.alias("lon2"))
    lat, lon, lat2, lon2 = (F.col(x) for x in ("lat", "lon", "lat2", "lon2"))
    rest = [c for c in segs.columns if c not in ("lat", "lon", "lat2", "lon2")]
    parts = F.when(jump, F.array(part(lat, lon, cut, side), part(cut, -side, lat2, lon2))).otherwise(F.array(part(lat, lon, lat2, lon2)))
    return segs.select(*rest, F.posexplode(parts).alias("part", "s")).select(*rest, "part", "s.*")

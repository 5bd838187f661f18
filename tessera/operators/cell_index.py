"""Cells as integer keys, level by level: which polygons hold a point, and which segment is nearest to it.

Containment: the globe in degrees is halved in both directions down to a level. A
polygon's cells there are full, or hold some of its edges and know whether their
centre is inside; four full cells become one of the level above. Cells with many
edges are quartered further, and a quarter's centre is told from its parent's by the
edges between the two. A point meets one cell of each level by an equi-join, and in a
cell with edges it is told from the centre in the same way.

Nearest: unit vectors lie in cubes that are halved in three directions. Segments are
cut into pieces no longer than a cube of the last level, and a piece belongs to the
cube of its middle. From the top, a point keeps those cubes that can hold its nearest
piece, meets their parts by an equi-join, and computes distances only in the last
ones. Candidates are few on every level, however far the nearest segment is, and no
pole or dateline is special.

Geometry is never broadcast; what Spark broadcasts by itself it measures first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.geometry import segment_distance, unit_vector
from tessera.operators.polygons import edges, runs
from tessera.sources.scratch import kept

#: Halvings of the globe for containment, and for cells with more than so many edges, at most.
LEVEL, DEEPEST, MANY = 6, 14, 32
#: Degrees by which edges count for cells beside them, so that rounding loses none.
_EPS = 1e-9
_CELLS = ["level", "ix", "iy", "fid", "edges", "centre"]
#: Halvings of the cubes, and how many are taken in one step.
CUBES, STEP = 6, 2


def _side(level: Column) -> Column:
    return F.pow(F.lit(2.0), -level)


def _path_odd(px: Column, py: Column, qx: Column, qy: Column, edge_list: Column) -> Column:
    """Whether an odd number of edges lies between two points: along the parallel of the first, then the meridian of the second.

    A point's side of an edge is told once, from the edge's place on the point's
    parallel as the scanline has it; above and below follow from that, so that the
    path's corner and its ends may lie on an edge.
    """

    def crossed(e):
        def left(x, y):
            place = (e.x2 - e.x1) * (y - e.y1) / F.when(e.y2 != e.y1, e.y2 - e.y1) + e.x1
            return F.when((e.x1 > x) == (e.x2 > x), e.x1 > x).otherwise(x < place)

        def below(x, y):
            return F.when((e.y1 > y) == (e.y2 > y), e.y1 > y).otherwise(left(x, y) != ((e.x2 > e.x1) == (e.y2 > e.y1)))

        along = ((e.y1 > py) != (e.y2 > py)) & (left(px, py) != left(qx, py))
        up = ((e.x1 > qx) != (e.x2 > qx)) & (below(qx, py) != below(qx, qy))
        return along.cast("int") + up.cast("int")

    return F.aggregate(F.transform(edge_list, crossed), F.lit(0), lambda a, n: a + n) % 2 == 1


def _spread(edge_rows: DataFrame, level: int) -> DataFrame:
    """(ix, iy) of each cell of a level that an edge touches, with its columns."""
    n = 1 << level
    w, h = 360.0 / n, 180.0 / n
    row = lambda y: F.least(F.greatest(F.floor((y + 90) / h), F.lit(0)), F.lit(n - 1))
    col = lambda x: F.least(F.greatest(F.floor((x + 180) / w), F.lit(0)), F.lit(n - 1))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    out = edge_rows.withColumn("iy", F.explode(F.sequence(row(low - _EPS), row(high + _EPS))))
    # the part of the edge within the row, a little more on both sides
    a, b = F.greatest(F.col("iy") * h - 90 - _EPS, low), F.least((F.col("iy") + 1) * h - 90 + _EPS, high)
    at = lambda y: F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise((F.col("x2") - F.col("x1")) * (y - F.col("y1")) / F.when(F.col("y2") != F.col("y1"), F.col("y2") - F.col("y1")) + F.col("x1"))
    ends = [F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(at(a)), F.when(F.col("y1") == F.col("y2"), F.col("x2")).otherwise(at(b))]
    return out.withColumn("ix", F.explode(F.sequence(col(F.least(*ends) - _EPS), col(F.greatest(*ends) + _EPS))))


def cover(polygons: DataFrame, fid: str = "fid", rings: str = "rings", level: int = LEVEL, deepest: int = DEEPEST, many: int = MANY) -> DataFrame:
    """(level, ix, iy, fid, edges, centre): cells of each polygon, with edges null where a cell is full.

    fid is unique; rings in degrees within [-180, 180], as ``turned_copies`` makes
    them. Two polygons may cover a cell alike.
    """
    n = 1 << level
    flat = edges(polygons.select(F.col(fid).alias("fid"), rings), rings)
    edge = F.struct("x1", "y1", "x2", "y2")
    held = _spread(flat, level).groupBy("ix", "iy", "fid").agg(F.collect_list(edge).alias("edges"))
    told = runs(flat, 360.0 / n, n, n, ["fid"], height=180.0 / n)
    centres = told.select("fid", F.col("r").cast("long").alias("iy"), F.explode(F.sequence(F.col("c0").cast("long"), F.col("c1").cast("long"))).alias("ix"))
    both = held.join(centres.withColumn("centre", F.lit(True)), ["fid", "ix", "iy"], "full")
    now = kept(both.select(F.lit(level).alias("level"), "ix", "iy", "fid", "edges", F.coalesce("centre", F.lit(False)).alias("centre")), "cover")
    done, full = [now.where(F.col("edges").isNotNull() & (F.size("edges") <= many)) if deepest > level else now.where("edges is not null")], now.where("edges is null")
    big = now.where(F.col("edges").isNotNull() & (F.size("edges") > many))
    for deeper in range(level + 1, deepest + 1):
        if not big.limit(1).count():
            break
        kids = kept(_quartered(big, deeper), "quarters")
        done.append(kids.where(F.col("edges").isNull() & F.col("centre")))
        some = kids.where("edges is not null")
        done.append(some if deeper == deepest else some.where(F.size("edges") <= many))
        big = some.where(F.size("edges") > many)
    # a cell above is full if all it holds down here is; of these, the highest stay
    above = full.select("fid", "ix", "iy", F.explode(F.sequence(F.lit(0), F.lit(level))).alias("level"))
    at = [F.expr(f"shiftright({c}, {level} - level)").alias(c) for c in ("ix", "iy")]
    whole = above.select("fid", "level", *at).groupBy("fid", "level", "ix", "iy").agg(F.count("*").alias("n"))
    whole = kept(whole.where(F.col("n") == F.expr(f"shiftleft(1L, 2 * ({level} - level))")).drop("n"), "full")
    parents = whole.select("fid", (F.col("level") + 1).alias("level"), F.col("ix").alias("_x"), F.col("iy").alias("_y"))
    own = whole.withColumns({"_x": F.expr("ix div 2"), "_y": F.expr("iy div 2")}).join(parents, ["fid", "level", "_x", "_y"], "left_anti")
    done.append(own.withColumns({"edges": F.lit(None).cast(now.schema["edges"].dataType), "centre": F.lit(True)}))
    return reduce(DataFrame.union, [x.select(*_CELLS) for x in done])


def _quartered(cells: DataFrame, level: int) -> DataFrame:
    """The quarters of cells with edges: each with the edges that can touch it (null if none), and whether its centre is inside."""
    n = 1 << level
    w, h = 360.0 / n, 180.0 / n
    kid = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)]))
    kids = cells.withColumn("_k", kid).withColumns({"_x": F.col("ix") * 2 + F.col("_k.a"), "_y": F.col("iy") * 2 + F.col("_k.b")})
    px, py = (F.col("ix") + 0.5) * (2 * w) - 180, (F.col("iy") + 0.5) * (2 * h) - 90
    cx, cy = (F.col("_x") + 0.5) * w - 180, (F.col("_y") + 0.5) * h - 90
    kids = kids.withColumns({"_px": px, "_py": py, "_cx": cx, "_cy": cy})  # under names of their own: below, ix and iy are the quarter's
    px, py, cx, cy = (F.col(c) for c in ("_px", "_py", "_cx", "_cy"))
    near = lambda e: (F.least(e.x1, e.x2) <= cx + w / 2 + _EPS) & (F.greatest(e.x1, e.x2) >= cx - w / 2 - _EPS) & (F.least(e.y1, e.y2) <= cy + h / 2 + _EPS) & (F.greatest(e.y1, e.y2) >= cy - h / 2 - _EPS)
    some = F.filter("edges", near)
    kids = kids.withColumns({"_in": F.col("centre") != _path_odd(cx, cy, px, py, F.col("edges")), "_some": F.when(F.size(some) > 0, some)})
    return kids.select(F.lit(level).alias("level"), F.col("_x").alias("ix"), F.col("_y").alias("iy"), "fid", F.col("_some").alias("edges"), F.col("_in").alias("centre"))


def _beside(px: Column, py: Column, edge_list: Column) -> Column:
    """Whether an edge runs so close to a point that rounding tells its side; no farther than ``cover`` counts edges for cells beside them."""
    eps = _EPS / 2

    def close(e):
        across = F.abs((e.x2 - e.x1) * (py - e.y1) / F.when(e.y2 != e.y1, e.y2 - e.y1) + e.x1 - px) <= eps
        up = F.abs((e.y2 - e.y1) * (px - e.x1) / F.when(e.x2 != e.x1, e.x2 - e.x1) + e.y1 - py) <= eps
        within = px.between(F.least(e.x1, e.x2) - eps, F.greatest(e.x1, e.x2) + eps) & py.between(F.least(e.y1, e.y2) - eps, F.greatest(e.y1, e.y2) + eps)
        return within & (F.coalesce(across, F.lit(False)) | F.coalesce(up, F.lit(False)))

    return F.exists(edge_list, close)


def contained(points: DataFrame, cells: DataFrame, id_: str = "id", lat: str = "lat", lon: str = "lon", deepest: int = DEEPEST, decide: Column | None = None) -> DataFrame:
    """(id, fid) of each point and each polygon of ``cover`` that holds it; a point without a finite place is in none.

    decide: a test of ``lat``, ``lon`` and ``fid`` for points on an edge but for
    rounding, where the polygon's source says more than its rounded corners; without
    it they are told like all others.
    """
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    at = points.where(x.between(-180, 180) & y.between(-90, 90)).select(F.col(id_).alias("id"), x.alias("_px"), y.alias("_py"))
    n = F.expr("shiftleft(1L, level)")
    cell = lambda v, origin, span: F.least(F.floor((v + origin) / span * n), n - 1).cast("long")
    at = at.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(deepest)))).withColumns({"ix": cell(F.col("_px"), 180.0, 360.0), "iy": cell(F.col("_py"), 90.0, 180.0)})
    met = at.join(cells, ["level", "ix", "iy"])
    cx, cy = (F.col("ix") + 0.5) * 360 * _side(F.col("level")) - 180, (F.col("iy") + 0.5) * 180 * _side(F.col("level")) - 90
    inside = F.when(F.col("edges").isNull(), F.lit(True)).otherwise(F.col("centre") != _path_odd(F.col("_px"), F.col("_py"), cx, cy, F.col("edges")))
    if decide is not None:
        met = met.withColumns({"lat": F.col("_py"), "lon": F.col("_px")})
        inside = F.when(F.coalesce(_beside(F.col("_px"), F.col("_py"), F.col("edges")), F.lit(False)), decide).otherwise(inside)
    return met.where(inside).select("id", "fid")


def _cube(v: list[Column], level: int) -> list[Column]:
    n = 1 << level
    return [F.least(F.greatest(F.floor((x + 1) / 2 * n), F.lit(0)), F.lit(n - 1)).cast("int") for x in v]


def _key(cube: list[Column], level: int) -> Column:
    n = 1 << level
    return (cube[0].cast("long") * n + cube[1]) * n + cube[2]


def pieces(segs: DataFrame, sid: str, level: int = CUBES) -> DataFrame:
    """(cube, sid, lat, lon, lat2, lon2): segments under 90 degrees, once for each cube of a level that the middle of one of their pieces is in."""
    side = 2.0 / (1 << level)
    a, b = unit_vector(F.col("lat"), F.col("lon")), unit_vector(F.col("lat2"), F.col("lon2"))
    arc = F.acos(F.least(F.greatest(a[0] * b[0] + a[1] * b[1] + a[2] * b[2], F.lit(-1.0)), F.lit(1.0)))
    rows = segs.select(F.col(sid).alias("sid"), "lat", "lon", "lat2", "lon2", arc.alias("_w")).withColumn("_n", F.greatest(F.ceil(F.col("_w") / side), F.lit(1)))
    rows = rows.withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).withColumn("_t", (F.col("_t") + 0.5) / F.col("_n"))
    short = F.sin("_w") < 1e-12
    p, q = (F.when(short, other).otherwise(F.sin(part * F.col("_w")) / F.when(~short, F.sin("_w"))) for part, other in ((1 - F.col("_t"), 1 - F.col("_t")), (F.col("_t"), F.col("_t"))))
    middle = [x * p + y * q for x, y in zip(a, b)]
    return rows.select(_key(_cube(middle, level), level).alias("cube"), "sid", "lat", "lon", "lat2", "lon2").distinct()


def nearest(points: DataFrame, segs: DataFrame, id_: str = "id", sid: str = "sid", level: int = CUBES, step: int = STEP) -> DataFrame:
    """(id, sid, km): the nearest segment of each point (of equal ones the smallest sid) and its great-circle distance.

    points: unique ids with lat and lon; segs: sid, lat, lon, lat2, lon2, each shorter
    than 90 degrees (``require_short``). Points without a finite place have no row;
    without segments nothing has.
    """
    # of equal segments the smallest sid wins wherever one does
    alike = segs.groupBy("lat", "lon", "lat2", "lon2").agg(F.min(sid).alias(sid))
    cut = kept(pieces(alike, sid, level), "pieces")
    side = 2.0 / (1 << level)
    v = unit_vector(F.col("lat"), F.col("lon"))
    finite = F.col("lat").between(-90, 90) & (F.abs("lon") <= 360)
    near = points.where(finite).select(F.col(id_).alias("id"), F.col("lat").alias("plat"), F.col("lon").alias("plon"), *[x.alias(f"_v{k}") for k, x in enumerate(v)], F.array(F.lit(0).cast("long")).alias("cubes"))
    carry = ["id", "plat", "plon", "_v0", "_v1", "_v2"]
    filled, levels = cut.select("cube").distinct(), [*range(step, level, step), level]

    def raised(cube: Column, down: int, to: int) -> Column:
        """Key at a higher level of a cube's key at a lower one."""
        n, k = 1 << down, down - to
        parts = [F.shiftright(F.expr(f"cast(cube div {n * n} as int)"), k), F.shiftright(F.expr(f"cast((cube div {n}) % {n} as int)"), k), F.shiftright(F.expr(f"cast(cube % {n} as int)"), k)]
        return _key(parts, to)

    before = 0
    for here in levels:
        kids = filled.select(raised(F.col("cube"), level, before).alias("_up"), raised(F.col("cube"), level, here).alias("kid")).distinct().groupBy("_up").agg(F.collect_list("kid").alias("kids"))
        n, size = 1 << here, 2.0 / (1 << here)
        low = [(F.floor(F.col("kid") / (n * n)) * size - 1), (F.floor(F.col("kid") / n) % n * size - 1), (F.col("kid") % n * size - 1)]
        own = [F.col(f"_v{k}") for k in range(3)]
        least = F.sqrt(sum((F.pow(F.greatest(a - x, x - a - size, F.lit(0.0)), F.lit(2)) for a, x in zip(low, own)), F.lit(0.0)))
        most = F.sqrt(sum((F.pow(F.greatest(F.abs(x - a), F.abs(x - a - size)), F.lit(2)) for a, x in zip(low, own)), F.lit(0.0)))
        met = near.withColumn("_up", F.explode("cubes")).drop("cubes").join(kids, "_up").withColumn("kid", F.explode("kids"))
        # a piece's middle is in its cube, its ends within half a side of that
        told = met.select(*carry, F.struct("kid", F.greatest(least - side / 2 - 1e-9, F.lit(0.0)).alias("a"), most.alias("b")).alias("k"))
        near = told.groupBy(*carry).agg(F.collect_list("k").alias("_k"), F.min("k.b").alias("_b"))
        near = near.select(*carry, F.expr("transform(filter(_k, k -> k.a <= _b + 1e-9), k -> k.kid)").alias("cubes"))
        before = here
    met = near.withColumn("cube", F.explode("cubes")).drop("cubes").join(cut, "cube")
    km = segment_distance([F.col("_v0"), F.col("_v1"), F.col("_v2")], unit_vector(F.col("lat"), F.col("lon")), unit_vector(F.col("lat2"), F.col("lon2")))
    return met.groupBy("id").agg(F.min(F.struct(km.alias("km"), F.col("sid").alias("sid"))).alias("m")).select("id", "m.sid", "m.km")


def held_or_nearest(points: DataFrame, polygons: DataFrame, id_: str = "id", fid: str = "fid", rings: str = "rings", decide: Column | None = None) -> DataFrame:
    """(id, fid, km, held): a polygon that holds a point (the smallest fid) at 0 km, else the polygon with the nearest edge and its distance.

    Of polygons with the same rings only that of the smallest fid can be found, so
    the others go first. decide: as for ``contained``.
    """
    polygons = kept(polygons.groupBy(rings).agg(F.min(fid).alias(fid)), "polygons")
    flat = edges(polygons.select(F.col(fid).alias("sid"), rings), rings)
    segs = flat.select("sid", F.col("y1").alias("lat"), F.col("x1").alias("lon"), F.col("y2").alias("lat2"), F.col("x2").alias("lon2"))
    segs = segs.where("not (lat = lat2 and lon = lon2)")
    inside = kept(contained(points, cover(polygons, fid, rings), id_, decide=decide).groupBy("id").agg(F.min("fid").alias("fid")), "inside")
    outside = points.join(inside.select(F.col("id").alias(id_)), id_, "left_anti")
    found = nearest(outside, segs, id_).select("id", F.col("sid").alias("fid"), "km", F.lit(False).alias("held"))
    return inside.select("id", "fid", F.lit(0.0).alias("km"), F.lit(True).alias("held")).union(found)

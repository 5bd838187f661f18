"""Registered queries of the cube operators and their oracle SQL.

Sums that rows' order could change are sums of integers, or rounded on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import grid, text
from tessera.operators import geometry, kernels, lines, merge, spectra, stats, windows
from tessera.plans import adapters as ad

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query by its function's name, with its oracle SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def r6(x, digits: int = 6) -> Column:
    return F.round(x, digits)


R = f"{grid.RADIUS_KM}::DOUBLE"
_WRAP = "((({0} + 180) % 360 + 360) % 360 - 180)"


def _cells(k: int = 1) -> str:
    return f"""CAST(least(greatest(floor((lat + 90) * {k}), 0), {180 * k - 1}) AS INT) AS r, CAST(least(greatest(floor(({_WRAP.format('lon')} + 180) * {k}), 0), {360 * k - 1}) AS INT) AS c"""


#: Off the decimal lattice of the points, so that no point lies on a cell's edge but for rounding.
_OFF = 0.0003
_HOME = f"SELECT r, c, count(*) AS n FROM (SELECT {_cells(20)} FROM (SELECT lat + {_OFF}::DOUBLE AS lat, lon + {_OFF}::DOUBLE AS lon FROM ({ad.POINTS_SQL}))) GROUP BY 1, 2"


# cells, coordinates, areas


@query(f"""SELECT CAST(range AS INT) AS r, round(range + 0.5 - 90, 6) AS lat, round({R}*{R}*radians(1)*(sin(radians(range+1-90.0::DOUBLE)) - sin(radians(range-90.0::DOUBLE))), 4) AS area_km2, coalesce(n, 0) AS n
  FROM range(180) LEFT JOIN (SELECT least(CAST(floor(lat + 90) AS BIGINT), 179) AS range, count(*) AS n FROM ({ad.POINTS_SQL}) GROUP BY 1) USING (range)""")
def pixel_area_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's cell area, and the points that lie in the row."""
    held = ad.points(spark, sf_dir).groupBy(grid.row_of(F.col("lat"), "1deg").alias("r")).agg(F.count("*").alias("n"))
    rows = grid.row_areas(spark, "1deg").join(held, "r", "left")
    return rows.select("r", r6(F.col("lat")).alias("lat"), r6(F.col("area_km2"), 4).alias("area_km2"), F.coalesce("n", F.lit(0)).alias("n"))


@query(f"SELECT event_id, round({_WRAP.format('(lon * 3)')}, 6) AS lon FROM ({ad.POINTS_SQL})")
def wrap_lon(spark, sf_dir):
    return ad.points(spark, sf_dir).select("event_id", r6(grid.wrap_lon(F.col("lon") * 3)).alias("lon"))


@query(f"SELECT event_id, CAST(floor(round_even(lat * 10 * 1e6, 0) / 1e6) AS BIGINT) AS kr, CAST(floor(round_even(lon * 10 * 1e6, 0) / 1e6) AS BIGINT) AS kc FROM ({ad.POINTS_SQL})")
def pixel_keys(spark, sf_dir):
    return ad.points(spark, sf_dir).select("event_id", grid.pixel_key(F.col("lat")).alias("kr"), grid.pixel_key(F.col("lon")).alias("kc"))


@query(f"SELECT r, c, count(*) AS n FROM (SELECT {_cells()} FROM ({ad.POINTS_SQL})) GROUP BY 1, 2")
def point_density_1deg(spark, sf_dir):
    return ad.points(spark, sf_dir).groupBy(grid.row_of(F.col("lat"), "1deg").alias("r"), grid.col_of(F.col("lon"), "1deg").alias("c")).agg(F.count("*").alias("n"))


def _home(spark, sf_dir):
    # a point at the pole stays in the last row
    return ad.points(spark, sf_dir).groupBy(grid.row_of(F.least(F.col("lat") + _OFF, F.lit(90.0)), "3min").alias("r"), grid.col_of(F.col("lon") + _OFF, "3min").alias("c")).agg(F.count("*").alias("n"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS tier, CAST(r // {f} AS INT) AS r, CAST(c // {f} AS INT) AS c, CAST(sum(n) AS BIGINT) AS n FROM ({_HOME}) GROUP BY 1, 2, 3" for t, f in (("6min", 2), ("30min", 10), ("1deg", 20))))
def density_pyramid(spark, sf_dir):
    home = _home(spark, sf_dir)
    tiers = [kernels.block_sum(home, grid.factor(t, "3min")).withColumn("tier", F.lit(t)) for t in ("6min", "30min", "1deg")]
    return tiers[0].unionByName(tiers[1]).unionByName(tiers[2])


@query(f"SELECT CAST(a.range AS INT) AS r, CAST(coalesce(sum(n), 0) AS BIGINT) AS n, count(n) AS covered FROM range(180) a CROSS JOIN range(360) b LEFT JOIN (SELECT r, c, count(*) AS n FROM (SELECT {_cells()} FROM ({ad.POINTS_SQL})) GROUP BY 1, 2) x ON x.r = a.range AND x.c = b.range GROUP BY 1")
def dense_completion(spark, sf_dir):
    full = grid.dense_grid(spark, "1deg").join(point_density_1deg(spark, sf_dir), ["r", "c"], "left")
    return full.groupBy("r").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("n").alias("covered"))


# kernels


def _mode_sql(f: int, nodata: bool) -> str:
    value = "v % 5"
    return f"""WITH x AS (SELECT CAST(r // {f} AS INT) AS r, CAST(c // {f} AS INT) AS c, CAST({value} AS BIGINT) AS v FROM ({ad.RASTER_SQL})),
      n AS (SELECT r, c, v, count(*) AS n FROM x {'WHERE v <> 0' if nodata else ''} GROUP BY 1, 2, 3),
      b AS (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY n DESC, v) AS k FROM n)
      SELECT g.r, g.c, CAST(coalesce(b.v, 0) AS BIGINT) AS v FROM (SELECT DISTINCT r, c FROM x) g LEFT JOIN b ON g.r = b.r AND g.c = b.c AND k = 1"""


@query(_mode_sql(4, False))
def block_mode(spark, sf_dir):
    return kernels.block_mode(ad.raster(spark, sf_dir).withColumn("v", F.col("v") % 5), 4)


@query(_mode_sql(3, True))
def block_mode_nodata(spark, sf_dir):
    return kernels.block_mode(ad.raster(spark, sf_dir).withColumn("v", F.col("v") % 5), 3, nodata=0)


_W36 = f"({R}*{R}*radians(5)*(sin(radians((r+1)*5-90.0::DOUBLE)) - sin(radians(r*5-90.0::DOUBLE))))"


@query(f"SELECT CAST(r // 2 AS INT) AS r, CAST(c // 2 AS INT) AS c, round(sum(v * w) / sum(w), 5) AS v FROM (SELECT *, {_W36} AS w FROM ({ad.RASTER_SQL})) GROUP BY 1, 2")
def block_weighted(spark, sf_dir):
    cells = ad.raster(spark, sf_dir).withColumn("w", grid.area_km2(F.col("r") * 5 - F.lit(90.0), (F.col("r") + 1) * 5 - F.lit(90.0), 5.0))
    return kernels.block_weighted(cells, 2).withColumn("v", r6(F.col("v"), 5))


def _overlaps(spark, sf_dir):
    """The 5 degree toy raster on nodes (edges shifted by half a cell) against 4 degree targets; values with holes."""
    u = grid.UNITS
    src = ad.raster(spark, sf_dir).withColumn("v", F.when(F.col("v") % 7 != 0, F.col("v").cast("double")))
    x0 = F.col("c").cast("long") * 5 * u - 5 * u // 2
    return kernels.overlaps(src, x0, x0 + 5 * u, F.col("r").cast("long") * 5 * u, (F.col("r").cast("long") + 1) * 5 * u, 4 * u)


_U = grid.UNITS
_OVER = f"""SELECT CAST(j AS INT) AS r, CAST((i % 90 + 90) % 90 AS INT) AS c, v,
  (least(x1, (i + 1) * {4 * _U}) - greatest(x0, i * {4 * _U})) * (sin(radians(CAST(least(y1, (j + 1) * {4 * _U}) AS DOUBLE) / {_U} - 90)) - sin(radians(CAST(greatest(y0, j * {4 * _U}) AS DOUBLE) / {_U} - 90))) AS w
  FROM (SELECT *, unnest(range(CAST(floor(CAST(x0 AS DOUBLE) / {4 * _U}) AS BIGINT), CAST(floor(CAST(x1 - 1 AS DOUBLE) / {4 * _U}) AS BIGINT) + 1)) AS i FROM
   (SELECT *, unnest(range(CAST(y0 // {4 * _U} AS BIGINT), CAST((y1 - 1) // {4 * _U} AS BIGINT) + 1)) AS j FROM
    (SELECT v, c * {5 * _U} - {5 * _U // 2} AS x0, c * {5 * _U} + {5 * _U - 5 * _U // 2} AS x1, r * {5 * _U} AS y0, (r + 1) * {5 * _U} AS y1 FROM
     (SELECT r, c, CASE WHEN v % 7 <> 0 THEN CAST(v AS DOUBLE) END AS v FROM ({ad.RASTER_SQL})))))"""


@query(f"SELECT r, c, round(sum(v * w) / sum(w), 5) AS v, round(sum(w), 4) AS weight FROM ({_OVER}) WHERE v IS NOT NULL GROUP BY 1, 2")
def overlap_mean(spark, sf_dir):
    return kernels.overlap_mean(_overlaps(spark, sf_dir)).select("r", "c", r6(F.col("v"), 5).alias("v"), r6(F.col("weight"), 4).alias("weight"))


@query(f"""SELECT round((SELECT sum(v * w) FROM ({_OVER}) WHERE v IS NOT NULL) / 1000, 2) AS target,
  round((SELECT sum(v * {5 * _U} * (sin(radians((r+1)*5-90.0::DOUBLE)) - sin(radians(r*5-90.0::DOUBLE)))) FROM (SELECT r, CASE WHEN v % 7 <> 0 THEN CAST(v AS DOUBLE) END AS v FROM ({ad.RASTER_SQL})) WHERE v IS NOT NULL) / 1000, 2) AS source""")
def overlap_weight_integral(spark, sf_dir):
    target = kernels.overlap_mean(_overlaps(spark, sf_dir)).agg(F.round(F.sum(F.col("v") * F.col("weight")) / 1000, 2).alias("target"))
    v = F.when(F.col("v") % 7 != 0, F.col("v").cast("double"))
    height = F.sin(F.radians((F.col("r") + 1) * 5 - F.lit(90.0))) - F.sin(F.radians(F.col("r") * 5 - F.lit(90.0)))
    source = ad.raster(spark, sf_dir).agg(F.round(F.sum(v * 5 * grid.UNITS * height) / 1000, 2).alias("source"))
    return target.join(source)


_AX = "(CAST(v AS DOUBLE) * 0.37) % 180"


@query(f"""SELECT CAST(r // 4 AS INT) AS r, CAST(c // 4 AS INT) AS c, round(((degrees(atan2(sum(sin(radians(2 * t))), sum(cos(radians(2 * t))))) / 2) % 180 + 180) % 180, 4) AS theta,
  round(sqrt(avg(cos(radians(2 * t))) * avg(cos(radians(2 * t))) + avg(sin(radians(2 * t))) * avg(sin(radians(2 * t)))), 6) AS resultant
  FROM (SELECT r, c, {_AX} AS t FROM ({ad.RASTER_SQL})) GROUP BY 1, 2""")
def axial_mean(spark, sf_dir):
    t = (F.col("v").cast("double") * 0.37) % 180
    blocks = ad.raster(spark, sf_dir).groupBy(F.expr("int(r div 4)").alias("r"), F.expr("int(c div 4)").alias("c"))
    return blocks.agg(F.round(kernels.axial_mean(t, F.lit(1.0)), 4).alias("theta"), r6(kernels.resultant_length(t)).alias("resultant"))


@query(f"""WITH d AS (SELECT unnest([0, 1]) AS a), x AS (SELECT CAST(r - a.a AS INT) AS r, CAST((c - b.a + 72) % 72 AS INT) AS c, v % 4 AS v FROM ({ad.RASTER_SQL}) CROSS JOIN d a CROSS JOIN d b),
  n AS (SELECT r, c, v, count(*) AS n FROM x WHERE r BETWEEN 0 AND 34 GROUP BY 1, 2, 3)
  SELECT r, c, CAST(v + 1 AS BIGINT) AS v FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY n DESC, v) AS k FROM n) WHERE k = 1""")
def zone_corner_mode(spark, sf_dir):
    return kernels.corner_mode(ad.raster(spark, sf_dir).withColumn("v", F.col("v") % 4), 35, 72)


@query(f"""SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INT) AS k, CAST(floor((lat + 90) / 10) AS INT) AS r, round(avg(value), 5) AS v, count(*) AS n FROM ({ad.POINTS_SQL}) GROUP BY 1, 2""")
def level_mean(spark, sf_dir):
    k = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date"))
    return ad.points(spark, sf_dir).groupBy(k.alias("k"), F.floor((F.col("lat") + 90) / 10).cast("int").alias("r")).agg(F.round(F.avg("value"), 5).alias("v"), F.count("*").alias("n"))


# merges, joins, sets


@query(f"SELECT r, c, zone, dep, dip, n_zones FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY dep, zone) AS k, count(*) OVER (PARTITION BY r, c) AS n_zones FROM ({ad.ZONES_SQL})) WHERE k = 1")
def zone_merge_shallowest(spark, sf_dir):
    return merge.shallowest(ad.zones(spark, sf_dir), payload=("dip",))


@query(f"SELECT CAST(r // 3 AS INT) AS r, CAST(c // 3 AS INT) AS c, count(DISTINCT zone) AS n FROM ({ad.ZONES_SQL}) GROUP BY 1, 2")
def zone_count_union(spark, sf_dir):
    return merge.zone_counts(ad.zones(spark, sf_dir), 3)


@query(f"SELECT a.zone AS zone_a, b.zone AS zone_b, count(*) AS cells FROM ({ad.ZONES_SQL}) a JOIN ({ad.ZONES_SQL}) b ON a.r = b.r AND a.c = b.c AND a.zone < b.zone GROUP BY 1, 2")
def zone_pair_overlap(spark, sf_dir):
    return merge.zone_overlaps(ad.zones(spark, sf_dir))


_KEY = "CAST(floor(round_even(lat * 0.2 * 1e6, 0) / 1e6) AS BIGINT) * 1000 + CAST(floor(round_even(lon * 0.2 * 1e6, 0) / 1e6) AS BIGINT)"


def _key():
    return grid.pixel_key(F.col("lat"), 0.2) * 1000 + grid.pixel_key(F.col("lon"), 0.2)


@query(f"""WITH p AS (SELECT *, {_KEY} AS k FROM ({ad.PRIMARY_SQL})), e AS (SELECT *, {_KEY} AS k FROM ({ad.EXTRA_SQL}))
  SELECT id, k, 'primary' AS source FROM p UNION ALL SELECT id, k, 'extra' AS source FROM e WHERE k NOT IN (SELECT k FROM p)""")
def anti_merge(spark, sf_dir):
    a, b = (x(spark, sf_dir).select("id", _key().alias("k")) for x in (ad.primary, ad.extra))
    return merge.anti_merge(a, b, "k").select("id", "k", "source")


@query(f"""WITH p AS (SELECT *, {_KEY} AS k FROM ({ad.PRIMARY_SQL})), e AS (SELECT *, {_KEY} AS k FROM ({ad.EXTRA_SQL})) SELECT id, k FROM e WHERE k IN (SELECT k FROM p)""")
def semi_overlap(spark, sf_dir):
    return ad.extra(spark, sf_dir).select("id", _key().alias("k")).join(ad.primary(spark, sf_dir).select(_key().alias("k")), "k", "left_semi").select("id", "k")


@query(f"""WITH p AS (SELECT q, {_KEY} AS k FROM ({ad.PRIMARY_SQL})), e AS (SELECT id, q, {_KEY} AS k FROM ({ad.EXTRA_SQL})) SELECT id, round(min(abs(e.q - p.q)), 4) AS d FROM e JOIN p USING (k) GROUP BY 1""")
def rounded_min_delta(spark, sf_dir):
    a = ad.extra(spark, sf_dir).select("id", F.col("q").alias("qa"), _key().alias("k"))
    b = ad.primary(spark, sf_dir).select(F.col("q").alias("qb"), _key().alias("k"))
    return merge.nearest_match(a, b, ["k"], "id", "qa", "qb").withColumn("d", F.round("d", 4))


@query(f"SELECT id, 'customer' AS frame, round(q, 2) AS q FROM ({ad.PRIMARY_SQL}) UNION ALL SELECT id, 'supplier' AS frame, round(q, 2) AS q FROM ({ad.EXTRA_SQL})")
def source_union(spark, sf_dir):
    a, b = (x(spark, sf_dir).select("id", F.lit(n).alias("frame"), F.round("q", 2).alias("q")) for x, n in ((ad.primary, "customer"), (ad.extra, "supplier")))
    return a.unionByName(b)


@query("""SELECT c_custkey AS k, 'left' AS side FROM (SELECT DISTINCT c_custkey FROM customer) WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
  UNION ALL SELECT o_custkey AS k, 'right' AS side FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)""")
def set_reconcile(spark, sf_dir):
    a = ad.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return merge.reconcile(a, ad.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "k")


@query("""SELECT c_custkey AS k, 'left' AS side FROM (SELECT DISTINCT c_custkey FROM customer) WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)
  UNION ALL SELECT user_id AS k, 'right' AS side FROM (SELECT DISTINCT user_id FROM events) WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)""")
def set_reconcile_keys(spark, sf_dir):
    """Keys of the whole tables."""
    a = ad.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return merge.reconcile(a, ad.read(spark, sf_dir, "events").select(F.col("user_id").alias("k")), "k")


@query(f"SELECT coalesce(a.r, b.r) AS r, coalesce(a.c, b.c) AS c, coalesce(a.v, b.v) AS v FROM (SELECT * FROM ({ad.RASTER_SQL}) WHERE v % 3 = 0) a FULL OUTER JOIN (SELECT r, c, v * 10 AS v FROM ({ad.RASTER_SQL}) WHERE v % 2 = 0) b ON a.r = b.r AND a.c = b.c")
def priority_overlay(spark, sf_dir):
    x = ad.raster(spark, sf_dir)
    return merge.overlay(x.where("v % 3 = 0"), x.where("v % 2 = 0").withColumn("v", F.col("v") * 10), key=("r", "c"), value="v")


@query(f"SELECT r, c FROM ({ad.ZONES_SQL}) WHERE zone = 1 INTERSECT SELECT r, c FROM ({ad.ZONES_SQL}) WHERE zone = 2")
def zone_intersect(spark, sf_dir):
    z = ad.zones(spark, sf_dir)
    return z.where("zone = 1").select("r", "c").intersect(z.where("zone = 2").select("r", "c"))


def _box_sides(n):
    return (n * 37 % 300 - 170).cast("double") + 0.0137, (n * 53 % 140 - 80).cast("double") + 0.0171, (n % 9 + 2).cast("double"), (n % 5 + 2).cast("double")


def _boxes(spark, sf_dir):
    n = F.col("s_suppkey")
    x, y, w, h = _box_sides(n)
    ring = F.array(*[F.struct((x + a * w).alias("x"), (y + b * h).alias("y")) for a, b in ((0, 0), (1, 0.25), (1, 1), (0, 0.75))])
    return ad.read(spark, sf_dir, "supplier").select(n.alias("fid"), (n % 11 + 1).cast("int").alias("code"), (w * h).alias("size"), ring.alias("ring"))


_BOX = """SELECT s_suppkey AS fid, CAST(s_suppkey % 11 + 1 AS INT) AS code, CAST(s_suppkey * 37 % 300 - 170 AS DOUBLE) + 0.0137::DOUBLE AS x, CAST(s_suppkey * 53 % 140 - 80 AS DOUBLE) + 0.0171::DOUBLE AS y, CAST(s_suppkey % 9 + 2 AS DOUBLE) AS w, CAST(s_suppkey % 5 + 2 AS DOUBLE) AS h FROM supplier"""
_BURN = f"""SELECT fid, code, w * h AS size, CAST(a.range AS INT) AS r, CAST(b.range AS INT) AS c FROM ({_BOX}) p JOIN range(180) a ON a.range >= y + 89 AND a.range <= y + h + 91 JOIN range(360) b
  ON b.range + 0.5 - 180 >= x AND b.range + 0.5 - 180 < x + w AND a.range + 0.5 - 90 >= y + 0.25 * h * (b.range + 0.5 - 180 - x) / w AND a.range + 0.5 - 90 < y + 0.75 * h + 0.25 * h * (b.range + 0.5 - 180 - x) / w"""


@query(f"SELECT fid, count(*) AS cells, CAST(sum(r) AS BIGINT) AS rows_sum, CAST(sum(c) AS BIGINT) AS cols_sum FROM ({_BURN}) GROUP BY 1")
def ray_cast(spark, sf_dir):
    return geometry.burn(_boxes(spark, sf_dir), 1.0, 180, 360).groupBy("fid").agg(F.count("*").alias("cells"), F.sum("r").alias("rows_sum"), F.sum("c").alias("cols_sum"))


@query(f"SELECT r, c, code, n_hits FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY size, fid DESC) AS k, count(*) OVER (PARTITION BY r, c) AS n_hits FROM ({_BURN})) WHERE k = 1")
def smallest_wins(spark, sf_dir):
    return merge.smallest_wins(geometry.burn(_boxes(spark, sf_dir), 1.0, 180, 360), "size", "fid", "code").select("r", "c", "code", "n_hits")


# geometry


def _segments(spark, sf_dir):
    return geometry.segments(ad.points(spark, sf_dir), "user_id", "event_id")


_SEG = f"SELECT * FROM (SELECT user_id, event_id, lat, lon, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM ({ad.POINTS_SQL}) WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE lat2 IS NOT NULL AND NOT (lat = lat2 AND lon = lon2)"


@query(f"SELECT user_id, event_id, round(2 * {R} * asin(sqrt(least(1.0, pow(sin(radians(lat2 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon) / 2), 2)))), 3) AS km FROM ({_SEG})")
def haversine_lengths(spark, sf_dir):
    return _segments(spark, sf_dir).select("user_id", "event_id", F.round(geometry.haversine(*(F.col(x) for x in ("lat", "lon", "lat2", "lon2"))), 3).alias("km"))


def _v(lat: str, lon: str, p: str) -> str:
    return f"cos(radians({lat}))*cos(radians({lon})) AS {p}x, cos(radians({lat}))*sin(radians({lon})) AS {p}y, sin(radians({lat})) AS {p}z"


@query(f"""WITH s AS (SELECT user_id, event_id, {_v('lat', 'lon', 'a')}, {_v('lat2', 'lon2', 'e')}, {_v('10.0::DOUBLE', '20.0::DOUBLE', 'p')} FROM ({_SEG})),
  n AS (SELECT *, ay*ez-az*ey AS nx, az*ex-ax*ez AS ny, ax*ey-ay*ex AS nz FROM s),
  m AS (SELECT *, ny*pz-nz*py AS mx, nz*px-nx*pz AS my, nx*py-ny*px AS mz, sqrt(nx*nx+ny*ny+nz*nz) AS size FROM n)
  SELECT user_id, event_id, round(CASE WHEN mx*ax+my*ay+mz*az <= 0 AND mx*ex+my*ey+mz*ez >= 0 AND size > 0 THEN {R}*abs(asin(least(1.0, greatest(-1.0, (px*nx+py*ny+pz*nz)/size))))
    ELSE {R}*acos(least(1.0, greatest(-1.0, greatest(px*ax+py*ay+pz*az, px*ex+py*ey+pz*ez)))) END, 3) AS km FROM m""")
def segment_distance(spark, sf_dir):
    s = _segments(spark, sf_dir)
    a, b = geometry.unit_vector(F.col("lat"), F.col("lon")), geometry.unit_vector(F.col("lat2"), F.col("lon2"))
    p = geometry.unit_vector(F.lit(10.0), F.lit(20.0))
    return s.select("user_id", "event_id", F.round(geometry.segment_distance(p, a, b), 3).alias("km"))


@query(f"""WITH s AS (SELECT * FROM ({_SEG})), t AS (SELECT *, CASE WHEN lon > 0 THEN 180.0::DOUBLE ELSE -180.0::DOUBLE END AS side, abs(lon2 - lon) > 180 AS jump FROM s),
  u AS (SELECT *, CASE WHEN lon2 + 2 * side - lon <> 0 THEN lat + (lat2 - lat) * (side - lon) / (lon2 + 2 * side - lon) ELSE lat END AS cut FROM t)
  SELECT user_id, event_id, 0 AS part, round(lat, 6) AS lat, round(lon, 6) AS lon, round(CASE WHEN jump THEN cut ELSE lat2 END, 6) AS lat2, round(CASE WHEN jump THEN side ELSE lon2 END, 6) AS lon2 FROM u
  UNION ALL SELECT user_id, event_id, 1 AS part, round(cut, 6), round(-side, 6), round(lat2, 6), round(lon2, 6) FROM u WHERE jump""")
def dateline_split(spark, sf_dir):
    out = geometry.split_dateline(_segments(spark, sf_dir))
    return out.select("user_id", "event_id", "part", *[r6(F.col(x)).alias(x) for x in ("lat", "lon", "lat2", "lon2")])


@query(f"""WITH d AS (SELECT user_id, event_id, lon, lon - lag(lon) OVER (PARTITION BY user_id ORDER BY event_id) AS d FROM ({ad.POINTS_SQL}))
  SELECT user_id, event_id, round(lon + sum(CASE WHEN d > 180 THEN -360 WHEN d < -180 THEN 360 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), 6) AS unwound FROM d""")
def ring_unwind(spark, sf_dir):
    return windows.unwind(ad.points(spark, sf_dir), "user_id", "event_id").select("user_id", "event_id", r6(F.col("unwound")).alias("unwound"))


# neighbourhoods

_STEP = f"({R} * 1000 * radians(5.0::DOUBLE))"


@query(f"""WITH g AS ({ad.DENSE_SQL}), x AS (SELECT a.r, a.c, a.z, e.z AS e, w.z AS w, n.z AS n, s.z AS s FROM g a JOIN g e ON e.r = a.r AND e.c = (a.c + 1) % 72 JOIN g w ON w.r = a.r AND w.c = (a.c + 71) % 72
    LEFT JOIN g n ON n.r = a.r + 1 AND n.c = a.c LEFT JOIN g s ON s.r = a.r - 1 AND s.c = a.c),
  y AS (SELECT r, c, (e - w) / (2 * {_STEP} * cos(radians((r + 0.5::DOUBLE) * 5 - 90))) AS gx, CASE WHEN r = 0 THEN (n - z) / {_STEP} WHEN r = 35 THEN (z - s) / {_STEP} ELSE (n - s) / (2 * {_STEP}) END AS gy FROM x)
  SELECT r, c, round(degrees(atan(sqrt(gx * gx + gy * gy))), 6) AS slope FROM y""")
def slope(spark, sf_dir):
    return windows.slope(ad.dense(spark, sf_dir), 36, 72).withColumn("slope", r6(F.col("slope")))


@query(f"""WITH g AS ({ad.DENSE_SQL}) SELECT a.r, a.c, max(b.z) - min(b.z) AS relief FROM g a JOIN g b ON abs(a.r - b.r) <= 1 AND ((a.c - b.c + 73) % 72) <= 2 GROUP BY 1, 2""")
def relief(spark, sf_dir):
    return windows.relief(ad.dense(spark, sf_dir), 72)


@query(f"""WITH d AS (SELECT (c + 1) % 6 = 0 AS is_seam, abs(lead(z) OVER (PARTITION BY r ORDER BY c) - z) AS d FROM ({ad.DENSE_SQL})) SELECT is_seam, count(*) AS n, round(quantile_cont(d, 0.999), 4) AS p FROM d WHERE d IS NOT NULL GROUP BY 1""")
def seam_p999(spark, sf_dir):
    return windows.seams(ad.dense(spark, sf_dir), 72, 6).withColumn("p", F.round("p", 4))


# statistics

_HIST = "SELECT CAST(least(greatest(floor((o_totalprice - 0) / 1000), 0), 299) AS INT) AS bin, count(*) AS n FROM orders WHERE o_totalprice <> -99999 GROUP BY 1"


def _histogram(spark, sf_dir):
    return stats.histogram(ad.read(spark, sf_dir, "orders"), "o_totalprice", 0, 300_000, 1000)


@query(_HIST)
def histogram(spark, sf_dir):
    return _histogram(spark, sf_dir)


@query(f"""WITH h AS ({_HIST}), c AS (SELECT bin, n, sum(n) OVER (ORDER BY bin) AS cum, sum(n) OVER () AS total FROM h), q AS (SELECT unnest([0.01::DOUBLE, 0.25, 0.5, 0.75, 0.99]) AS q),
  x AS (SELECT q, (bin + (q * total - (cum - n)) / n) * 1000 AS value, row_number() OVER (PARTITION BY q ORDER BY bin) AS k FROM c JOIN q ON cum >= q * total) SELECT q, round(value, 4) AS value FROM x WHERE k = 1""")
def hist_quantiles(spark, sf_dir):
    return stats.hist_quantiles(_histogram(spark, sf_dir), [0.01, 0.25, 0.5, 0.75, 0.99], 0, 1000).withColumn("value", F.round("value", 4))


def _pair_sql(key: str) -> str:
    return f"""SELECT {key}, count(*) AS n, round(corr(x, y), 6) AS r, round(avg(y - x), 4) AS mean_diff, round(median(y - x), 4) AS median_diff, round(stddev_pop(y - x), 4) AS std_diff, round(avg(abs(y - x)), 4) AS mae,
  round(sqrt(avg((y - x) * (y - x))), 4) AS rmse, round(quantile_cont(y - x, 0.05), 4) AS p05, round(quantile_cont(y - x, 0.95), 4) AS p95, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 4) AS intercept
  FROM (SELECT l_returnflag, 'all' AS part, l_extendedprice AS x, l_extendedprice * (1 - l_discount) + l_quantity AS y FROM lineitem) GROUP BY 1"""


def _pairs(spark, sf_dir, key):
    l = ad.read(spark, sf_dir, "lineitem").select("l_returnflag", F.lit("all").alias("part"), F.col("l_extendedprice").alias("x"), (F.col("l_extendedprice") * (1 - F.col("l_discount")) + F.col("l_quantity")).alias("y"))
    out = stats.pair_stats(l, "x", "y", key)
    return out.select(key, "n", *[F.round(c, 6 if c in ("r", "slope") else 4).alias(c) for c in out.columns if c not in (key, "n")])


@query(_pair_sql("part"))
def pair_stats(spark, sf_dir):
    return _pairs(spark, sf_dir, "part")


@query(_pair_sql("l_returnflag"))
def pair_stats_segmented(spark, sf_dir):
    return _pairs(spark, sf_dir, "l_returnflag")


@query(f"SELECT 'float' AS kind, round(count(v) / 2592.0::DOUBLE, 6) AS coverage FROM ({ad.RASTER_SQL}) UNION ALL SELECT 'class' AS kind, round(sum(CASE WHEN v % 5 <> 0 THEN 1 ELSE 0 END) / 2592.0::DOUBLE, 6) AS coverage FROM ({ad.RASTER_SQL})")
def coverage(spark, sf_dir):
    x = ad.raster(spark, sf_dir)
    total = F.lit(36.0 * 72)
    a = x.agg((F.sum(stats.present(F.col("v"))) / total).alias("coverage")).withColumn("kind", F.lit("float"))
    b = x.agg((F.sum(stats.present(F.col("v") % 5, True)) / total).alias("coverage")).withColumn("kind", F.lit("class"))
    return a.unionByName(b).select("kind", r6(F.col("coverage")).alias("coverage"))


@query(f"SELECT r, c, CASE WHEN v % 5 <> 0 THEN 1 ELSE 0 END AS valid FROM ({ad.RASTER_SQL})")
def validity_mask(spark, sf_dir):
    return ad.raster(spark, sf_dir).select("r", "c", stats.present(F.col("v") % 5, True).alias("valid"))


@query("SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS land FROM customer")
def landsea_threshold(spark, sf_dir):
    z = F.col("c_acctbal")
    return ad.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(~F.isnan(z) & (z > 0), 1).otherwise(0).alias("land"))


@query("SELECT event_type AS label, CAST(dense_rank() OVER (ORDER BY event_type) AS INT) AS code, n FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)")
def class_distribution(spark, sf_dir):
    e = ad.read(spark, sf_dir, "events")
    codes = text.encoding(e, "event_type")
    return e.groupBy("event_type").agg(F.count("*").alias("n")).join(codes, "event_type").select(F.col("event_type").alias("label"), "code", "n")


@query("SELECT p_type AS label, CAST(row_number() OVER (ORDER BY p_type) AS INT) AS code FROM (SELECT DISTINCT p_type FROM part)")
def class_encoding(spark, sf_dir):
    return text.encoding(ad.read(spark, sf_dir, "part"), "p_type").withColumnRenamed("p_type", "label")


@query("SELECT count(*) AS n_rows, count(DISTINCT (c_nationkey, c_mktsegment)) AS n_sites, count(DISTINCT c_nationkey) AS n_nations FROM customer")
def distinct_counts(spark, sf_dir):
    return ad.read(spark, sf_dir, "customer").agg(F.count("*").alias("n_rows"), F.count_distinct("c_nationkey", "c_mktsegment").alias("n_sites"), F.count_distinct("c_nationkey").alias("n_nations"))


@query("SELECT n, count(*) AS cells FROM (SELECT count(*) AS n FROM (SELECT DISTINCT CAST(l_suppkey % 7 AS INT) AS z, l_partkey % 36 AS r, l_orderkey % 72 AS c FROM lineitem) GROUP BY r, c) GROUP BY 1")
def count_distribution(spark, sf_dir):
    return merge.shallowest(ad.zones(spark, sf_dir)).groupBy(F.col("n_zones").alias("n")).agg(F.count("*").alias("cells"))


@query("""SELECT p_partkey AS id, round(CASE WHEN p_size % 4 = 0 THEN p_size + 2.5::DOUBLE WHEN p_size % 4 = 1 THEN p_size * 0.3048::DOUBLE WHEN p_size % 4 = 2 THEN (p_size + (p_size + 1) * 2) / 2.0::DOUBLE END, 6) AS metres FROM part""")
def thickness_parse(spark, sf_dir):
    return ad.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), r6(text.thickness_m(_literal())).alias("metres"))


def _literal():
    s, m = F.col("p_size"), F.col("p_size") % 4
    return F.when(m == 0, F.concat_ws("-", s, s + 5)).when(m == 1, F.concat(F.lit("<"), s, F.lit(" ft"))).when(m == 2, F.concat(s, F.lit(" m, "), (s + 1) * 2, F.lit("m"))).otherwise("unknown")


@query("""SELECT class, count(*) AS n FROM (SELECT CASE WHEN m IS NULL THEN 0 WHEN m <= 2 THEN 1 WHEN m <= 10 THEN 2 WHEN m <= 50 THEN 3 WHEN m <= 200 THEN 4 ELSE 5 END AS class FROM
  (SELECT CASE WHEN p_size % 4 = 0 THEN p_size + 2.5 WHEN p_size % 4 = 1 THEN p_size * 0.3048 WHEN p_size % 4 = 2 THEN (p_size + (p_size + 1) * 2) / 2.0 END AS m FROM part)) GROUP BY 1""")
def thickness_class(spark, sf_dir):
    return ad.read(spark, sf_dir, "part").groupBy(text.thickness_class(text.thickness_m(_literal())).alias("class")).agg(F.count("*").alias("n"))


@query("""WITH d AS (SELECT CAST(p_size AS DOUBLE) / 100 AS k, 1 + CAST(p_retailprice AS DOUBLE) / 10000 - p_size / 100.0::DOUBLE AS ratio FROM part), s AS (SELECT k, ln(ratio) AS y, ratio FROM d WHERE k BETWEEN 0.02 AND 0.4 AND ratio > 0)
  SELECT count(*) AS n, round(-regr_slope(y, k) / 2, 6) AS dz, round(regr_r2(y, k), 6) AS r2, round(avg(CASE WHEN ratio > 1 THEN 1 ELSE 0 END), 6) AS above FROM s""")
def continuation_fit(spark, sf_dir):
    p = ad.read(spark, sf_dir, "part").select((F.col("p_size").cast("double") / 100).alias("k"), (1 + F.col("p_retailprice").cast("double") / 10000 - F.col("p_size") / 100).alias("ratio"))
    return stats.continuation_fit(p, "k", "ratio", 0.02, 0.4).select("n", *[r6(F.col(x)).alias(x) for x in ("dz", "r2", "above")])


@query(f"""SELECT a.r AS k, round(a.m, 6) AS coarse, round(b.m, 6) AS fine, round(a.m - b.m, 6) AS diff FROM (SELECT CAST(r // 4 AS INT) AS r, avg(v) AS m FROM ({ad.RASTER_SQL}) GROUP BY 1) a
  JOIN (SELECT CAST(r // 4 AS INT) AS r, avg(s) AS m FROM (SELECT CAST(r // 2 AS INT) AS q, CAST(c // 2 AS INT) AS c, min(r) AS r, avg(v) AS s FROM ({ad.RASTER_SQL}) GROUP BY 1, 2) GROUP BY 1) b USING (r)""")
def cross_tier_compare(spark, sf_dir):
    x = ad.raster(spark, sf_dir)
    fine = x.groupBy(F.expr("int(r div 2)").alias("q"), F.expr("int(c div 2)").alias("c")).agg(F.min("r").alias("r"), F.avg("v").alias("s"))
    a = x.groupBy(F.expr("int(r div 4)").alias("k")).agg(F.avg("v").alias("a"))
    b = fine.groupBy(F.expr("int(r div 4)").alias("k")).agg(F.avg("s").alias("b"))
    return a.join(b, "k").select("k", r6(F.col("a")).alias("coarse"), r6(F.col("b")).alias("fine"), r6(F.col("a") - F.col("b")).alias("diff"))


@query(f"SELECT 'raster' AS layer, count(*) AS cells, count(*) FILTER (WHERE (v % 5 <> 0) <> (v % 3 <> 0)) AS wrong FROM ({ad.RASTER_SQL})")
def mask_consistency(spark, sf_dir):
    """A class layer against a mask made from other classes: cells where only one of them has a value."""
    mask = stats.present(F.col("v") % 3, True)
    return ad.raster(spark, sf_dir).agg(F.count("*").alias("cells"), F.count_if(stats.present(F.col("v") % 5, True) != mask).alias("wrong")).select(F.lit("raster").alias("layer"), "cells", "wrong")


@query("SELECT source, sum(strlen(text))::BIGINT AS n_bytes, count(*) AS n, min(sha256(text)) AS first_sha FROM documents GROUP BY 1")
def source_digests(spark, sf_dir):
    return ad.read(spark, sf_dir, "documents").groupBy("source").agg(F.sum(F.octet_length("text")).cast("long").alias("n_bytes"), F.count("*").alias("n"), F.min(F.sha2("text", 256)).alias("first_sha"))


def digest_sql(layers: str) -> str:
    """(layer, sha256) of (layer, r, c, v): rows of cells digested, then the layer's rows."""
    return f"SELECT layer, sha256(string_agg(r || ':' || d, ';' ORDER BY r)) AS sha256 FROM (SELECT layer, r, sha256(string_agg(',' || c || ',' || v, ';' ORDER BY c)) AS d FROM ({layers}) GROUP BY 1, 2) GROUP BY 1"


@query(digest_sql(f"SELECT 'raster' AS layer, r, c, v FROM ({ad.RASTER_SQL}) UNION ALL SELECT 'dense' AS layer, r, c, CAST(z AS BIGINT) AS v FROM ({ad.DENSE_SQL})"))
def layer_checksum(spark, sf_dir):
    """Digests of two layers' cells in order, whatever the order of the rows."""
    both = ad.raster(spark, sf_dir).withColumn("layer", F.lit("raster")).unionByName(ad.dense(spark, sf_dir).select("r", "c", F.col("z").cast("long").alias("v"), F.lit("dense").alias("layer")))
    return stats.layer_sha256(both.repartition(7, "c"), ["layer"], "v")


# lines and spectra


_CUT = "CASE WHEN ceil(least({a},{b})) <= floor(greatest({a},{b})) AND {a} <> {b} THEN list_transform(range(CAST(ceil(least({a},{b})) AS BIGINT), CAST(floor(greatest({a},{b})) AS BIGINT) + 1), lambda k: (k - {a}) / ({b} - {a})) ELSE [] END"


_ACROSS = f"SELECT *, CASE WHEN lon2 + 2 * side - lon <> 0 THEN lat + (lat2 - lat) * (side - lon) / (lon2 + 2 * side - lon) ELSE lat END AS cut FROM (SELECT *, CASE WHEN lon > 0 THEN 180.0::DOUBLE ELSE -180.0::DOUBLE END AS side FROM ({_SEG}) WHERE abs(lon2 - lon) > 180)"
_SPLIT = f"SELECT user_id, lat, lon, lat2, lon2 FROM ({_SEG}) WHERE abs(lon2 - lon) <= 180 UNION ALL SELECT user_id, lat, lon, cut, side FROM ({_ACROSS}) UNION ALL SELECT user_id, cut, -side, lat2, lon2 FROM ({_ACROSS})"


@query(f"""WITH s AS (SELECT user_id AS line, (lon + 180) / 2 AS x0, (lat + 90) / 2 AS y0, (lon2 + 180) / 2 AS x1, (lat2 + 90) / 2 AS y1, sqrt(pow(lon2 - lon, 2) + pow(lat2 - lat, 2)) AS len FROM ({_SPLIT})),
  l AS (SELECT line, round(sum(len), 6) AS length FROM s GROUP BY 1),
  t AS (SELECT *, list_sort(list_concat([0.0::DOUBLE], {_CUT.format(a='x0', b='x1')}, {_CUT.format(a='y0', b='y1')}, [1.0::DOUBLE])) AS t FROM s WHERE line % 5 <> 0),
  u AS (SELECT *, unnest(range(1, len(t))) AS i FROM t),
  m AS (SELECT *, (t[i] + t[i + 1]) / 2 AS m FROM u WHERE t[i + 1] > t[i]),
  c AS (SELECT line, CAST(least(greatest(floor(y0 + m * (y1 - y0)), 0), 89) AS INT) AS r, CAST(least(greatest(floor(x0 + m * (x1 - x0)), 0), 179) AS INT) AS c FROM m),
  k AS (SELECT c.*, row_number() OVER (PARTITION BY r, c ORDER BY length, c.line DESC) AS n, min(c.line) OVER (PARTITION BY r, c) <> max(c.line) OVER (PARTITION BY r, c) AS overlap FROM c JOIN l ON c.line = l.line)
  SELECT r, c, line % 5 AS code, overlap FROM k WHERE n = 1""")
def line_burn(spark, sf_dir):
    """Lines burnt with the code of a cell's shortest; segments across the dateline are cut there."""
    segs = geometry.split_dateline(_segments(spark, sf_dir)).withColumnRenamed("user_id", "line")
    length = segs.groupBy("line").agg(F.round(F.sum(F.sqrt(F.pow(F.col("lon2") - F.col("lon"), F.lit(2)) + F.pow(F.col("lat2") - F.col("lat"), F.lit(2)))), 6).alias("length"))
    return lines.burn_lines(segs.join(length, "line").withColumn("code", F.col("line") % 5), 2.0, 90, 180)


_FAULTS = f"SELECT lat, lon, lat * 0.9 AS lat2, lon + 3 AS lon2 FROM ({ad.EXTRA_SQL})"


@query(f"""WITH g AS (SELECT CAST(a.range AS INT) AS r, CAST(b.range AS INT) AS c, (a.range + 0.5::DOUBLE) * 4 - 90 AS glat, (b.range + 0.5::DOUBLE) * 4 - 180 AS glon FROM range(45) a CROSS JOIN range(90) b),
  s AS (SELECT r, c, {_v('lat', 'lon', 'a')}, {_v('lat2', 'lon2', 'e')}, {_v('glat', 'glon', 'p')} FROM g CROSS JOIN ({_FAULTS})),
  n AS (SELECT *, ay*ez-az*ey AS nx, az*ex-ax*ez AS ny, ax*ey-ay*ex AS nz FROM s),
  m AS (SELECT *, ny*pz-nz*py AS mx, nz*px-nx*pz AS my, nx*py-ny*px AS mz, sqrt(nx*nx+ny*ny+nz*nz) AS size FROM n)
  SELECT r, c, round(min(CASE WHEN mx*ax+my*ay+mz*az <= 0 AND mx*ex+my*ey+mz*ez >= 0 AND size > 0 THEN {R}*abs(asin(least(1.0, greatest(-1.0, (px*nx+py*ny+pz*nz)/size))))
    ELSE {R}*acos(least(1.0, greatest(-1.0, greatest(px*ax+py*ay+pz*az, px*ex+py*ey+pz*ez)))) END), 2) AS km FROM m GROUP BY 1, 2""")
def nearest_segment_grid(spark, sf_dir):
    segs = ad.extra(spark, sf_dir).select("lat", "lon", (F.col("lat") * 0.9).alias("lat2"), (F.col("lon") + 3).alias("lon2"))
    return lines.distance_pyramid(segs, [20, 4]).withColumn("km", r6(F.col("km"), 2))


_E = "sqrt(0.0066943799901413165::DOUBLE)"
_QA = f"((1 - 0.0066943799901413165::DOUBLE) * ({{0}} / (1 - 0.0066943799901413165::DOUBLE * {{0}} * {{0}}) + atanh({_E} * {{0}}) / {_E}))"


@query(f"""WITH x AS (SELECT id, tan(asin({_QA.format('sin(radians(lat * 0.9))')} / {_QA.format('1.0::DOUBLE')}) / 2) AS a, tan(asin({_QA.format('sin(radians(lat * 0.9 + 5))')} / {_QA.format('1.0::DOUBLE')}) / 2) AS b FROM ({ad.EXTRA_SQL}))
  SELECT id, round(abs(2 * atan2(tan(radians(4.0::DOUBLE) / 2) * 2 * a, 1 + a * a) - 2 * atan2(tan(radians(4.0::DOUBLE) / 2) * 2 * b, 1 + b * b)) * pow(6378.137::DOUBLE, 2) * {_QA.format('1.0::DOUBLE')} / 2, 3) AS km2 FROM x""")
def polygon_area(spark, sf_dir):
    corner = lambda dx, dy: F.struct((F.col("lon") + dx).alias("x"), (F.col("lat") * 0.9 + dy).alias("y"))
    boxes = ad.extra(spark, sf_dir).withColumn("ring", F.array(corner(0, 0), corner(4, 0), corner(4, 5), corner(0, 5), corner(0, 0)))
    return boxes.select("id", r6(lines.ring_area_km2("ring"), 3).alias("km2"))


_POWER = f"""WITH z AS (SELECT CAST(r // 12 AS INT) AS wr, CAST(c // 12 AS INT) AS wc, r % 12 AS i, c % 12 AS j, z FROM ({ad.DENSE_SQL})),
  h AS (SELECT wr, wc, i, j, (z - avg(z) OVER (PARTITION BY wr, wc)) * (0.5 - 0.5 * cos(2 * pi() * i / 11)) * (0.5 - 0.5 * cos(2 * pi() * j / 11)) AS z FROM z),
  f AS (SELECT wr, wc, u.range AS u, v.range AS v, sum(z * cos(2 * pi() * (u.range * i + v.range * j) / 12)) AS re, sum(z * sin(2 * pi() * (u.range * i + v.range * j) / 12)) AS im FROM h CROSS JOIN range(12) u CROSS JOIN range(7) v GROUP BY 1, 2, 3, 4)"""
_WAVENUMBER = f"sqrt(pow(2 * pi() * (CASE WHEN u < 6 THEN u ELSE u - 12 END) / 60 / (pi() / 180 * {R}), 2) + pow(2 * pi() * v / 60 / (pi() / 180 * {R} * cos(radians((wr + 0.5::DOUBLE) * 60 - 90))), 2))"


@query(f"""{_POWER}
  SELECT wr, wc, count(*) AS elements, round(ln(avg(re * re + im * im)), 6) AS log_power, round(max({_WAVENUMBER}), 9) AS k_max FROM f GROUP BY 1, 2""")
def window_power(spark, sf_dir):
    each = spectra.window_power(ad.dense(spark, sf_dir), 12, 5.0, "z")
    return each.groupBy("wr", "wc").agg(F.count("*").alias("elements"), r6(F.log(F.avg("power"))).alias("log_power"), r6(F.max("k"), 9).alias("k_max"))


@query(f"""{_POWER},
  e AS (SELECT wr, wc, re * re + im * im AS power, {_WAVENUMBER} AS k FROM f), t AS (SELECT *, max(k) OVER (PARTITION BY wr, wc) AS top FROM e)
  SELECT wr, wc, CAST(least(floor(k / top * 8 + 1e-9), 7) AS INT) AS bin, round((CAST(least(floor(k / top * 8 + 1e-9), 7) AS INT) + 0.5::DOUBLE) * max(top) / 8, 9) AS k, round(ln(avg(power)), 5) AS log_power, count(*) AS elements FROM t GROUP BY 1, 2, 3""")
def radial_power(spark, sf_dir):
    return spectra.radial_power(ad.dense(spark, sf_dir), 12, 5.0, 8, "z").select("wr", "wc", "bin", r6(F.col("k"), 9).alias("k"), r6(F.log("power"), 5).alias("log_power"), "elements")

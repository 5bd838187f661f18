"""Registered queries of source contracts, validity rules and geometry beyond single rings, with oracle SQL."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import functions as F

from tessera.functions import grid
from tessera.operators import fidelity, geometry, kernels, lines, merge, stats, windows
from tessera.plans import adapters as ad
from tessera.plans.catalog import R, _key, _KEY, _OFF, _v, digest_sql, query, r6
from tessera.sources import sidecars, tables

# points, cells, axes

_ODD_POINTS = f"SELECT event_id, lat, lon, CASE WHEN event_id % 7 = 0 THEN lat + 200 WHEN event_id % 7 = 1 THEN 'nan'::DOUBLE WHEN event_id % 7 = 2 THEN lat ELSE lat END AS y, CASE WHEN event_id % 7 = 2 THEN 'nan'::DOUBLE WHEN event_id % 7 = 3 THEN 'inf'::DOUBLE WHEN event_id % 7 = 4 THEN NULL ELSE lon * 3 END AS x FROM ({ad.POINTS_SQL})"


@query(f"SELECT CAST(least(floor(y + 90), 179) AS INT) AS r, CAST(least(floor((((x + 180) % 360 + 360) % 360 - 180) + 180), 359) AS INT) AS c, count(*) AS n FROM ({_ODD_POINTS}) WHERE y BETWEEN -90 AND 90 AND NOT isnan(x) AND NOT isinf(x) GROUP BY 1, 2")
def point_density_valid(spark, sf_dir):
    """Points of which some are off the globe or not finite: these have no cell."""
    k = F.col("event_id") % 7
    y = F.when(k == 0, F.col("lat") + 200).when(k == 1, float("nan")).otherwise(F.col("lat"))
    x = F.when(k == 2, float("nan")).when(k == 3, float("inf")).when(k != 4, F.col("lon") * 3)
    odd = ad.points(spark, sf_dir).select(y.alias("lat"), x.alias("lon"))
    return grid.point_cells(odd, "1deg", drop=True).groupBy("r", "c").agg(F.count("*").alias("n"))


@query(f"""SELECT CAST(range AS INT) AS r, range * 0.5 - 90 AS lat, greatest(range * 0.5 - 90.25, -90) AS south, least(range * 0.5 - 89.75, 90) AS north, coalesce(n, 0) AS n
  FROM range(361) LEFT JOIN (SELECT CAST(floor((lat + 90.25 + {_OFF}::DOUBLE) * 2) AS BIGINT) AS range, count(*) AS n FROM ({ad.POINTS_SQL}) GROUP BY 1) USING (range)""")
def node_edges(spark, sf_dir):
    """Rows of nodes, their edges, and the points between these."""
    held = ad.points(spark, sf_dir).groupBy(F.floor((F.col("lat") + 90.25 + _OFF) * 2).cast("int").alias("r")).agg(F.count("*").alias("n"))
    return grid.node_edges(spark, 361).join(held, "r", "left").fillna(0, ["n"])


@query(f"SELECT event_id, CAST(least(greatest(round_even((lat + 87.45::DOUBLE) / 0.1::DOUBLE, 0), 0), 1749) AS INT) AS line, round(abs(lat - (-87.45::DOUBLE + least(greatest(round_even((lat + 87.45::DOUBLE) / 0.1::DOUBLE, 0), 0), 1749) * 0.1::DOUBLE)), 6) AS off FROM ({ad.POINTS_SQL})")
def nearest_grid_line(spark, sf_dir):
    line, off = grid.nearest_line(F.col("lat"), -87.45, 0.1, 1750)
    return ad.points(spark, sf_dir).select("event_id", line.alias("line"), r6(off).alias("off"))


@query(f"SELECT event_id, CAST(((CAST(round_even((lon * 2 + 180) / 0.05::DOUBLE, 0) AS INT) % 7200) + 7200) % 7200 AS INT) AS c FROM ({ad.POINTS_SQL})")
def ring_columns(spark, sf_dir):
    return ad.points(spark, sf_dir).select("event_id", grid.ring_column(F.col("lon") * 2, 0.05, 7200).alias("c"))


# tiles, slices, text


@query(f"""SELECT concat(CASE WHEN n >= 0 THEN 'N' ELSE 'S' END, lpad(CAST(abs(n) AS VARCHAR), 2, '0'), CASE WHEN w >= 0 THEN 'E' ELSE 'W' END, lpad(CAST(abs(w) AS VARCHAR), 3, '0')) AS label, CAST(n AS DOUBLE) AS north, CAST(w AS DOUBLE) AS west
  , coalesce(k, 0) AS n FROM (SELECT 90 - 15 * a.range AS n, 15 * b.range - 180 AS w FROM range(12) a CROSS JOIN range(24) b) LEFT JOIN (SELECT 90 - 15 * least(CAST(floor((90 - lat) / 15) AS BIGINT), 11) AS n, 15 * CAST(floor((lon + 180) / 15) AS BIGINT) - 180 AS w, count(*) AS k FROM ({ad.POINTS_SQL}) GROUP BY 1, 2) USING (n, w)""")
def tile_labels(spark, sf_dir):
    """The globe's tiles, their bounds read back from their labels, and the points in each."""
    at = tables.tile_bounds(F.col("label"))
    north, west = 90 - 15 * F.least(F.floor((90 - F.col("lat")) / 15), F.lit(11)), 15 * F.floor((F.col("lon") + 180) / 15) - 180
    held = ad.points(spark, sf_dir).groupBy(tables.tile_label(north, west).alias("label")).agg(F.count("*").alias("n"))
    return tables.all_tiles(spark).join(held, "label", "left").select("label", at["north"].alias("north"), at["west"].alias("west"), F.coalesce("n", F.lit(0)).alias("n"))


_TILED = "SELECT CAST(p_size % 12 AS INT) AS i, CAST(p_partkey % 24 AS INT) AS j, min(p_partkey) AS v FROM part GROUP BY 1, 2"


@query(f"SELECT CAST((11 - i) * 2 + 1 - a.range AS INT) AS r, CAST(j * 2 + b.range AS INT) AS c, v * 10 + a.range * 2 + b.range AS v FROM ({_TILED}) CROSS JOIN range(2) a CROSS JOIN range(2) b")
def tile_mosaic(spark, sf_dir):
    """Tiles of 2 x 2 cells, north first, laid out on the globe, south first."""
    some = ad.read(spark, sf_dir, "part").groupBy((F.col("p_size") % 12).alias("i"), (F.col("p_partkey") % 24).alias("j")).agg(F.min("p_partkey").alias("v"))
    label = tables.tile_label((90 - 15 * F.col("i")).cast("double"), (15 * F.col("j") - 180).cast("double"))
    cell = F.explode(F.array(*[F.struct(F.lit(a).alias("r"), F.lit(b).alias("c")) for a in (0, 1) for b in (0, 1)]))
    cells = some.select(label.alias("label"), "v", cell.alias("x")).select("label", "x.r", "x.c", (F.col("v") * 10 + F.col("x.r") * 2 + F.col("x.c")).alias("v"))
    return tables.mosaic(cells, 2)


@query("SELECT concat(CASE WHEN n >= 0 THEN 'N' ELSE 'S' END, lpad(CAST(abs(n) AS VARCHAR), 2, '0'), CASE WHEN w >= 0 THEN 'E' ELSE 'W' END, lpad(CAST(abs(w) AS VARCHAR), 3, '0')) AS label FROM (SELECT 90 - 15 * a.range AS n, 15 * b.range - 180 AS w, a.range AS i, b.range AS j FROM range(12) a CROSS JOIN range(24) b) x WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 12 = x.i AND s_nationkey % 24 = x.j)")
def missing_tiles(spark, sf_dir):
    there = ad.read(spark, sf_dir, "supplier").select(tables.tile_label((90 - 15 * (F.col("s_suppkey") % 12)).cast("double"), (15 * (F.col("s_nationkey") % 24) - 180).cast("double")).alias("label"))
    return tables.all_tiles(spark).join(there, "label", "left_anti").select("label")


@query("SELECT p_partkey AS id, CASE WHEN p_size % 3 = 2 THEN NULL WHEN p_size % 3 = 1 THEN CASE WHEN p_size = 4 THEN 385.0 ELSE p_size + 0.5 END ELSE p_size END::DOUBLE AS age FROM part")
def slice_ages(spark, sf_dir):
    """Ages of file names, one of them told otherwise; others are no slices."""
    n = F.col("p_size")
    name = F.when(n % 3 == 2, F.concat(F.lit("a_"), n, F.lit("Ma.txt"))).when(n == 4, "a_385.2Ma.nc").when(n % 3 == 1, F.concat(F.lit("b_"), n, F.lit(".5Ma.nc"))).otherwise(F.concat(F.lit("c_"), n, F.lit("Ma.nc")))
    age = tables.slice_age(name)
    return ad.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.when(age == 385.2, 385.0).otherwise(age).alias("age"))


@query("SELECT c_custkey AS id, c_mktsegment[1:2] AS plate, round(c_acctbal, 3) AS rate FROM customer")
def fixed_width_fields(spark, sf_dir):
    """Lines of fixed fields, written and read back."""
    x = ad.read(spark, sf_dir, "customer")
    line = F.concat(F.substring("c_mktsegment", 1, 2), F.lpad(F.format_string("%.3f", "c_acctbal"), 12, " "), F.lpad(F.col("c_custkey").cast("string"), 9, " "))
    return tables.fixed_width(x.select(line.alias("value")), [("plate", 2, "string"), ("rate", 12, "double"), ("id", 9, "long")])


@query("SELECT l_orderkey AS id, l_linenumber AS k, round(sqrt((2 * v * v + h * h) / 3), 4) AS vs, round((h * h) / (v * v), 4) AS xi FROM (SELECT *, l_quantity AS v, l_extendedprice / 1000 AS h FROM lineitem)")
def shear_velocities(spark, sf_dir):
    out = tables.shear(F.col("l_quantity"), F.col("l_extendedprice") / 1000)
    return ad.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("k"), *[r6(v, 4).alias(n) for n, v in out.items()])


# statistics, samples, digests


@query("""WITH x AS (SELECT l_returnflag, l_extendedprice AS x, CASE WHEN l_linenumber % 3 = 0 THEN 'nan'::DOUBLE WHEN l_linenumber % 5 = 0 THEN NULL WHEN l_linenumber = 7 THEN 'inf'::DOUBLE ELSE l_extendedprice * 0.9 + l_quantity END AS y FROM lineitem),
  f AS (SELECT * FROM x WHERE y IS NOT NULL AND NOT isnan(y) AND NOT isinf(y))
  SELECT l_returnflag, count(*) AS n, round(corr(x, y), 6) AS r, round(avg(y - x), 4) AS mean_diff, round(median(y - x), 4) AS median_diff, round(quantile_cont(y - x, 0.95), 4) AS p95 FROM f GROUP BY 1""")
def pair_stats_finite(spark, sf_dir):
    """Pairs of which some are missing, NaN or infinite."""
    k = F.col("l_linenumber")
    y = F.when(k % 3 == 0, float("nan")).when(k % 5 == 0, None).when(k == 7, float("inf")).otherwise(F.col("l_extendedprice") * 0.9 + F.col("l_quantity"))
    out = stats.pair_stats(ad.read(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("x"), y.alias("y")), "x", "y", "l_returnflag")
    return out.select("l_returnflag", "n", r6(F.col("r")).alias("r"), *[F.round(c, 4).alias(c) for c in ("mean_diff", "median_diff", "p95")])


@query("SELECT o_orderpriority AS part, q, round(v, 4) AS value FROM (SELECT o_orderpriority, unnest([0.0::DOUBLE, 0.001, 0.25, 0.5, 0.999, 1.0]) AS q, unnest(quantile_cont(o_totalprice, [0.0, 0.001, 0.25, 0.5, 0.999, 1.0])) AS v FROM orders GROUP BY 1)")
def exact_quantiles(spark, sf_dir):
    out = stats.exact_quantiles(ad.read(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "part"), "o_totalprice", [0.0, 0.001, 0.25, 0.5, 0.999, 1.0], "part")
    return out.select("part", "q", F.round("value", 4).alias("value"))


_CROSS = f"SELECT r, c, z AS x, z * 0.8 + r AS y, (r + 0.5) * 5 - 90 AS lat, z > 100 AS land FROM ({ad.DENSE_SQL})"


@query(f"""WITH p AS ({_CROSS}), s AS (SELECT 'global' AS segment, * FROM p UNION ALL SELECT CASE WHEN land THEN 'land' ELSE 'sea' END, * FROM p UNION ALL SELECT CASE WHEN abs(lat) > 60 THEN 'polar' ELSE 'non-polar' END, * FROM p)
  SELECT segment, count(*) AS n, round(corr(x, y), 6) AS r, round(avg(y - x), 4) AS mean_diff, round(median(y - x), 4) AS median_diff, round(regr_slope(y, x), 6) AS slope FROM s GROUP BY 1""")
def cross_check_segments(spark, sf_dir):
    """Two grids compared in every segment that a cell belongs to."""
    z = ad.dense(spark, sf_dir)
    pairs = z.select("r", "c", F.col("z").alias("x"), (F.col("z") * 0.8 + F.col("r")).alias("y"), ((F.col("r") + 0.5) * 5 - 90).alias("lat"), (F.col("z") > 100).alias("land"))
    out = fidelity.cross_check(pairs, "x", "y")
    return out.select("segment", "n", r6(F.col("r")).alias("r"), F.round("mean_diff", 4).alias("mean_diff"), F.round("median_diff", 4).alias("median_diff"), r6(F.col("slope")).alias("slope"))


@query(f"""WITH p AS (SELECT q, {_KEY} AS k FROM ({ad.PRIMARY_SQL})), e AS (SELECT id, CASE WHEN id % 4 <> 0 THEN q END AS q, {_KEY} AS k FROM ({ad.EXTRA_SQL})), m AS (SELECT id, min(abs(e.q - p.q)) AS d FROM e JOIN p USING (k) GROUP BY 1)
  SELECT count(*) AS exact, count(d) AS comparable, count(*) FILTER (WHERE d <= 2000) AS identical FROM m""")
def match_counts(spark, sf_dir):
    a = ad.extra(spark, sf_dir).select("id", F.when(F.col("id") % 4 != 0, F.col("q")).alias("qa"), _key().alias("k"))
    return merge.match_counts(a, ad.primary(spark, sf_dir).select(F.col("q").alias("qb"), _key().alias("k")), ["k"], "id", "qa", "qb", 2000)


@query("SELECT c_mktsegment AS part, least(count(*), 25) AS n FROM customer GROUP BY 1")
def stratified_sample(spark, sf_dir):
    """Rows of each stratum; which ones a hash decides."""
    return merge.stratified(ad.read(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "part"), "part", "c_custkey", 25).groupBy("part").agg(F.count("*").alias("n"))


@query(f"""WITH l AS (SELECT r, sha256(string_agg(concat(',', c, ',', v), ';' ORDER BY c)) AS d FROM ({ad.RASTER_SQL}) GROUP BY 1) SELECT 'raster' AS layer, sha256(string_agg(concat(r, ':', d), ';' ORDER BY r)) AS sha256 FROM l""")
def layer_sha256(spark, sf_dir):
    return stats.layer_sha256(ad.raster(spark, sf_dir).withColumn("layer", F.lit("raster")), ["layer"], "v")


_CHANGED = f"SELECT layer, r, c, CASE WHEN layer = 'changed' AND r = 7 AND c = 7 THEN -1 ELSE v END AS v FROM ({ad.RASTER_SQL}) CROSS JOIN (VALUES ('same'), ('changed'), ('lone')) l(layer)"


@query(f"""SELECT layer, a.sha256 AS left_sha256, b.sha256 AS right_sha256 FROM ({digest_sql(f"SELECT layer, r, c, v FROM ({ad.RASTER_SQL}) CROSS JOIN (VALUES ('same'), ('changed')) l(layer)")}) a FULL JOIN ({digest_sql(_CHANGED)}) b USING (layer) WHERE a.sha256 IS DISTINCT FROM b.sha256""")
def checksum_differences(spark, sf_dir):
    """A store against one with a layer changed and a layer more."""
    x = ad.raster(spark, sf_dir)
    both = x.withColumn("layer", F.lit("same")).union(x.withColumn("layer", F.lit("changed")))
    other = both.withColumn("v", F.when((F.col("layer") == "changed") & (F.col("r") == 7) & (F.col("c") == 7), -1).otherwise(F.col("v"))).union(x.withColumn("layer", F.lit("lone")))
    a, b = (stats.layer_sha256(t, ["layer"], "v") for t in (both, other))
    return stats.checksum_differences(a, b, ["layer"]).select("layer", F.col("left").alias("left_sha256"), F.col("right").alias("right_sha256"))


@query(f"""WITH w AS (SELECT CAST(r // 4 AS INT) AS wr, CAST(c // 4 AS INT) AS wc, count(*) AS k, bool_and(v % 11 <> 0) AS ok FROM ({ad.RASTER_SQL}) GROUP BY 1, 2), g AS (SELECT wr, wc, row_number() OVER (ORDER BY wr, wc) - 1 AS i, count(*) OVER () AS total FROM w WHERE k = 16 AND ok)
  SELECT wr, wc FROM g WHERE i IN (SELECT round_even(k.range * (t.total - 1) / 4.0, 0) FROM range(5) k CROSS JOIN (SELECT DISTINCT total FROM g) t)""")
def valid_windows(spark, sf_dir):
    """Of the windows that are valid in whole, five evenly picked."""
    return windows.valid_windows(ad.raster(spark, sf_dir).withColumn("ok", F.col("v") % 11 != 0), 4, "ok", 5)


# geometry


_FAULTS = f"SELECT lat, lon, lat * 0.9 AS lat2, lon + 3 AS lon2 FROM ({ad.EXTRA_SQL})"


@query(f"""WITH g AS (SELECT CAST(a.range AS INT) AS r, CAST(b.range AS INT) AS c, (a.range + 0.5::DOUBLE) / 2 - 90 AS glat, (b.range + 0.5::DOUBLE) / 2 - 180 AS glon FROM range(360) a CROSS JOIN range(720) b),
  s AS (SELECT r, c, {_v('lat', 'lon', 'a')}, {_v('lat2', 'lon2', 'e')}, {_v('glat', 'glon', 'p')} FROM g CROSS JOIN ({_FAULTS})),
  n AS (SELECT *, ay*ez-az*ey AS nx, az*ex-ax*ez AS ny, ax*ey-ay*ex AS nz FROM s),
  m AS (SELECT *, ny*pz-nz*py AS mx, nz*px-nx*pz AS my, nx*py-ny*px AS mz, sqrt(nx*nx+ny*ny+nz*nz) AS size FROM n)
  SELECT r, c, round(min(CASE WHEN mx*ax+my*ay+mz*az <= 0 AND mx*ex+my*ey+mz*ez >= 0 AND size > 0 THEN {R}*abs(asin(least(1.0, greatest(-1.0, (px*nx+py*ny+pz*nz)/size))))
    ELSE {R}*acos(least(1.0, greatest(-1.0, greatest(px*ax+py*ay+pz*az, px*ex+py*ey+pz*ez)))) END), 2) AS km FROM m GROUP BY 1, 2""")
def distance_30min(spark, sf_dir):
    """Distances at half a degree, down from 20, 5 and 1 degrees."""
    segs = ad.extra(spark, sf_dir).select("lat", "lon", (F.col("lat") * 0.9).alias("lat2"), (F.col("lon") + 3).alias("lon2"))
    return lines.distance_pyramid(segs, [20, 5, 1, Fraction(1, 2)]).withColumn("km", r6(F.col("km"), 2))


_FRAME = "SELECT s_suppkey AS fid, CAST(s_suppkey * 37 % 300 - 170 AS DOUBLE) + 0.0137::DOUBLE AS x, CAST(s_suppkey * 53 % 140 - 80 AS DOUBLE) + 0.0171::DOUBLE AS y, CAST(s_suppkey % 9 + 6 AS DOUBLE) AS w, CAST(s_suppkey % 5 + 6 AS DOUBLE) AS h FROM supplier"


@query(f"""SELECT fid, count(*) AS cells, CAST(sum(r) AS BIGINT) AS rows_sum, CAST(sum(c) AS BIGINT) AS cols_sum FROM (SELECT fid, a.range AS r, b.range AS c, x, y, w, h, b.range + 0.5 - 180 AS px, a.range + 0.5 - 90 AS py FROM ({_FRAME}) CROSS JOIN range(180) a CROSS JOIN range(360) b)
  WHERE px >= x AND px < x + w AND py >= y AND py < y + h AND NOT (px >= x + 2 AND px < x + w - 2 AND py >= y + 2 AND py < y + h - 2) GROUP BY 1""")
def ring_with_hole(spark, sf_dir):
    """Cells of frames: boxes with a box cut out."""
    n = F.col("s_suppkey")
    x, y, w, h = (n * 37 % 300 - 170).cast("double") + 0.0137, (n * 53 % 140 - 80).cast("double") + 0.0171, (n % 9 + 6).cast("double"), (n % 5 + 6).cast("double")
    box = lambda d: F.array(*[F.struct((x + d + a * (w - 2 * d)).alias("x"), (y + d + b * (h - 2 * d)).alias("y")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))])
    frames = ad.read(spark, sf_dir, "supplier").select(n.alias("fid"), F.array(box(0), box(2)).alias("rings"))
    return geometry.burn_rings(frames, 1.0, 180, 360).groupBy("fid").agg(F.count("*").alias("cells"), F.sum("r").alias("rows_sum"), F.sum("c").alias("cols_sum"))


@query("""SELECT s_suppkey AS line, CAST(CASE WHEN s_suppkey % 3 = 0 THEN 1 WHEN s_suppkey % 3 = 1 THEN -1 ELSE 0 END AS INT) AS winding FROM supplier""")
def ring_windings(spark, sf_dir):
    """Rings round a pole, eastward and westward, and rings that stay on one side."""
    k = F.col("s_suppkey") % 3
    step = F.when(k == 0, 60).when(k == 1, -60).otherwise(0)
    at = F.col("s_suppkey") * 31 % 360
    raw = ad.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("line"), F.explode(F.sequence(F.lit(0), F.lit(6))).alias("seq"), step.alias("step"), at.alias("at"))
    lon = grid.wrap_lon((F.col("at") + F.col("seq") * F.col("step") + F.when(F.col("step") == 0, F.when(F.col("seq").between(1, 5), 20).otherwise(0)).otherwise(0)).cast("double"))
    return windows.windings(raw.select("line", "seq", lon.alias("lon")), "line", "seq")


@query("SELECT CAST(count(*) FILTER (WHERE n_nationkey % 5 = 0) AS BIGINT) AS dropped, CAST(count(*) FILTER (WHERE n_nationkey % 5 = 1) AS BIGINT) AS long FROM nation")
def segment_faults(spark, sf_dir):
    """Segments without length and of 90 degrees or more are counted."""
    k = F.col("n_nationkey")
    lat, lon = k.cast("double"), (k * 7).cast("double")
    return geometry.segment_faults(ad.read(spark, sf_dir, "nation").select(lat.alias("lat"), lon.alias("lon"), F.when(k % 5 == 0, lat).otherwise(lat + 1).alias("lat2"), F.when(k % 5 == 1, lon + 179).otherwise(lon).alias("lon2")))


@query(f"""SELECT id, round(abs(asin(least(1.0, greatest(-1.0, sin(d) * sin(b1 - b2))))) * {R}, 3) AS km FROM (SELECT id,
  2 * asin(sqrt(least(1.0, pow(sin(radians(10 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(10)) * pow(sin(radians(20 - lon) / 2), 2)))) AS d,
  atan2(sin(radians(20 - lon)) * cos(radians(10)), cos(radians(lat)) * sin(radians(10)) - sin(radians(lat)) * cos(radians(10)) * cos(radians(20 - lon))) AS b1,
  atan2(sin(radians(lon2 - lon)) * cos(radians(lat2)), cos(radians(lat)) * sin(radians(lat2)) - sin(radians(lat)) * cos(radians(lat2)) * cos(radians(lon2 - lon))) AS b2
  FROM (SELECT id, lat, lon, lat * 0.9 AS lat2, lon + 3 AS lon2 FROM ({ad.EXTRA_SQL})))""")
def cross_track(spark, sf_dir):
    x = ad.extra(spark, sf_dir)
    km = geometry.cross_track(F.lit(10.0), F.lit(20.0), F.col("lat"), F.col("lon"), F.col("lat") * 0.9, F.col("lon") + 3)
    return x.select("id", F.round(km, 3).alias("km"))


# sidecars


@query(f"SELECT id, CASE WHEN id % 5 <> 0 THEN round(lon, 3) END AS lon_180, id % 5 <> 0 AS located FROM ({ad.PRIMARY_SQL})")
def point_sidecar(spark, sf_dir):
    x = ad.primary(spark, sf_dir).withColumn("lat", F.when(F.col("id") % 5 != 0, F.col("lat")))
    return sidecars.point_table(x).select("id", F.round("lon_180", 3).alias("lon_180"), F.col("geometry").isNotNull().alias("located"))


@query("SELECT c_custkey AS id, CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 3 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 5 WHEN 'HOUSEHOLD' THEN 2 WHEN 'MACHINERY' THEN 4 END AS INT) AS code FROM customer")
def coded_sidecar(spark, sf_dir):
    codes = {"BUILDING": 1, "HOUSEHOLD": 2, "AUTOMOBILE": 3, "MACHINERY": 4, "FURNITURE": 5}
    return sidecars.code_table(ad.read(spark, sf_dir, "customer"), "c_mktsegment", codes).select(F.col("c_custkey").alias("id"), "code")


@query(f"SELECT r, c, CAST(v AS DOUBLE) AS v FROM (SELECT CAST(r // 2 AS INT) AS r, CAST(c // 2 AS INT) AS c, round(sum(v) / count(v), 5) AS v FROM (SELECT r, c, CASE WHEN v % 7 <> 0 THEN v END AS v FROM ({ad.RASTER_SQL})) GROUP BY 1, 2)")
def block_weighted_holes(spark, sf_dir):
    """Missing cells as NaN: they weigh nothing."""
    x = ad.raster(spark, sf_dir).withColumn("v", F.when(F.col("v") % 7 != 0, F.col("v").cast("double")).otherwise(float("nan"))).withColumn("w", F.lit(1.0))
    return kernels.block_weighted(x, kernels.whole_blocks(36, 72, 2)).withColumn("v", r6(F.col("v"), 5))

"""Registered queries of polygons on grids, the cell index, overlaps by axis, and texts read in splits, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import cell_index, geometry, kernels, lines, polygons, states
from tessera.plans import adapters as ad
from tessera.plans.catalog import _BOX, _BURN, _OVER, _SPLIT, _U, R, _box_sides, _boxes, _segments, _v, query, r6
from tessera.sources import chunks, ordinals
from tessera.sources.scratch import kept, scratch_path

# polygons

_CODED = f"SELECT *, CAST(fid % 4 AS INT) AS thick FROM ({_BURN})"


def _coded(spark, sf_dir):
    boxes = _boxes(spark, sf_dir).withColumns({"thick": (F.col("fid") % 4).cast("int"), "rings": F.array("ring")}).drop("ring")
    return polygons.burn_codes(polygons.fill(boxes, 1.0, 180, 360), ["code", "thick"], "size", "fid")


@query(f"""SELECT r, c, code, coalesce(thick, 0) AS thick, n_hits FROM (SELECT r, c, code, count(*) OVER (PARTITION BY r, c) AS n_hits, row_number() OVER (PARTITION BY r, c ORDER BY size, fid DESC) AS k FROM ({_CODED}))
  LEFT JOIN (SELECT r, c, thick FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY size, fid DESC) AS k FROM ({_CODED}) WHERE thick <> 0) WHERE k = 1) USING (r, c) WHERE k = 1""")
def codes_together(spark, sf_dir):
    """Two layers of codes burnt in one aggregation; a polygon without the second code leaves it to the others."""
    return _coded(spark, sf_dir)


@query(f"SELECT count(*) FILTER (WHERE n > 1) AS overlap, 64800 - count(*) AS uncovered FROM (SELECT r, c, count(*) AS n FROM ({_BURN}) GROUP BY 1, 2)")
def burn_counts(spark, sf_dir):
    return polygons.burn_counts(_coded(spark, sf_dir), 180, 360)


@query(f"SELECT fid, r, min(c) AS c0, max(c) AS c1 FROM ({_BURN}) GROUP BY 1, 2")
def scanline_runs(spark, sf_dir):
    """Runs of columns of convex polygons: one a row."""
    boxes = _boxes(spark, sf_dir).select("fid", F.array("ring").alias("rings"))
    return polygons.runs(polygons.edges(boxes), 1.0, 180, 360, ["fid"])


# cell index

_CORNERS = "SELECT fid, x + a1 * w AS lon, y + b1 * h AS lat, x + a2 * w AS lon2, y + b2 * h AS lat2 FROM ({box}) CROSS JOIN (VALUES (0, 0, 1, 0.25::DOUBLE), (1, 0.25::DOUBLE, 1, 1), (1, 1, 0, 0.75::DOUBLE), (0, 0.75::DOUBLE, 0, 0)) e(a1, b1, a2, b2)".format(box=_BOX)
_INSIDE = f"SELECT id, fid FROM ({ad.PRIMARY_SQL}) JOIN ({_BOX}) ON lon >= x AND lon < x + w AND lat >= y + 0.25::DOUBLE * h * (lon - x) / w AND lat < y + 0.75::DOUBLE * h + 0.25::DOUBLE * h * (lon - x) / w"


def _in_box():
    """Whether a box holds a point, by its own sides: for points on an edge, where the corners are rounded."""
    x, y, w, h = _box_sides(F.col("fid"))
    lat, lon = F.col("lat"), F.col("lon")
    return (lon >= x) & (lon < x + w) & (lat >= y + 0.25 * h * (lon - x) / w) & (lat < y + 0.75 * h + 0.25 * h * (lon - x) / w)


@query(f"SELECT id, fid FROM ({_INSIDE})")
def contained(spark, sf_dir):
    """Each point and each polygon that holds it, by cells of several levels; points on an edge by the polygon's own sides."""
    boxes = _boxes(spark, sf_dir).select("fid", F.array("ring").alias("rings"))
    return cell_index.contained(ad.primary(spark, sf_dir), cell_index.cover(boxes), decide=_in_box())


@query(f"""WITH s AS (SELECT id, fid, {_v('p.lat', 'p.lon', 'p')}, {_v('e.lat', 'e.lon', 'a')}, {_v('lat2', 'lon2', 'e')} FROM ({ad.PRIMARY_SQL}) p CROSS JOIN ({_CORNERS}) e),
  n AS (SELECT *, ay*ez-az*ey AS nx, az*ex-ax*ez AS ny, ax*ey-ay*ex AS nz FROM s),
  m AS (SELECT *, ny*pz-nz*py AS mx, nz*px-nx*pz AS my, nx*py-ny*px AS mz, sqrt(nx*nx+ny*ny+nz*nz) AS size FROM n),
  d AS (SELECT id, min(CASE WHEN mx*ax+my*ay+mz*az <= 0 AND mx*ex+my*ey+mz*ez >= 0 AND size > 0 THEN {R}*abs(asin(least(1.0, greatest(-1.0, (px*nx+py*ny+pz*nz)/size))))
    ELSE {R}*acos(least(1.0, greatest(-1.0, greatest(px*ax+py*ay+pz*az, px*ex+py*ey+pz*ez)))) END) AS km FROM m GROUP BY id)
  SELECT d.id, CAST(i.fid IS NOT NULL AS INT) AS held, CASE WHEN i.fid IS NULL THEN round(km, 3) ELSE 0 END AS km FROM d LEFT JOIN (SELECT id, min(fid) AS fid FROM ({_INSIDE}) GROUP BY id) i USING (id)""")
def held_or_nearest(spark, sf_dir):
    """Points in a polygon at 0 km, all others with the distance to the nearest edge of any polygon."""
    boxes = _boxes(spark, sf_dir).select("fid", F.array("ring").alias("rings"))
    found = cell_index.held_or_nearest(ad.primary(spark, sf_dir), boxes, decide=_in_box())
    return found.select("id", F.col("held").cast("int").alias("held"), F.round("km", 3).alias("km"))


# overlaps


@query(f"SELECT r, c, round(sum(v * w) / sum(w), 5) AS v, round(sum(w), 4) AS weight FROM ({_OVER}) WHERE v IS NOT NULL GROUP BY 1, 2")
def overlap_by_axis(spark, sf_dir):
    """``overlap_mean`` with columns reduced before rows."""
    src = ad.raster(spark, sf_dir).withColumn("v", F.when(F.col("v") % 7 != 0, F.col("v").cast("double")))
    c, r = F.col("c").cast("long"), F.col("r").cast("long")
    x0 = c * 5 * _U - 5 * _U // 2
    out = kernels.overlap_mean_by_axis(src, x0, x0 + 5 * _U, r * 5 * _U, (r + 1) * 5 * _U, 4 * _U)
    return out.select("r", "c", r6(F.col("v"), 5).alias("v"), r6(F.col("weight"), 4).alias("weight"))


# texts in splits


@query("SELECT row_number() OVER (ORDER BY event_id) AS line, event_id, user_id FROM events")
def line_ordinals(spark, sf_dir):
    """Events written as text in order and read back in splits: each line's number over all files is its rank."""
    path = scratch_path(spark, "lines")
    ad.read(spark, sf_dir, "events").orderBy("event_id").select(F.concat_ws(" ", "event_id", "user_id")).write.text(path)
    t = F.split("value", " ")
    return ordinals.numbered(spark, path, across=True).select("line", t[0].cast("long").alias("event_id"), t[1].cast("long").alias("user_id"))


@query("SELECT event_id, event_type || chr(10) || chr(10) || props || ', \"' || event_type || '\"' AS note FROM events")
def record_fields(spark, sf_dir):
    """Events written as records whose quoted field spans lines, read back in splits and put together."""
    path = scratch_path(spark, "records")
    note = F.concat("event_type", F.lit("\n\n"), "props", F.lit(', "'), "event_type", F.lit('"'))
    ad.read(spark, sf_dir, "events").select(F.concat(F.col("event_id").cast("string"), F.lit(',"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"'))).write.text(path)
    parsed = F.from_csv("value", "event_id long, note string", {"escape": '"', "multiLine": "true"})
    return ordinals.records(spark, path).select(parsed.alias("p")).select("p.*")


# lines

_WALK = f"SELECT line, x, y, dx, dy, greatest(abs(dx), abs(dy)) AS n, least(abs(dx), abs(dy)) AS m FROM (SELECT user_id AS line, floor((lon + 180) / 2) AS x, 89 - floor((90 - lat) / 2) AS y, floor((lon2 + 180) / 2) - floor((lon + 180) / 2) AS dx, floor((90 - lat) / 2) - floor((90 - lat2) / 2) AS dy FROM ({_SPLIT}))"


@query(f"""SELECT line, count(*) AS cells, CAST(sum(r) AS BIGINT) AS rows_sum, CAST(sum(c) AS BIGINT) AS cols_sum FROM (
  SELECT line, CAST(y + sign(dy) * CASE WHEN abs(dx) >= abs(dy) THEN g ELSE i END AS INT) AS r, CAST(x + sign(dx) * CASE WHEN abs(dx) >= abs(dy) THEN i ELSE g END AS INT) AS c
  FROM (SELECT *, CASE WHEN n = 0 THEN 0 ELSE floor((2 * i * m + n - 1) / (2 * n)) END AS g FROM (SELECT *, unnest(range(0, CAST(n AS BIGINT) + 1)) AS i FROM ({_WALK})))) WHERE r BETWEEN 0 AND 89 AND c BETWEEN 0 AND 179 GROUP BY 1""")
def line_walk(spark, sf_dir):
    """Cells of each line's walk, a cell a column or row."""
    segs = geometry.split_dateline(_segments(spark, sf_dir)).withColumnRenamed("user_id", "line")
    return lines.walked_cells(segs, 2.0, 90, 180).groupBy("line").agg(F.count("*").alias("cells"), F.sum("r").alias("rows_sum"), F.sum("c").alias("cols_sum"))


# clips


@query(f"SELECT fid, round(0.75 * h * (least(x + w, 100) - greatest(x, -100)), 6) AS area FROM ({_BOX}) WHERE least(x + w, 100) > greatest(x, -100)")
def window_areas(spark, sf_dir):
    """Polygons cut to a window of longitudes, and their areas in it."""
    cut = polygons.clipped(_boxes(spark, sf_dir).select("fid", "ring"), "ring", -100.0, -90.0, 100.0, 90.0)
    return cut.select("fid", r6(polygons.plane_area(F.col("ring"))).alias("area"))


# stored layers and states


def _density_6min(spark, sf_dir):
    at = ad.points(spark, sf_dir)
    r, c = F.floor((F.col("lat") + 90.0003) * 10).cast("int"), F.floor((F.col("lon") + 180.0003) * 10).cast("int")
    return at.groupBy(r.alias("r"), F.least(c, F.lit(3599)).alias("c")).agg(F.count("*").alias("v")).where("r < 1800")


_DENSITY_6MIN = f"SELECT CAST(floor((lat + 90.0003::DOUBLE) * 10) AS INT) AS r, least(CAST(floor((lon + 180.0003::DOUBLE) * 10) AS INT), 3599) AS c, count(*) AS v FROM ({ad.POINTS_SQL}) GROUP BY 1, 2 HAVING CAST(floor((lat + 90.0003::DOUBLE) * 10) AS INT) < 1800"


def _stored(spark, cells, name):
    path = scratch_path(spark, name)
    return chunks.write_chunks(cells, path.rsplit("/", 1)[-1].replace("-", "_"), "6min", path)


@query(f"SELECT r, c, v FROM ({_DENSITY_6MIN}) WHERE (r + 0.5) / 10 - 90 BETWEEN 10 AND 60 AND ((c + 0.5) / 10 - 180 >= 150 OR (c + 0.5) / 10 - 180 <= -120)")
def chunk_box(spark, sf_dir):
    """A box across the dateline, read from the chunks that it meets."""
    return chunks.in_box(_stored(spark, _density_6min(spark, sf_dir), "boxed"), "6min", 10.0, 60.0, 150.0, -120.0).select("r", "c", "v")


@query(f"SELECT r, c, v, v * 3 AS w FROM ({_DENSITY_6MIN}) WHERE v >= 1 AND (r + c) % 2 = 0")
def chunk_join(spark, sf_dir):
    """Two stored layers joined on their cells, bucket by bucket."""
    x = _density_6min(spark, sf_dir)
    a, b = _stored(spark, x, "left"), _stored(spark, x.where((F.col("r") + F.col("c")) % 2 == 0).withColumn("w", F.col("v") * 3).drop("v"), "right")
    return a.drop("chunk").join(b.drop("chunk"), ["r", "c"])


_REFRESH = f"SELECT CAST(r // 6 AS INT) AS tr, CAST(c // 6 AS INT) AS tc, v FROM ({ad.RASTER_SQL}) WHERE NOT (r < 6 AND c BETWEEN 6 AND 11)"


def _refreshed(spark, sf_dir):
    now = ad.raster(spark, sf_dir).where("not (r < 6 and c between 6 and 11)")
    before = ad.raster(spark, sf_dir).where("r < 30").withColumn("v", F.when((F.col("r") < 12) & (F.col("c") < 18), F.col("v") + 1).otherwise(F.col("v")))
    held = kept(states.tile_states(before, 6, 0.0, 50.0, 40), "states")
    return states.refreshed(held, now, 6, 0.0, 50.0, 40)


@query(f"SELECT tr, tc, count(*) AS n, CAST(sum(v) AS DOUBLE) AS total, CAST(min(v) AS DOUBLE) AS least, CAST(max(v) AS DOUBLE) AS most FROM ({_REFRESH}) GROUP BY 1, 2")
def states_refreshed(spark, sf_dir):
    """States of tiles after cells changed, came and went: as if all were counted anew."""
    return states.merged(_refreshed(spark, sf_dir), F.col("tr"), F.col("tc")).drop("mean")


@query(f"SELECT CAST(least(v // 50, 39) AS INT) AS bin, count(*) AS n FROM ({_REFRESH}) GROUP BY 1")
def states_histogram(spark, sf_dir):
    """The histogram of all cells, from the tiles' states alone."""
    return states.merged_histogram(_refreshed(spark, sf_dir))

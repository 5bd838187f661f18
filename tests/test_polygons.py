"""Scanline fill, codes burnt together, and the cell index, against ray casts and distances in numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cell_index, geometry, polygons
from tessera.functions.grid import RADIUS_KM

RING = "array<array<struct<x:double,y:double>>>"


def ring_table(spark, shapes):
    return spark.createDataFrame([(k, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for k, rings in enumerate(shapes)], f"fid long, rings {RING}")


def star(x, y, size, n, rng):
    a = np.sort(rng.random(n)) * 2 * math.pi
    r = size * (0.3 + 0.7 * rng.random(n))
    return list(zip((x + r * np.cos(a)).tolist(), (y + r * np.sin(a) / 2).tolist()))


def shapes():
    rng = np.random.default_rng(4)
    box = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d)]
    return [
        [box(0, 0, 1, 1)], [box(0.1, 0.2, 0.2, 0.3)], [box(-180, 85, 180, 90)], [box(-10, -10, 10, 10), box(-5, -5, 5, 5), box(-1, -1, 1, 1)],
        [box(0, 0, 10, 10) + [(0, 0)]], [[(20, 20), (30, 20.5), (25, 40)]], [[(0, 0), (10, 10), (10, 0), (0, 10)]], [box(-200, -95, 200, 95)],
        *[[star(rng.uniform(-150, 150), rng.uniform(-60, 60), rng.uniform(5, 25), 40, rng)] for _ in range(6)], [[(1, 1)]], [[(1, 1), (2, 2)]],
    ]


def held(rings, x, y):
    odd = np.zeros(np.broadcast(x, y).shape, bool)
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
            if y1 != y2:
                odd ^= ((y2 > y) != (y1 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return odd


@pytest.mark.parametrize("res", [1.0, 0.5])
def test_fill(spark, res):
    nlat, nlon = int(180 / res), int(360 / res)
    got = {(r.fid, r.r, r.c) for r in polygons.fill(ring_table(spark, shapes()).withColumn("more", F.lit("x")), res, nlat, nlon).collect()}
    y, x = np.meshgrid((np.arange(nlat) + 0.5) * res - 90, (np.arange(nlon) + 0.5) * res - 180, indexing="ij")
    assert got == {(k, int(r), int(c)) for k, rings in enumerate(shapes()) for r, c in zip(*np.nonzero(held([[(float(a), float(b)) for a, b in ring] for ring in rings], x, y)))}


def test_large_polygon_in_many_tasks(spark):
    """No box of cells and no whole ring beside them: rows of a polygon are grouped by polygon and row."""
    rng = np.random.default_rng(1)
    one = ring_table(spark, [[star(0, 0, 170, 5000, rng)]])
    plan = polygons.fill(one, 0.1, 1800, 3600)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "hashpartitioning(_polygon" in plan and "Cartesian" not in plan
    parts = polygons.runs(polygons.edges(one), 0.1, 1800, 3600, ["fid"]).select(F.spark_partition_id().alias("p")).distinct()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert parts.count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_codes_together(spark):
    """The smallest polygon with a code wins each layer by itself; one without a code still covers."""
    rows = [(0, 100.0, 9, 3, [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]]), (1, 4.0, 2, 0, [[(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)]]), (2, 4.0, 5, 7, [[(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)]])]
    burnt = polygons.burn_codes(polygons.fill(spark.createDataFrame(rows, f"fid long, size double, lith int, thick int, rings {RING}"), 1.0, 180, 360), ["lith", "thick"], "size", "fid")
    got = {(r.r, r.c): (r.lith, r.thick, r.n_hits) for r in burnt.collect()}
    assert all(got[r, c] == ((5, 7, 3) if 94 <= r < 96 and 184 <= c < 186 else (9, 3, 1)) for r in range(90, 100) for c in range(180, 190)) and len(got) == 100
    assert polygons.burn_counts(burnt, 180, 360).first().asDict() == {"overlap": 4, "uncovered": 180 * 360 - 100}
    no_thickness = polygons.burn_codes(polygons.fill(spark.createDataFrame(rows[1:2], f"fid long, size double, lith int, thick int, rings {RING}"), 1.0, 180, 360), ["lith", "thick"], "size", "fid")
    assert {(r.lith, r.thick) for r in no_thickness.collect()} == {(2, 0)}


@pytest.fixture(scope="module")
def places(spark):
    rng = np.random.default_rng(9)
    rows = [(i, math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for i in range(700)] + [(900, 90.0, 0.0), (901, -90.0, 17.0), (902, 0.0, 180.0), (903, 0.0, -180.0), (904, None, 1.0), (905, float("nan"), 2.0)]
    return rows, spark.createDataFrame([(i, a, float(b)) for i, a, b in rows], "id long, lat double, lon double")


@pytest.mark.parametrize("level,deepest,many", [(6, 14, 32), (3, 9, 2), (2, 2, 1)])
def test_contained(spark, places, level, deepest, many):
    """Full cells of every size, cells with edges, quarters of those with many."""
    mine = [s for s in shapes() if len(s[0]) > 2][:2] + shapes()[2:7] + shapes()[8:14]
    rows, points = places
    cells = cell_index.cover(ring_table(spark, mine), level=level, deepest=deepest, many=many)
    got = {(r.id, r.fid) for r in cell_index.contained(points, cells, deepest=deepest).collect()}
    want = {(i, k) for i, lat, lon in rows if lat is not None and not math.isnan(lat) for k, rings in enumerate(mine) if bool(held(rings, np.float64(lon), np.float64(lat)))}
    at_edge = {900, 902}  # on the closed end of a cell that holds its lower end only
    assert {x for x in got if x[0] not in at_edge} == {x for x in want if x[0] not in at_edge}


@pytest.mark.parametrize("level,step", [(6, 2), (3, 1), (1, 1)])
def test_nearest(spark, places, level, step):
    rows, points = places
    rng = np.random.default_rng(2)
    segs = [(k, float(a), float(b), float(a + rng.uniform(-8, 8)), float(b + rng.uniform(-20, 20))) for k, (a, b) in enumerate(zip(rng.uniform(-80, 80, 60), rng.uniform(-180, 180, 60)))]
    segs += [(100, 89.0, 0.0, 89.0, 170.0), (101, 10.0, 175.0, 12.0, -175.0), (102, 5.0, 5.0, 5.0, 5.0)]
    table = spark.createDataFrame(segs, "sid long, lat double, lon double, lat2 double, lon2 double")
    got = {r.id: (r.sid, r.km) for r in cell_index.nearest(points, table, level=level, step=step).collect()}
    every = points.where("lat between -90 and 90").select("id", F.col("lat").alias("a"), F.col("lon").alias("b")).join(table)
    km = geometry.segment_distance(geometry.unit_vector(F.col("a"), F.col("b")), geometry.unit_vector(F.col("lat"), F.col("lon")), geometry.unit_vector(F.col("lat2"), F.col("lon2")))
    want = {r.id: (r.m.sid, r.m.km) for r in every.groupBy("id").agg(F.min(F.struct(km.alias("km"), "sid")).alias("m")).collect()}
    assert got == want and max(v for _, v in got.values()) < RADIUS_KM * math.pi


def test_held_or_nearest(spark, places):
    rows, points = places
    mine = shapes()[8:14]
    got = {r.id: (r.fid, r.km) for r in cell_index.held_or_nearest(points, ring_table(spark, mine)).collect()}
    inside = {i: min(k for k, rings in enumerate(mine) if held(rings, np.float64(lon), np.float64(lat))) for i, lat, lon in rows if lat == lat and lat is not None and any(held(rings, np.float64(lon), np.float64(lat)) for rings in mine)}
    assert len(got) == 704 and {i: v for i, (v, km) in got.items() if km == 0} == inside and all(km > 0 for i, (_, km) in got.items() if i not in inside)


def test_each_cut_once(spark):
    """No cut of a window holds the one before in each place where it names the ring."""
    one = spark.createDataFrame([(1, [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)])], "fid int, ring array<struct<x double, y double>>")
    cut = polygons.clipped(one, "ring", 2.0, 3.0, 8.0, 9.0)
    assert cut.select(polygons.plane_area(F.col("ring"))).first()[0] == 36.0
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("zip_with") == 4


def test_copies_of_a_polygon_meet_points_once(spark, monkeypatch):
    """Copies make no cells and no pieces of their own; the smallest fid of them is named."""
    ring = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]]
    points = spark.createDataFrame([(1, 2.0, 2.0), (2, 2.0, 9.0)], "id long, lat double, lon double")
    tables = {}
    monkeypatch.setattr(cell_index, "kept", lambda df, name: tables.setdefault(name, df))
    got = {x.id: (x.fid, x.held) for x in cell_index.held_or_nearest(points, ring_table(spark, [ring] * 20)).collect()}
    assert got == {1: (0, True), 2: (0, False)}
    assert {x.fid for x in tables["cover"].collect()} == {0} and tables["pieces"].select("sid").distinct().count() == 1

"""Composed readers on files written by hand, up to a built layer."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.grid import UNITS
from tessera.operators import kernels, merge
from tessera.sources import composed
from tessera.sources.readers import SourceMismatch
from tessera.sources.tables import SourceNotReady
from test_binary import text, tiff


def grid_file(x, y, z):
    """Classic netCDF: dims y and x, their axes, and z as floats."""
    z = np.asarray(z, ">f4")
    head = b"CDF\1" + struct.pack(">i", 0) + struct.pack(">ii", 10, 2) + text("y") + struct.pack(">i", len(y)) + text("x") + struct.pack(">i", len(x)) + struct.pack(">ii", 0, 0)
    entry = lambda name, dims, kind, n: text(name) + struct.pack(">i", len(dims)) + b"".join(struct.pack(">i", d) for d in dims) + struct.pack(">ii", 0, 0) + struct.pack(">ii", kind, n)
    each = [entry("x", [1], 6, 8 * len(x)), entry("y", [0], 6, 8 * len(y)), entry("z", [0, 1], 5, z.size * 4)]
    at = len(head) + 8 + sum(map(len, each)) + 12
    begins = [at, at + 8 * len(x), at + 8 * len(x) + 8 * len(y)]
    return head + struct.pack(">ii", 11, 3) + b"".join(e + struct.pack(">i", b) for e, b in zip(each, begins)) + np.array(x, ">f8").tobytes() + np.array(y, ">f8").tobytes() + z.tobytes()


def write_zones(folder, zones):
    for zone, (x, y, parts) in zones.items():
        for part, z in parts.items():
            (folder / f"{zone}_made_{part}_01.grd").write_bytes(grid_file(x, y, z))


def zones():
    x, y = 10 + 0.05 * np.arange(12), -3 + 0.05 * np.arange(8)
    dep = -np.arange(96.0).reshape(8, 12) - 5
    dep[0, 0] = np.nan
    u, v = 178.0 + 0.02 * np.arange(150), 20 + 0.02 * np.arange(5)
    return {"abc": (x, y, {"dep": dep, "str": 100 + 3 * np.arange(96.0).reshape(8, 12)}), "xyz": (u, v, {"dep": np.full((5, 150), -7.0), "str": np.full((5, 150), 200.0)})}


def test_zone_grids(spark, tmp_path):
    write_zones(tmp_path, zones())
    got = {(r.zone, r.r, r.c): r for r in composed.zone_grids(spark, str(tmp_path), ("dep", "str"), expected=["abc", "xyz"]).collect()}
    assert len(got) == 96 + 750 and got["abc", 1740, 3800].dep is None and got["abc", 1740, 3800]["str"] == 100.0
    assert got["abc", 1741, 3803].dep == 20.0 and got["abc", 1741, 3803]["str"] == (100 + 3 * 15) % 180 and got["abc", 1741, 3803].step == 0.05
    assert got["xyz", 5500, 17900].dep == 7.0 and got["xyz", 5500, 49]["str"] == 20.0  # across the dateline


@pytest.mark.parametrize("rule,change", [
    ("without all parts", lambda z: z["abc"][2].pop("str")),
    ("one grid", lambda z: z.update({"abd": (z["abc"][0] + 0.05, z["abc"][1], {"dep": z["abc"][2].pop("dep")}), "abc": z["abc"]}) or z.update(mix=True)),
    ("step", lambda z: z.update(abc=(10 + 0.03 * np.arange(12), -3 + 0.03 * np.arange(8), z["abc"][2]))),
    ("lattice", lambda z: z.update(abc=(z["abc"][0] + 0.01, z["abc"][1], z["abc"][2]))),
    ("regular", lambda z: z["abc"][0].__setitem__(5, 10.26)),
    ("poles", lambda z: z.update(abc=(z["abc"][0], 89.7 + 0.05 * np.arange(8), z["abc"][2]))),
])
def test_zone_contract(spark, tmp_path, rule, change):
    made = zones()
    change(made)
    if made.pop("mix", None):  # the depth of one zone on another grid
        x, y, parts = made.pop("abd")
        made["abc"][2]["str"] = np.asarray(made["abc"][2]["str"])
        (tmp_path / "abc_made_dep_01.grd").write_bytes(grid_file(x, y, parts["dep"]))
    write_zones(tmp_path, made)
    with pytest.raises((SourceMismatch, SourceNotReady), match=rule):
        composed.zone_grids(spark, str(tmp_path), ("dep", "str"), expected=["abc", "xyz"]).count()


def test_zones_to_layer(spark, tmp_path):
    """From files to a tier: shallowest zone of a node's cell, then the area-weighted mean of a degree."""
    write_zones(tmp_path, {"abc": zones()["abc"]} | {"lap": (10 + 0.05 * np.arange(4), -3 + 0.05 * np.arange(4), {"dep": np.full((4, 4), -1.0), "str": np.full((4, 4), 30.0)})})
    nodes = composed.zone_grids(spark, str(tmp_path), ("dep", "str"))
    best = merge.shallowest(nodes, payload=("str",))
    assert {(r.zone, r.n_zones) for r in best.where("r = 1741 and c = 3801").collect()} == {("lap", 2)} and best.count() == 96
    u = UNITS // 20
    c, r = F.col("c").cast("long"), F.col("r").cast("long")
    edge = lambda k: k * u - u // 2  # noqa: E731  nodes stand in the middle of their cells
    built = {(x.r, x.c): (x.v, x.weight) for x in kernels.overlap_mean_by_axis(best.withColumn("v", F.col("dep")), edge(c), edge(c + 1), edge(r), edge(r + 1), UNITS).collect()}
    plain = {(x.r, x.c): (x.v, x.weight) for x in kernels.overlap_mean(kernels.overlaps(best.withColumn("v", F.col("dep")), edge(c), edge(c + 1), edge(r), edge(r + 1), UNITS)).collect()}
    assert set(built) == set(plain) == {(87, 190), (87, 189), (86, 190), (86, 189)} and all(np.allclose(built[k], plain[k], rtol=1e-12) for k in built)


def test_axes_images_rings(spark, tmp_path):
    axis = lambda xs: spark.createDataFrame(list(enumerate(map(float, xs))), "i int, x double")
    assert [r.x for r in composed.named_axis(axis([-1.5, -0.4, 0.5]), -1.5, 1.0, 3, {1: -0.4}).orderBy("i").collect()] == [-1.5, -0.5, 0.5]
    for xs, defects in (([-1.5, -0.4, 0.5], None), ([-1.5, -0.4, 0.5], {1: -0.3}), ([-1.5, -0.5], None)):
        with pytest.raises(SourceMismatch):
            composed.named_axis(axis(xs), -1.5, 1.0, 3, defects)
    two = spark.createDataFrame([(1.0, 1.0), (None, None)], "a double, b double")
    assert composed.identical(two, "a", "b").count() == 2
    with pytest.raises(SourceMismatch):
        composed.identical(two.union(spark.createDataFrame([(1.0, None)], two.schema)), "a", "b")
    values = np.arange(720 * 720).reshape(720, 720) % 3001
    (tmp_path / "g.tif").write_bytes(tiff(values, rows=30))
    got = composed.image_grid(spark, str(tmp_path), 720, 720)
    assert got.where("r = 0").agg(F.sum("v")).first()[0] == values[-1].sum() and got.count() == values.size
    with pytest.raises(SourceMismatch, match="size"):
        composed.image_grid(spark, str(tmp_path), 360, 720)
    with pytest.raises(SourceMismatch, match="corner"):
        composed.image_grid(spark, str(tmp_path), 720, 720, west=-179.5)
    (tmp_path / "g.tif").write_bytes(tiff(np.where(values == 5, -99, values), rows=30))
    with pytest.raises(SourceMismatch, match="values"):
        composed.image_grid(spark, str(tmp_path), 720, 720)
    ring = [(0, "AB", i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)])]
    kind = "line int, title string, seq int, x double, y double"
    assert composed.closed_rings(spark.createDataFrame(ring, kind), "^[A-Z]{2}$", 1).count() == 4
    for rows, rule in ((ring[:-1], "closed"), ([(0, "ab", *r[2:]) for r in ring], "titles"), (ring + [(1, *r[1:]) for r in ring], "titles"), (ring + [(1, "CD", *r[2:]) for r in ring], "number")):
        with pytest.raises(SourceMismatch, match=rule):
            composed.closed_rings(spark.createDataFrame(rows, kind), "^[A-Z]{2}$", 1)

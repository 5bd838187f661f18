import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import cli
from tessera.operators import lines, spectra
from tessera.sources import readers, sidecars


def test_crossed_cells(spark):
    segs = spark.createDataFrame([(1, 0.5, 0.5, 0.5, 3.5), (2, 0.5, 0.5, 2.5, 1.5), (3, None, 0.0, 1.0, 1.0), (4, 90.0, 179.5, 89.5, 180.0)], "line int, lat double, lon double, lat2 double, lon2 double")
    got = {}
    for x in lines.crossed_cells(segs, 1.0, 180, 360).collect():
        got.setdefault(x.line, set()).add((x.r - 90, x.c - 180))
    assert got[1] == {(0, 0), (0, 1), (0, 2), (0, 3)}
    assert got[2] >= {(0, 0), (2, 1)} and 3 not in got
    assert got[4] == {(89, 179)}


def test_shortest_line_wins(spark):
    segs = spark.createDataFrame([(1, 7, 9.0, 0.5, 0.5, 0.5, 9.5), (2, 3, 1.0, 0.5, 2.2, 0.5, 2.8), (3, 0, 0.1, 0.5, 0.1, 0.5, 0.2)], "line int, code int, length double, lat double, lon double, lat2 double, lon2 double")
    got = {x.c - 180: (x.code, x.overlap) for x in lines.burn_lines(segs, 1.0, 180, 360).collect()}
    assert got[2] == (3, True) and got[0] == (7, False) and len(got) == 10


def test_distance_pyramid(spark):
    segs = spark.createDataFrame([(0.0, 0.0, 0.0, 10.0), (60.0, 100.0, 60.0, 100.0)], "lat double, lon double, lat2 double, lon2 double")
    some = spark.createDataFrame([(0, 0)], "r int, c int")
    deep = {(x.r, x.c): x.km for x in lines.distance_pyramid(segs, [30, 10, 2], some).collect()}
    flat = {(x.r, x.c): x.km for x in lines.distance_pyramid(segs, [2]).collect()}
    assert len(deep) == 90 * 180 and deep.pop((0, 0)) == 0.0
    assert all(math.isclose(v, flat[k], abs_tol=1e-6) for k, v in deep.items())


def test_burning_sorts_no_cells(spark):
    """Cells are combined in hash maps: a sort of all of them would spill."""
    segs = spark.createDataFrame([(1, 7, 9.0, 0.5, 0.5, 0.5, 9.5), (2, 3, 9.0, 0.5, 0.5, 0.5, 3.5)], "line int, code int, length double, lat double, lon double, lat2 double, lon2 double")
    burnt = lines.burn_lines(segs, 1.0, 180, 360)
    assert "SortAggregate" not in burnt._jdf.queryExecution().executedPlan().toString()
    assert {x.c - 180: x.code for x in burnt.collect()} == {k: 3 if k < 4 else 7 for k in range(10)}  # of equal ones the last


def test_distance_levels_once(spark):
    """The last level reads what the one above kept, dealt to many tasks; nothing of the levels above is computed again."""
    segs = spark.createDataFrame([(0.0, 0.0, 0.0, 10.0)], "lat double, lon double, lat2 double, lon2 double").coalesce(1)
    plan = lines.distance_pyramid(segs, [20, 5, 1])._jdf.queryExecution().toString()
    assert "Join" not in plan and "REPARTITION_BY_NUM" in plan


def test_octant(spark):
    ring = [(0.0, 0.0), (90.0, 0.0), (0.0, 90.0), (0.0, 0.0)]
    area = spark.createDataFrame([(ring,)], "ring array<struct<x double, y double>>").select(lines.ring_area_km2("ring")).first()[0]
    assert math.isclose(area, 510065621.724 / 8, rel_tol=1e-9)


def test_radial_power(spark):
    x = np.sin(np.arange(16) * 2 * np.pi * 4 / 16)
    cells = spark.createDataFrame([(r, c, float(x[c])) for r in range(16) for c in range(16)] + [(16, 0, 1.0)], "r int, c int, v double")
    got = spectra.radial_power(cells, 16, 0.1, 12).toPandas()
    assert set(got["wr"]) == {0} and got["elements"].sum() == 16 * 9
    top = spectra.window_power(cells, 16, 0.1).orderBy(F.desc("power")).first()
    want = 2 * math.pi * 4 / 1.6 / (math.pi / 180 * 6371.0071810 * math.cos(math.radians(-89.2)))
    assert math.isclose(top.k, want, rel_tol=1e-9)


def test_sidecars(spark, tmp_path):
    df = spark.createDataFrame([(1, 10.0, 190.0), (2, None, 5.0), (3, 95.0, 5.0)], "id int, lat double, lon double")
    got = {x.id: (x.lon_180, x.geometry) for x in sidecars.point_table(df).collect()}
    assert got == {1: (-170.0, "POINT (-170.0 10.0)"), 2: (None, None), 3: (None, None)}
    both = sidecars.union_sources({"a": df, "b": df.drop("lat")})
    assert both.count() == 6 and both.where("source = 'b' and lat is null").count() == 3
    sidecars.require_same_keys(df, df, "id")
    with pytest.raises(readers.SourceMismatch):
        sidecars.require_same_keys(df, df.where("id > 1"), "id")
    (tmp_path / "t" / "u").mkdir(parents=True)
    (tmp_path / "t" / "a.bin").write_bytes(b"12345")
    (tmp_path / "t" / "u" / "b.bin").write_bytes(b"1")
    assert sidecars.tree_stats(spark, str(tmp_path / "t")) == (2, 6)


def test_command_line(spark, tmp_path, capsys):
    good = """
version: 1
status: draft
layers:
- {id: point_density, source: events, native_res: 3min, home_tier: 6min, tiers: [1deg, 6min], dtype: uint32, unit: count, resampling: sum, mask: none, visibility: public}
- {id: later, source: other, native_res: 1deg, home_tier: 1deg, tiers: [1deg], dtype: float32, unit: m, resampling: none, mask: none}
"""
    (tmp_path / "c.yaml").write_text(good)
    (tmp_path / "bad.yaml").write_text(good.replace("native_res: 3min", "native_res: 0.5deg"))
    (tmp_path / "l.json").write_text(json.dumps({"source": "events", "status": "pending"}))
    full, public = str(tmp_path / "store"), str(tmp_path / "public")
    data = "/root/testdata/sf0.001"
    assert cli.main(["build", "--contract", str(tmp_path / "bad.yaml"), "--data", data, "--store", full], spark) == 2
    assert not (tmp_path / "store").exists()
    assert cli.main(["build", "--contract", str(tmp_path / "c.yaml"), "--data", data, "--store", full], spark) == 0
    assert '"later"' in capsys.readouterr().out
    assert cli.main(["validate", "--contract", str(tmp_path / "c.yaml"), "--store", full], spark) == 1  # a layer of the contract is missing
    (tmp_path / "built.yaml").write_text("\n".join(x for x in good.split("\n") if "later" not in x))
    assert cli.main(["validate", "--contract", str(tmp_path / "built.yaml"), "--store", full], spark) == 0
    assert cli.main(["export-public", "--contract", str(tmp_path / "c.yaml"), "--store", full, "--licences", str(tmp_path / "l.json"), "--out", public], spark) == 0
    capsys.readouterr()
    assert cli.main(["checksum", "--store", full], spark) == 0
    first = capsys.readouterr().out
    assert cli.main(["checksum", "--store", public], spark) == 0
    assert capsys.readouterr().out == first and len(first.splitlines()) == 2


def walked(x0, y0, x1, y1):
    """The walk step by step, with its running error."""
    dx, dy, sx, sy = abs(x1 - x0), abs(y1 - y0), (x1 > x0) - (x1 < x0), (y1 > y0) - (y1 < y0)
    n, m, x, y, out = max(dx, dy), min(dx, dy), x0, y0, []
    error = 2 * m - n
    for _ in range(n + 1):
        out.append((y, x))
        side = error > 0
        error += 2 * m - (2 * n if side else 0)
        if dx >= dy:
            x, y = x + sx, y + sy * side
        else:
            x, y = x + sx * side, y + sy
    return out


def test_walk(spark):
    """Equal to the walk with a running error; single cells wide, from end to end, and next to what the segment passes."""
    rng = np.random.default_rng(6)
    segs = [(i, *map(float, rng.uniform(-80, 80, 1)), *map(float, rng.uniform(-170, 170, 1)), *map(float, rng.uniform(-80, 80, 1)), *map(float, rng.uniform(-170, 170, 1))) for i in range(60)]
    segs += [(100, 0.5, 0.5, 0.5, 9.5), (101, 0.5, 0.5, 9.5, 0.5), (102, 0.5, 0.5, 5.5, 5.5), (103, 5.5, 5.5, 0.5, 0.5), (104, 3.2, 3.2, 3.3, 3.3), (105, 1.0, 1.0, 4.0, 9.0)]
    table = spark.createDataFrame(segs, "line long, lat double, lon double, lat2 double, lon2 double")
    got = {}
    for x in lines.walked_cells(table, 1.0, 180, 360).select("line", "r", "c").collect():
        got.setdefault(x.line, []).append((x.r, x.c))
    row, col = (lambda y: 179 - math.floor(90 - y)), (lambda x: math.floor(x + 180))
    assert {k: sorted(v) for k, v in got.items()} == {i: sorted(walked(col(b), row(a), col(d), row(c))) for i, a, b, c, d in segs}
    passed = {(x.line, x.r, x.c) for x in lines.crossed_cells(table.where("line < 100"), 1.0, 180, 360).collect()}
    mine = {(k, *v) for k, vs in got.items() if k < 100 for v in vs}
    assert len(mine) < len(passed) and all(any((k, r + i, c + j) in passed for i in (-1, 0, 1) for j in (-1, 0, 1)) for k, r, c in mine)
    burnt = lines.burn_lines(table.where("line in (100, 101)").withColumns({"code": F.col("line") - 99, "length": F.lit(9.0)}), 1.0, 180, 360, cells=lines.walked_cells)
    assert {(x.r, x.c): (x.code, x.overlap) for x in burnt.collect()} == {(90, 180 + k): (1, False) for k in range(1, 10)} | {(90 + k, 180): (2, False) for k in range(1, 10)} | {(90, 180): (2, True)}

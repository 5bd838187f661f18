"""What sources must be, rules of validity, and geometry beyond single rings."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import grid
from tessera.operators import fidelity, geometry, kernels, lines, merge, stats, windows
from tessera.sources import contract, readers, sidecars, tables


def cells(spark, block, kind="double"):
    return spark.createDataFrame([(r, c, v) for r, row in enumerate(block) for c, v in enumerate(row)], f"r int, c int, v {kind}")


def test_invalid_points(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(90.5, 0.0), (-1000.0, 0.0), (nan, 0.0), (0.0, nan), (0.0, inf), (None, 0.0), (0.0, None), (-90.0, -540.0)], "lat double, lon double")
    assert [(r.r, r.c) for r in grid.point_cells(df, "1deg", drop=True).collect()] == [(0, 0)]
    with pytest.raises(ValueError, match="7 points"):
        grid.point_cells(df, "1deg")
    assert df.select(grid.row_of(F.col("lat"), "1deg").alias("r")).where("r is null").count() == 4


def test_pairs_and_blocks_ignore_what_is_not_finite(spark):
    nan = float("nan")
    rows = [("a", float(i), 2.0 * i + 1) for i in range(201)] + [("a", nan, 1.0), ("a", 1.0, None), ("a", float("inf"), 1.0), ("b", 1.0, 2.0), ("b", nan, 2.0), ("c", None, 2.0)]
    got = {r.part: r for r in stats.pair_stats(spark.createDataFrame(rows, "part string, x double, y double"), "x", "y", "part").collect()}
    assert got["a"].n == 201 and all(math.isclose(got["a"][k], v) for k, v in {"r": 1, "slope": 2, "intercept": 1, "mean_diff": 101, "median_diff": 101, "p05": 11}.items())
    assert got["b"].n == 1 and got["b"].r is None and got["b"].mean_diff is None and got["c"].n == 0 and got["c"].p95 is None
    x = cells(spark, [[1.0, nan], [None, 3.0]]).withColumn("w", F.lit(1.0))
    assert kernels.block_weighted(x, 2).first().v == 2.0
    with pytest.raises(ValueError):
        kernels.whole_blocks(180, 360, 7)


@pytest.mark.parametrize("accuracy", [10_000, 200])
def test_exact_quantiles(spark, monkeypatch, accuracy):
    """Between brackets and in whole groups, with many ties and few values."""
    monkeypatch.setattr(stats, "ACCURACY", accuracy)
    rng = np.random.default_rng(0)
    data = {"even": rng.random(9001), "ties": rng.integers(0, 3, 5000).astype(float), "one": np.full(4000, 7.0), "few": np.array([1.0, 2.0, 4.0]), "long": rng.lognormal(0, 4, 8000)}
    qs = [0.0, 0.001, 0.05, 0.5, 0.95, 0.999, 1.0]
    df = spark.createDataFrame([(k, float(v)) for k, x in data.items() for v in x] + [("even", float("nan")), ("few", None)], "part string, v double")
    got = {(r.part, r.q): r.value for r in stats.exact_quantiles(df, "v", qs, "part").collect()}
    assert set(got) == {(k, q) for k in data for q in qs}
    for (k, q), v in got.items():
        assert math.isclose(v, np.quantile(data[k], q), rel_tol=1e-9), (k, q)


def test_slope_of_one_row(spark):
    got = windows.slope(spark.createDataFrame([(0, c, float(c % 2)) for c in range(4)], "r int, c int, z double"), 1, 4).collect()
    assert len(got) == 4 and all(r.slope == 0 for r in got)


def test_seams(spark):
    nan = float("nan")
    good = cells(spark, [[1.0, 2.0, 1.0], [nan, 2.0, nan], [None, 3.0, None]])
    assert readers.drop_seam(good, 2).count() == 6
    for wrong in ([[1.0, 2.0, nan]], [[None, 2.0, 1.0]], [[1.0, 2.0, 1.5]]):
        with pytest.raises(readers.SourceMismatch):
            readers.drop_seam(cells(spark, wrong), 2, 0.1)
    assert readers.average_seam(cells(spark, [[1.0, 2.0, 1.4]]), 2, guard=0.5).where("c = 0").first().v == 1.2
    with pytest.raises(readers.SourceMismatch):
        readers.average_seam(cells(spark, [[1.0, 2.0, 1.6]]), 2, guard=0.5)


def test_header_lines_go_by_number(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.txt").write_text("5 names\n1 2 3\n" + "".join(f"NA{i} {k} {i}\n" for i in range(50)))
    got = readers.fields(spark, str(tmp_path), ["name", "k", "i"], skip=2, text=("name",)).collect()
    assert len(got) == 150 and {r.name for r in got} == {f"NA{i}" for i in range(50)}
    assert readers.fields(spark, str(tmp_path), ["i"], skip=2, use=[2]).agg(F.sum("i")).first()[0] == 3 * 1225
    with pytest.raises(readers.SourceMismatch, match="numbers"):
        readers.fields(spark, str(tmp_path), ["name", "k", "i"], skip=2)
    with pytest.raises(readers.SourceMismatch, match="width"):
        readers.fields(spark, str(tmp_path), ["a", "b", "c"], text=("a", "b", "c"))


def test_contract_tokens(spark):
    base = dict(source="a", tiers=("1deg",), dtype="float32", unit="1", resampling="none", mask="none")
    rows = [contract.Layer("exact", native_res="exact", home_tier="逐档", **base), contract.Layer("vector", native_res="vector-line（原始矢量）", home_tier="1deg", **base), contract.Layer("odd", native_res="somewhere", home_tier="1deg", **base)]
    assert [tuple(r) for r in contract.violations(contract.frame(spark, contract.Contract("1", "draft", tuple(rows)))).collect()] == [("odd", "native resolution")]


def test_tiles(spark, tmp_path):
    for folder, names in (("bed", ["x_N90W180_bed.tif", "x_S15E165.tif"]), ("surface", ["N90W180.tif", "N00E000.tif", "notes.txt"])):
        (tmp_path / folder).mkdir()
        for n in names:
            (tmp_path / folder / n).write_text(n)
    got = {r.label: r.path for r in tables.tile_files(spark, str(tmp_path / "bed"), str(tmp_path / "surface")).collect()}
    assert set(got) == {"N90W180", "S15E165", "N00E000"} and "bed" in got["N90W180"]
    found = spark.createDataFrame([(k,) for k in got], "label string")
    with pytest.raises(tables.SourceNotReady, match="285 tiles"):
        tables.require_tiles(found, tables.all_tiles(spark))
    assert tables.require_tiles(tables.all_tiles(spark), tables.all_tiles(spark)).count() == 288
    at = tables.tile_bounds(F.lit("N60W030"))
    assert tuple(spark.range(1).select(at["north"], at["west"]).first()) == (60, -30)
    tile = cells(spark, [[1.0, 2.0], [3.0, 4.0]])
    assert tables.require_tile(tile, 2, 2, nodata=-99999).count() == 4
    for wrong, n in ((tile, 3), (tile.union(tile), 2), (tile.withColumn("v", F.when(F.col("v") < 4, F.col("v")).otherwise(-99999.0)), 2)):
        with pytest.raises(readers.SourceMismatch):
            tables.require_tile(wrong, n, 2, nodata=-99999)
    got = tables.mosaic(tile.withColumn("label", F.lit("N90W180")), 2).collect()
    assert {(r.r, r.c): r.v for r in got} == {(23, 0): 1, (23, 1): 2, (22, 0): 3, (22, 1): 4}


def test_slices(spark):
    files = lambda *xs: spark.createDataFrame([(x,) for x in xs], "path string")
    got = tables.slices(files("d/a_390.5Ma.nc", "d/a_0Ma.nc", "d/a_385.2Ma.nc", "d/readme.nc"), expected=3).collect()
    assert [r.age for r in got] == [0, 385, 390]
    for wrong in (("a_5Ma.nc", "b_5.0Ma.nc"), ("a_541Ma.nc",)):
        with pytest.raises(readers.SourceMismatch):
            tables.slices(files(*wrong))
    with pytest.raises(readers.SourceMismatch):
        tables.slices(files("a_5Ma.nc"), expected=2)


def test_csv(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    (tmp_path / "a.csv").write_text('id,note,q\n1,"two\nlines, one record",3.5\n2,NA,\n3,,-1\n')
    got = tables.csv_table(spark, path, ["id", "note", "q"], numbers=("id", "q"), ordinal="source_row").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "two\nlines, one record", 3.5, 1), (2, "NA", None, 2), (3, None, -1, 3)]
    with pytest.raises(readers.SourceMismatch, match="header"):
        tables.csv_table(spark, path, ["id", "notes", "q"])
    with pytest.raises(readers.SourceMismatch, match="numbers"):
        tables.csv_table(spark, path, ["id", "note", "q"], numbers=("note",))
    (tmp_path / "grid.csv").write_text("longiyude;lat;q\n" + "".join(f"{c};{r};1\n" for r in range(2) for c in range(3)))
    full = tables.csv_table(spark, str(tmp_path / "grid.csv"), ["longiyude", "lat", "q"], sep=";", numbers=("longiyude", "lat", "q")).select(F.col("lat").cast("int").alias("r"), F.col("longiyude").cast("int").alias("c"))
    assert tables.require_full_grid(full, 2, 3).count() == 6
    for n in (1, 3):
        with pytest.raises(readers.SourceMismatch):
            tables.require_full_grid(full, n, 3)
    with pytest.raises(readers.SourceMismatch):
        tables.require_unique(full, "r")
    points = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (float("nan"), 2.0)], "lat double, lon double")
    assert tables.locatable(points, expected=1).count() == 1
    with pytest.raises(readers.SourceMismatch):
        tables.locatable(points, expected=2)


def test_fixed_and_free_text(spark, tmp_path):
    line = lambda *xs: spark.createDataFrame([(x,) for x in xs], "value string")
    spec = [("plate", 2, "string"), ("lat", 9, "double"), ("lon", 10, "double"), ("rate", 9, "double")]
    got = tables.fixed_width(line("AF   59.160   -73.174   0.9270", "NA"), spec).collect()
    assert [tuple(r) for r in got] == [("AF", 59.16, -73.174, 0.927), ("NA", None, None, None)]
    with pytest.raises(readers.SourceMismatch):
        tables.fixed_width(line("AF   59.x60"), spec)
    (tmp_path / "z.txt").write_text("title\nmore\n1 2 3\n1 4 5 6 4\n7 8\n9 7\n")
    got = {(r.r, r.c): r.v for r in tables.integer_grid(spark, str(tmp_path / "z.txt"), 3, 4).collect()}
    assert got == {(2, 0): 1, (2, 1): 2, (2, 2): 3, (1, 0): 4, (1, 1): 5, (1, 2): 6, (0, 0): 7, (0, 1): 8, (0, 2): 9}
    (tmp_path / "z.txt").write_text("title\nmore\n1 2 3 2\n")
    with pytest.raises(readers.SourceMismatch, match="seam"):
        tables.integer_grid(spark, str(tmp_path / "z.txt"), 1, 4)
    nodes = cells(spark, [[1.0, 1.0], [2.0, 3.0], [4.0, 4.0]])
    assert tables.require_poles(nodes, 3).count() == 6 and tables.require_range(nodes, 1, 4).count() == 6
    with pytest.raises(readers.SourceMismatch):
        tables.require_poles(nodes, 2)
    with pytest.raises(readers.SourceMismatch):
        tables.require_range(nodes, 1, 3)


def test_trailing_rows_zones_and_evaluations(spark, tmp_path):
    rows = spark.createDataFrame([(-87.45, -179.95, True), (0.123, 0.456, False)], "lat double, lon double, g boolean")
    off = lambda: [grid.nearest_line(F.col("lat"), -87.45, 0.1, 1750)[1], grid.nearest_line(F.col("lon"), -179.95, 0.1, 3600)[1]]
    assert tables.trailing_off_grid(rows, F.col("g"), *off()).count() == 1
    with pytest.raises(readers.SourceMismatch):
        tables.trailing_off_grid(rows.withColumn("lon", F.lit(-179.85)), F.col("g"), *off())
    zone = spark.createDataFrame([("alu", 179.95, 50.0, -100.0, 190.0), ("alu", 180.05, 50.0, -90.0, 10.0)], "zone string, x double, y double, dep double, str double")
    got = tables.zone_lattice(zone, 0.05).orderBy("dep").collect()
    assert [(r.c, r.dep, r.str) for r in got] == [(1, 90, 10), (7199, 100, 10)]
    with pytest.raises(readers.SourceMismatch):
        tables.zone_lattice(zone.withColumn("x", F.col("x") + 0.02), 0.05)
    points = spark.createDataFrame([(0, 1.0, 2.0, 3.0), (1, 4.0, 5.0, 6.0)], "i long, x double, y double, z double")
    (tmp_path / "out.txt").write_text("1 2 3 4.5 4.6\n4 5 6 4.7 4.8\n")
    names = ["a", "b", "c", "vsv", "vsh"]
    assert [r.vsh for r in tables.evaluated(spark, str(tmp_path / "out.txt"), points, names).orderBy("i").collect()] == [4.6, 4.8]
    (tmp_path / "out.txt").write_text("4 5 6 4.7 4.8\n1 2 3 4.5 4.6\n")
    with pytest.raises(readers.SourceMismatch):
        tables.evaluated(spark, str(tmp_path / "out.txt"), points, names)


def test_rings(spark):
    corners = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    frame = spark.createDataFrame([(1, [corners(0.0, 10.0), corners(4.0, 6.0)])], "fid int, rings array<array<struct<x:double,y:double>>>")
    assert geometry.burn_rings(frame, 1.0, 180, 360).count() == 96
    polar = spark.createDataFrame([(1, [(-180.0, 60.0), (-60.0, 60.0), (60.0, 60.0), (180.0, 60.0)], 1)], "fid int, ring array<struct<x:double,y:double>>, winding int")
    closed = polar.withColumn("ring", geometry.close_pole(F.col("ring"), F.col("winding")))
    assert geometry.burn(closed, 10.0, 18, 36).count() == 3 * 36
    across = spark.createDataFrame([(1, corners(0.0, 10.0))], "fid int, ring array<struct<x:double,y:double>>").withColumn("ring", F.transform("ring", lambda p: F.struct((p.x + 175).alias("x"), p.y.alias("y"))))
    parts = geometry.turned_copies(across)
    assert parts.count() == 2 and sorted({r.c for r in geometry.burn(parts, 1.0, 180, 360).collect()}) == [*range(5), *range(355, 360)]
    twice = spark.createDataFrame([(1, k, float((k * 60 + 180) % 360 - 180)) for k in range(13)], "line int, seq int, lon double")
    with pytest.raises(ValueError):
        windows.windings(twice, "line", "seq")
    assert windows.windings(twice.where("seq < 7"), "line", "seq").first().winding == 1
    with pytest.raises(ValueError):
        geometry.require_short(spark.createDataFrame([(0.0, 0.0, 0.0, 90.5)], "lat double, lon double, lat2 double, lon2 double"))
    with pytest.raises(ValueError):
        grid.require_contiguous(spark.createDataFrame([("z", c) for c in (0, 1, 5, 6, 20)], "zone string, c int"), "zone", 36)
    assert grid.require_contiguous(spark.createDataFrame([("z", c) for c in (35, 0, 1)], "zone string, c int"), "zone", 36).count() == 3


def test_distances_below_a_degree(spark):
    from fractions import Fraction

    segs = spark.createDataFrame([(0.0, 0.0, 0.0, 10.0)], "lat double, lon double, lat2 double, lon2 double")
    got = lines.distance_pyramid(segs, [20, 5, 1, Fraction(1, 2)]).where("r = 200 and c = 360").first()
    assert math.isclose(got.km, math.radians(10.25) * grid.RADIUS_KM, rel_tol=1e-9)
    with pytest.raises(ValueError):
        lines.distance_pyramid(segs, [20, 3])


def test_sidecars_and_groups(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "x.bin").write_bytes(b"12345")
    (tmp_path / "a" / "b" / "y.txt").write_text("hello")
    assert sidecars.copy_tree(spark, str(tmp_path / "a"), str(tmp_path / "copy")) == (2, 10) and (tmp_path / "copy" / "b" / "y.txt").read_text() == "hello"
    with pytest.raises(readers.SourceMismatch):
        sidecars.copy_tree(spark, str(tmp_path / "a"), str(tmp_path / "copy"))
    shapes = spark.createDataFrame([("craton",), (None,), ("basin",)], "kind string")
    assert [r.code for r in sidecars.code_table(shapes, "kind", {"craton": 1, "basin": 2}).collect()] == [1, None, 2]
    with pytest.raises(readers.SourceMismatch):
        sidecars.code_table(shapes, "kind", {"craton": 1})
    spark.range(5).withColumn("v", F.lit(1)).write.parquet(str(tmp_path / "s" / "tier=1deg" / "layer=q"))
    spark.range(5).write.parquet(str(tmp_path / "s" / "tier=6min" / "layer=q"))
    assert sidecars.array_stats(spark, str(tmp_path / "s")).first().layer == "q"
    good = lambda: spark.createDataFrame([("range", "pass", "")], "name string, status string, summary string")
    got = fidelity.run_groups({"one": good, "two": lambda: 1 / 0})
    assert [(x["name"], x["status"]) for x in got] == [("one: range", "pass"), ("two", "FAIL")]
    sample = lambda x: {r.id for r in merge.stratified(x, "k", "id", 5).collect()}
    df = spark.range(300).withColumn("k", F.col("id") % 3)
    assert len(sample(df)) == 15 and sample(df) == sample(df.repartition(7))


def test_noted_native_resolution(spark):
    """A note behind the number changes neither rule nor degrees."""
    make = lambda i, native, tiers: contract.Layer(i, "s", native, tiers[-1], tiers, "float32", "m", "none", "none")
    layers = (make("a", "0.05deg（two lattices, joined）", ("1deg", "3min")), make("b", "2 min (nodes)", ("1deg", "3min")), make("c", "vector-line（traces）", ("1deg", "30sec")), make("d", "0.05deg（x）", ("1deg", "30sec")), make("e", "about 1deg", ("1deg",)))
    got = {tuple(r) for r in contract.violations(contract.frame(spark, contract.Contract("1", "draft", layers))).collect()}
    assert got == {("d", "tier finer than the source"), ("e", "native resolution")}
    assert [contract.native_deg(x.native_res) for x in layers[:3]] == [contract.Fraction(1, 20), contract.Fraction(1, 30), None]


def test_rank_outside_its_bracket(spark, monkeypatch):
    """A bracket that misses its rank is an error, never a wrong value."""
    monkeypatch.setattr(stats, "ACCURACY", 100)
    df = spark.range(5000).select(F.col("id").cast("double").alias("v"))
    assert [r.value for r in stats.exact_quantiles(df, "v", [0.5]).collect()] == [2499.5]
    for wrong in (-5, -40):
        monkeypatch.setattr(stats, "BRACKET", wrong)
        with pytest.raises(Exception, match="outside its bracket"):
            stats.exact_quantiles(df, "v", [0.5]).collect()


def test_pole_by_winding(spark):
    ring = spark.createDataFrame([(1, [(0.0, 50.0), (120.0, 50.0), (240.0, 50.0), (360.0, 50.0)]), (-1, [(0.0, 50.0), (-120.0, 50.0), (-240.0, 50.0), (-360.0, 50.0)]), (0, [(0.0, 1.0), (1.0, 1.0), (1.0, 2.0), (0.0, 1.0)])], "w int, ring array<struct<x:double,y:double>>")
    got = {r.w: [p.y for p in r.p] for r in ring.select("w", geometry.close_pole(F.col("ring"), F.col("w")).alias("p")).collect()}
    assert got[1][4:6] == [90.0, 90.0] and got[-1][4:6] == [-90.0, -90.0] and len(got[0]) == 4

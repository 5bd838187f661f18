import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import grid, text
from tessera.operators import geometry, kernels, merge, stats, windows
from tessera.sources import contract, readers, store
from tessera.streaming.density import windowed_density


def cells(spark, block):
    return spark.createDataFrame([(r, c, v) for r, row in enumerate(block) for c, v in enumerate(row)], "r int, c int, v int")


def test_sphere_area(spark):
    total = grid.row_areas(spark, "1deg").agg(F.sum("area_km2") * 360).first()[0]
    assert math.isclose(total, 4 * math.pi * grid.RADIUS_KM**2, rel_tol=1e-9)


def test_cells_of_points(spark):
    df = spark.createDataFrame([(0.3, 0.7), (0.0, 238.327), (0.0, 180.0), (90.0, 0.0)], "lat double, lon double")
    got = [tuple(x) for x in df.select(grid.row_of(F.col("lat"), "1deg"), grid.col_of(F.col("lon"), "1deg")).collect()]
    assert got == [(90, 180), (90, 58), (90, 0), (179, 180)]
    with pytest.raises(ValueError):
        grid.factor("6min", "30min")


def test_block_mode_ties_and_nodata(spark):
    x = cells(spark, [[5, 2, 5, 5], [2, 5, 5, 2]])
    assert sorted((r.c, r.v) for r in kernels.block_mode(x, 2).collect()) == [(0, 2), (1, 5)]
    y = cells(spark, [[0, 1, 0, 1], [0, 1, 0, 1]])
    assert {r.v for r in kernels.block_mode(y, 2).collect()} == {0}
    assert {r.v for r in kernels.block_mode(y, 2, nodata=0).collect()} == {1}
    assert {r.v for r in kernels.block_mode(cells(spark, [[0, 0], [0, 0]]), 2, nodata=0).collect()} == {0}


def test_block_sum(spark):
    x = cells(spark, [[1, 2, 3, 4], [5, 6, 7, 8]]).withColumnRenamed("v", "n")
    assert sorted((r.c, r.n) for r in kernels.block_sum(x, 2).collect()) == [(0, 14), (1, 22)]


def test_axial_wrap(spark):
    df = spark.createDataFrame([(170.0,), (175.0,), (5.0,), (10.0,)], "t double")
    turned = df.agg(kernels.axial_mean(F.col("t") + 180, F.lit(1.0))).first()[0]
    assert math.isclose(turned, df.agg(kernels.axial_mean(F.col("t"), F.lit(1.0))).first()[0], abs_tol=1e-9)


def test_shallowest_ties(spark):
    z = spark.createDataFrame([("alu", 0, 0, 300.0), ("cal", 0, 0, 100.0), ("alu", 0, 1, 5.0), ("cal", 0, 1, 5.0), ("cal", 0, 2, None)], "zone string, r int, c int, dep double")
    assert sorted((x.c, x.zone, x.n_zones) for x in merge.shallowest(z).collect()) == [(0, "cal", 2), (1, "alu", 2)]


def test_segment_distance(spark):
    want = {(0.0, 12.0): 2, (10.0, 5.0): 10, (0.0, -175.0): 175, (0.0, 5.0): 0}
    df = spark.createDataFrame(list(want), "lat double, lon double")
    a, b = (geometry.unit_vector(F.lit(0.0), F.lit(x)) for x in (0.0, 10.0))
    for r in df.withColumn("d", geometry.segment_distance(geometry.unit_vector(F.col("lat"), F.col("lon")), a, b)).collect():
        assert math.isclose(r.d, math.radians(want[r.lat, r.lon]) * grid.RADIUS_KM, abs_tol=1e-6)


def test_dateline(spark):
    s = spark.createDataFrame([(1, 10.0, 170.0, 11.0, -170.0)], "id int, lat double, lon double, lat2 double, lon2 double")
    got = [tuple(x) for x in geometry.split_dateline(s).collect()]
    assert got == [(1, 0, 10.0, 170.0, 10.5, 180.0), (1, 1, 10.5, -180.0, 11.0, -170.0)]


def test_relief_spike_wraps(spark):
    g = spark.createDataFrame([(r, c, 9.0 if (r, c) == (3, 0) else 0.0) for r in range(6) for c in range(9)], "r int, c int, z double")
    assert {(x.r, x.c) for x in windows.relief(g, 9).where("relief = 9").collect()} == {(r, c) for r in (2, 3, 4) for c in (8, 0, 1)}


@pytest.mark.parametrize(("literal", "metres", "code"), [("0.75m", 0.75, 1), ("5ft", 1.524, 1), ("60 ft", 18.288, 3), ("n/a", None, 0), ("2.5-4.25", 3.375, 2), (">200m", 200.0, 4), ("300", 300.0, 5)])
def test_thickness(spark, literal, metres, code):
    m = text.thickness_m(F.lit(literal))
    got = spark.range(1).select(m.alias("m"), text.thickness_class(m).alias("c")).first()
    assert got.c == code and (got.m is None if metres is None else math.isclose(got.m, metres))


def test_pairs(spark):
    x = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(201)], "x double, y double")
    got = stats.pair_stats(x, "x", "y").first()
    assert (got.n, round(got.r, 9), round(got.slope, 9), round(got.intercept, 6)) == (201, 1, 2, 1)


CONTRACT = """
version: 1
status: draft
layers:
  - {id: a__x, source: s, native_res: 0.5 deg, home_tier: 30min, tiers: [1deg, 30min], dtype: float32, unit: m, resampling: mode, mask: validity, visibility: public}
  - {id: a__y, source: t, native_res: 30 min, home_tier: 6min, tiers: [1deg, 6min], dtype: int64, unit: m, resampling: none, mask: none}
"""


def test_contract_and_store(spark, tmp_path):
    (tmp_path / "c.yaml").write_text(CONTRACT)
    c = contract.load_contract(str(tmp_path / "c.yaml"))
    assert sorted(tuple(r) for r in contract.violations(contract.frame(spark, c)).collect()) == [("a__y", "tier finer than the source"), ("a__y", "unknown dtype")]
    out = str(tmp_path / "store")
    store.write_layer(grid.dense_grid(spark, "1deg").withColumn("v", (F.col("r") * 1.0).cast("float")), out, "a__x", "1deg")
    store.write_layer(grid.dense_grid(spark, "1deg").withColumn("v", F.lit(1.0).cast("float")), out, "a__y", "1deg")
    cover = [r.asDict() for r in store.coverage(store.read_store(spark, out)).collect()]
    store.write_manifest(store.manifest(c, cover), out)
    # tiers that were not built, and one finer than its source
    part = {"a__x coverage", "a__y coverage", "a__y finer than its source"}
    assert {r.name for r in store.checks(spark, out, c).collect() if r.status != "pass"} == {"a__x 1deg mask", *part}
    store.write_mask(spark, out, "a__x", "1deg")
    assert {r.name for r in store.checks(spark, out, c).collect() if r.status != "pass"} == part
    data = store.read_manifest(out)
    data["layers"][0] |= {"unit": "km", "tiers": ["1deg"]}
    failed = lambda d: {name for name, status, _ in store.manifest_checks(d, c) if status != "pass"} - part
    assert failed(data) == {"a__x fields"} and failed(data | {"layers": data["layers"][1:]}) == {"layers of the contract missing in the manifest"}
    assert failed(data | {"layers": [*data["layers"][1:] * 2, data["layers"][1] | {"id": "z"}], "crs": "?"}) == {"layers of the contract missing in the manifest", "layers of the manifest outside the contract", "layers twice in the manifest", "coordinates"}
    first = sorted(map(tuple, store.checksums(spark, out).collect()))
    store.write_layer(grid.dense_grid(spark, "1deg").repartition(3).withColumn("v", F.lit(1.0).cast("float")), out, "a__y", "1deg")
    assert first == sorted(map(tuple, store.checksums(spark, out).collect()))
    plan = store.strip_plan(contract.frame(spark, c), spark.createDataFrame([("s", "confirmed")], "source string, status string"))
    keep = [r.id for r in plan.collect() if r.keep]
    store.export_public(spark, out, keep, str(tmp_path / "public"))
    assert {x["id"] for x in store.read_manifest(str(tmp_path / "public"))["layers"]} == {"a__x"}
    assert {r.layer for r in store.read_store(spark, str(tmp_path / "public")).select("layer").distinct().collect()} == {"a__x", "a__x__validity"}
    with pytest.raises(ValueError):
        store.export_public(spark, out, keep, out + "/inner")


def test_ascii_grid(spark, tmp_path):
    (tmp_path / "g.asc").write_text("ncols 2\nnrows 2\nxllcorner -180\nyllcorner -90\ncellsize 1\nNODATA_value -9999\n1 2\n-9999 4\n")
    got = sorted(tuple(r) for r in readers.ascii_grid(spark, str(tmp_path / "g.asc")).collect())
    assert got == [(0, 0, None), (0, 1, 4.0), (1, 0, 1.0), (1, 1, 2.0)]


def test_reader_rejects(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 2 3\n4 5\n")
    with pytest.raises(readers.SourceMismatch):
        readers.fields(spark, str(tmp_path / "a.txt"), ["a", "b", "c"])
    seam = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (0, 2, 1.5)], "r int, c int, v double")
    with pytest.raises(readers.SourceMismatch):
        readers.drop_seam(seam, 2, 0.1)
    assert readers.drop_seam(seam, 2, 0.6).count() == 2


def test_stream_is_batch(spark, tmp_path):
    pts = spark.range(200).select((F.timestamp_seconds(F.col("id") * 3600)).alias("ts"), (F.col("id") % 90).cast("double").alias("lat"), (F.col("id") % 180).cast("double").alias("lon"))
    pts.write.parquet(str(tmp_path / "p"))
    stream = windowed_density(spark.readStream.schema(pts.schema).parquet(str(tmp_path / "p")))
    q = stream.writeStream.format("memory").queryName("density").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("density").collect())) == sorted(map(tuple, windowed_density(pts).collect()))

"""Chunked layers, states of tiles, and polygons cut to a window."""

import math

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import fidelity, geometry, polygons, states
from tessera.sources import chunks


def plan(spark, df):
    return df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def layer(spark, k=1):
    return spark.range(20000).select((F.col("id") * 7919 % 1800).cast("int").alias("r"), (F.col("id") * 104729 % 3600).cast("int").alias("c"), (F.col("id") % 97 * k).cast("double").alias("v")).dropDuplicates(["r", "c"])


def test_chunk_numbers():
    assert chunks.chunks_of_box("6min", -90, 90, -180, 180) == list(range(8)) and chunks.chunks_of_box("1deg", 1, 2, 3, 4) == [0]
    assert chunks.chunks_of_box("6min", 5, 10, 10, 20) == [6] and chunks.chunks_of_box("6min", -5, 5, 170, -170) == [0, 3, 4, 7]


def test_stored_layers(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    a = chunks.write_chunks(layer(spark), "chunks_a", "6min", str(tmp_path / "a"))
    chunks.write_chunks(layer(spark), "chunks_b", "6min", str(tmp_path / "b"))
    spark.sql("DROP TABLE chunks_b")
    b = chunks.attach(spark, "chunks_b", str(tmp_path / "b"))
    # cells of two stored layers meet without a shuffle; what is left is one row's aggregate
    joined = a.join(b.withColumnRenamed("v", "w"), ["r", "c"], "full")
    assert "Exchange" not in plan(spark, joined) and joined.where("not (v <=> w)").count() == 0
    assert "hashpartitioning" not in plan(spark, fidelity.same_cells(a, b, "same")) and fidelity.same_cells(a, b, "same").first().status == "pass"
    box = chunks.in_box(a, "6min", 0.0, 20.0, 91.0, 120.0)
    assert "PartitionFilters: [isnotnull(chunk" in plan(spark, box) or "PartitionFilters: [(chunk" in plan(spark, box) or "PartitionFilters: [chunk" in plan(spark, box)
    assert {x.chunk for x in box.select("chunk").distinct().collect()} == {7} and box.count() == layer(spark).where("r between 900 and 1099 and c between 2710 and 2999").count()
    values = chunks.chunk_values(a)
    assert {x.chunk for x in values.collect()} == set(range(8)) and values.agg(F.sum("n")).first()[0] == layer(spark).count()
    assert chunks.in_range(a, values, 5.0, 7.0).count() == layer(spark).where("v between 5 and 7").count() and chunks.in_range(a, values, 1000.0, 2000.0).count() == 0
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_states(spark):
    """Refreshed states are those of a full count; only changed tiles are counted; merges are exact."""
    rng = np.random.default_rng(0)
    cell = lambda rows: spark.createDataFrame(rows, "r int, c int, v double")
    rows = [(r, c, float(rng.normal())) for r in range(24) for c in range(24)] + [(30, 30, None), (30, 31, float("nan"))]
    now = [(r, c, v if not (r < 8 and c < 8) else (v or 0) + 1) for r, c, v in rows if r != 23] + [(40, 40, 0.1)]
    args = (8, -2.0, 0.5, 8)
    before = states.tile_states(cell(rows), *args)
    assert {tuple(x) for x in states.changed_tiles(before, cell(now), 8).collect()} == {(0, 0), (2, 0), (2, 1), (2, 2), (5, 5)}
    got, full = (sorted(map(str, x.collect())) for x in (states.refreshed(before, cell(now), *args), states.tile_states(cell(now), *args)))
    assert got == full and states.changed_tiles(before, cell(rows[::-1]), 8).count() == 0
    whole = states.merged(before).first()
    some = [v for _, _, v in rows if v is not None and v == v]
    assert whole.n == len(some) and math.isclose(whole.total, sum(some), abs_tol=1e-6) and whole.most == max(some)
    assert {x.bin: x.n for x in states.merged_histogram(before).collect()} == dict(zip(*np.unique(np.clip(np.floor((np.array(some) + 2) / 0.5), 0, 7).astype(int), return_counts=True)))


def test_window_tiling(spark):
    """A closed tiling of the globe, of caps round both poles and cells across the dateline, fills the window of 64800 square degrees."""
    cap = lambda y, step: [(x, y) for x in range(0, 360 * step + step, 30 * step)]
    rows = [(0, 1, cap(60.0, 1)), (1, -1, cap(-60.0, -1))]
    rows += [(2 + k, 0, [(a, -60.0), (a + 40, -60.0), (a + 40 + 7, 0.0), (a + 40, 60.0), (a, 60.0), (a + 7, 0.0), (a, -60.0)]) for k, a in enumerate(range(-200, 160, 40))]
    df = spark.createDataFrame([(i, w, [(float(x), float(y)) for x, y in p]) for i, w, p in rows], "fid int, w int, ring array<struct<x:double,y:double>>")
    closed = df.withColumn("ring", geometry.close_pole(F.col("ring"), F.col("w")))
    parts = polygons.clipped(geometry.turned_copies(closed))
    got = parts.select("fid", polygons.plane_area(F.col("ring")).alias("a"), F.expr("array_max(ring.x) <= 180 and array_min(ring.x) >= -180").alias("held")).collect()
    assert math.isclose(sum(abs(x.a) for x in got), 64800, rel_tol=1e-12) and all(x.held for x in got)
    assert math.isclose(sum(abs(x.a) for x in got if x.fid == 0), 360 * 30) and {x.fid for x in got} == set(range(11))
    lone = spark.createDataFrame([(0, [(200.0, 0.0), (210.0, 0.0), (210.0, 10.0)])], "fid int, ring array<struct<x:double,y:double>>")
    assert polygons.clipped(lone).count() == 0

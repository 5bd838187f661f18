"""Binary grids by byte ranges against whole-file readers, and text grids read in splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.sources import binary, readers, strips, tables
from tessera.sources.readers import SourceMismatch
from test_binary import classic, tiff


def cells(df):
    return sorted((x.file.split("/")[-1], x.k, x.r, x.c, x.v) for x in df.collect())


def test_netcdf_strips(spark, tmp_path):
    values = np.arange(3 * 40 * 25).reshape(3, 40, 25) % 3001
    values[1, 2, 3] = -1
    for name in "ab":
        (tmp_path / f"{name}.nc").write_bytes(classic(2 if name == "a" else 1, values + (name == "b") * (values >= 0), [1.0, 2.0, 3.0]))
    whole = binary.netcdf_grid(spark, str(tmp_path), "vs")
    got = strips.grid_strips(spark, str(tmp_path), "vs", strip_bytes=25 * 2 * 7)
    assert got.rdd.getNumPartitions() == 2 * 3 * 6 and cells(got) == cells(whole)
    part = strips.grid_strips(spark, str(tmp_path), "vs", slabs=(1, 2), rows=(5, 12), columns=(3, 20), strip_bytes=25 * 2 * 7)
    assert part.rdd.getNumPartitions() == 2 and cells(part) == cells(whole.where("k = 1 and r between 5 and 11 and c between 3 and 19"))
    uri = strips.grid_strips(spark, f"file://{tmp_path}/a.nc", "vs")
    assert uri.count() == values.size and uri.rdd.getNumPartitions() == 3
    with pytest.raises(Exception, match="no variable"):
        strips.grid_strips(spark, str(tmp_path), "vp").count()
    with pytest.raises(Exception, match="no such file"):
        strips.grid_strips(spark, str(tmp_path / "none"), "vs").count()


@pytest.mark.parametrize("kind", [{"rows": 3}, {"order": ">", "rows": 1}, {"how": 8, "predictor": 2, "rows": 4}, {"tile": 16}, {"how": 8, "predictor": 3, "tile": 8}])
def test_tiff_strips(spark, tmp_path, kind):
    values = (np.arange(50 * 37).reshape(50, 37) * 37) % 101 - 50
    values[3, 4] = -99
    (tmp_path / "x.tif").write_bytes(tiff(values, **kind))
    whole = binary.geotiff(spark, str(tmp_path))
    got = strips.grid_strips(spark, str(tmp_path), strip_bytes=150)
    assert got.rdd.getNumPartitions() >= 4 and cells(got) == cells(whole)
    part = strips.grid_strips(spark, str(tmp_path), rows=(10, 21), columns=(5, 30), strip_bytes=150)
    assert part.rdd.getNumPartitions() < got.rdd.getNumPartitions() and cells(part) == cells(whole.where("r between 10 and 20 and c between 5 and 29"))


def test_a_task_reads_its_own_bytes(tmp_path):
    """The header once, then no more than the strip."""
    values = np.arange(1 * 4000 * 100).reshape(1, 4000, 100) % 3001
    (tmp_path / "a.nc").write_bytes(classic(2, values, [1.0]))
    reader = strips.GridReader({"path": str(tmp_path / "a.nc"), "variable": "vs", "stripbytes": "20000"})
    parts, seen = reader.partitions(), []
    assert len(parts) == 40

    class Counted(strips.Ranges):
        def __init__(self, path):
            super().__init__(path)
            seen.append(self)

    strips.Ranges, plain = Counted, strips.Ranges
    try:
        n = sum(b.num_rows for p in parts for b in reader.read(p))
    finally:
        strips.Ranges = plain
    assert n == values.size and max(x.read for x in seen) <= 20000


@pytest.fixture
def split(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_text_grids_in_splits(spark, split, tmp_path):
    values = np.arange(30 * 12).reshape(30, 12) % 97
    head = "ncols 12\nnrows 30\nxllcorner -180\nyllcorner -90\ncellsize 1\nNODATA_value 5\n"
    (tmp_path / "g.asc").write_text(head + "\n".join(" ".join(map(str, row)) for row in values) + "\n\n")
    got = {(x.r, x.c): x.v for x in readers.ascii_grid(spark, str(tmp_path / "g.asc")).collect()}
    assert got == {(29 - i, j): None if v == 5 else float(v) for (i, j), v in np.ndenumerate(values)}
    ring = np.concatenate([values, values[:, :1]], axis=1)
    flat = ring.ravel().tolist()
    (tmp_path / "i.txt").write_text("one\ntwo\n" + "".join(" ".join(map(str, flat[i : i + 7])) + "\r\n" for i in range(0, len(flat), 7)))
    got = {(x.r, x.c): x.v for x in tables.integer_grid(spark, str(tmp_path / "i.txt"), 30, 13).collect()}
    assert got == {(29 - i, j): v for (i, j), v in np.ndenumerate(values)}
    with pytest.raises(SourceMismatch, match="size"):
        tables.integer_grid(spark, str(tmp_path / "i.txt"), 31, 13)


def test_delimited_lines_in_splits(spark, split, tmp_path):
    lines = {k: [(k + i * 0.5, -k + i * 0.25) for i in range(1, 2 + k * 9 % 40)] for k in range(30)}
    (tmp_path / "d.dig").write_text("".join(f"title {k}\n" + "".join(f"  {x:+.5E},{y:+.5E}\n" for x, y in p) + "*** end of line segment ***\n" for k, p in lines.items()))
    got = readers.delimited_lines(spark, str(tmp_path / "d.dig"))
    assert sorted((x.line, x.title, x.seq, x.x, x.y) for x in got.collect()) == [(k, f"title {k}", i, float(f"{x:.5E}"), float(f"{y:.5E}")) for k, p in lines.items() for i, (x, y) in enumerate(p)]
    assert got.agg(F.count_distinct("line")).first()[0] == 30

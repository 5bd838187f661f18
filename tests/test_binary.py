"""Binary readers on files written by hand."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.sources import binary
from tessera.sources.readers import SourceMismatch


def text(s):
    raw = s.encode()
    return struct.pack(">i", len(raw)) + raw + b"\0" * (-len(raw) % 4)


def classic(version, values, depth):
    """A file with dims (depth, lat, lon), an axis and a packed variable with a hole."""
    offset = ">i" if version == 1 else ">q"
    n, m = values.shape[1:]
    fill = text("_FillValue") + struct.pack(">ii", 3, 1) + struct.pack(">hxx", -1)
    scale = text("scale_factor") + struct.pack(">iid", 6, 1, 0.5)
    head = b"CDF" + bytes([version]) + struct.pack(">i", 0)
    head += struct.pack(">ii", 10, 3) + text("depth") + struct.pack(">i", len(depth)) + text("lat") + struct.pack(">i", n) + text("lon") + struct.pack(">i", m)
    head += struct.pack(">ii", 0, 0)
    axis = text("depth") + struct.pack(">ii", 1, 0) + struct.pack(">ii", 0, 0) + struct.pack(">ii", 6, 8 * len(depth))
    grid = text("vs") + struct.pack(">iiii", 3, 0, 1, 2) + struct.pack(">ii", 12, 2) + fill + scale + struct.pack(">ii", 3, values.size * 2)
    size = len(head) + 8 + len(axis) + len(grid) + 2 * struct.calcsize(offset)
    head += struct.pack(">ii", 11, 2) + axis + struct.pack(offset, size) + grid + struct.pack(offset, size + 8 * len(depth))
    return head + np.array(depth, ">f8").tobytes() + values.astype(">i2").tobytes()


@pytest.mark.parametrize("version", [1, 2])
def test_netcdf(spark, tmp_path, version):
    values = np.arange(2 * 3 * 4).reshape(2, 3, 4)
    values[1, 2, 3] = -1
    (tmp_path / "a.nc").write_bytes(classic(version, values, [100.0, 250.0]))
    got = {(x.k, x.r, x.c): x.v for x in binary.netcdf_grid(spark, str(tmp_path), "vs").collect()}
    assert len(got) == 24 and got[1, 2, 3] is None
    assert all(v == values[at] * 0.5 for at, v in got.items() if v is not None)
    assert [x.x for x in binary.netcdf_axis(spark, str(tmp_path), "depth").orderBy("i").collect()] == [100.0, 250.0]
    (tmp_path / "b.nc").write_bytes(b"HDF no netCDF")
    with pytest.raises(Exception, match="not a classic netCDF"):
        binary.netcdf_grid(spark, str(tmp_path), "vs").count()


def lzw_codes(raw):
    """Clear, every byte as itself with a clear before the width changes, end."""
    codes = []
    for i, b in enumerate(raw):
        if i % 200 == 0:
            codes.append(256)
        codes.append(b)
    bits = "".join(f"{c:09b}" for c in [*codes, 257])
    bits += "0" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big")


def tiff(values, order="<", how=1, tile=None, predictor=1, rows=2):
    pack = {1: bytes, 8: zlib.compress, 5: lzw_codes}[how]
    v = values.astype(order + "f4") if predictor == 3 else values.astype(order + "i2")
    h, w = v.shape
    if tile:
        padded = np.zeros((-(-h // tile) * tile, -(-w // tile) * tile), v.dtype)
        padded[:h, :w] = v
        parts = [padded[i : i + tile, j : j + tile] for i in range(0, h, tile) for j in range(0, w, tile)]
    else:
        parts = [v[i : i + rows] for i in range(0, h, rows)]
    done = []
    for p in parts:
        if predictor == 2:
            p = np.concatenate([p[:, :1], np.diff(p, axis=1)], axis=1).astype(v.dtype)
        raw = np.ascontiguousarray(p).tobytes()
        if predictor == 3:
            planes = np.ascontiguousarray(p.astype(">f4")).view(np.uint8).reshape(p.shape[0], -1, 4).transpose(0, 2, 1).reshape(p.shape[0], -1)
            raw = np.concatenate([planes[:, :1], np.diff(planes, axis=1)], axis=1).tobytes()
        done.append(pack(raw))
    tags = [(256, 3, [w]), (257, 3, [h]), (258, 3, [v.dtype.itemsize * 8]), (259, 3, [how]), (277, 3, [1]), (317, 3, [predictor]), (339, 3, [3 if predictor == 3 else 2])]
    at, places = 8, []
    for d in done:
        places.append(at)
        at += len(d)
    sizes = [len(d) for d in done]
    tags += [(322, 3, [tile]), (323, 3, [tile]), (324, 4, places), (325, 4, sizes)] if tile else [(273, 4, places), (278, 3, [rows]), (279, 4, sizes)]
    tags += [(33550, 12, [0.5, 0.25, 0.0]), (33922, 12, [0, 0, 0, -180.0, 90.0, 0.0]), (42113, 2, b"-99\0")]
    extra, entries, base = b"", b"", at + 2 + 12 * len(tags) + 4
    for tag, kind, x in sorted(tags, key=lambda t: t[0]):
        raw = x if kind == 2 else struct.pack(order + {3: "H", 4: "I", 12: "d"}[kind] * len(x), *x)
        if len(raw) > 4:
            place = struct.pack(order + "I", base + len(extra))
            extra += raw
        else:
            place = raw.ljust(4, b"\0")
        entries += struct.pack(order + "HHI", tag, kind, len(x)) + place
    return (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, at) + b"".join(done) + struct.pack(order + "H", len(tags)) + entries + b"\0\0\0\0" + extra


@pytest.mark.parametrize("kind", [{}, {"order": ">"}, {"how": 8, "predictor": 2}, {"how": 5}, {"tile": 4}, {"how": 8, "predictor": 3}, {"how": 8, "predictor": 2, "tile": 4, "order": ">"}])
def test_tiff_blocks(kind):
    values = (np.arange(5 * 7).reshape(5, 7) * 37) % 101 - 50
    values[3, 4] = -99
    file, got = binary.Tiff(tiff(values, **kind)), np.zeros((5, 7))
    for r, c, v in file.blocks():
        got[r : r + v.shape[0], c : c + v.shape[1]] = v
    assert file.corner() == (-180.0, 90.0, 0.5, 0.25)
    assert np.isnan(got[3, 4]) and np.array_equal(np.where(np.isnan(got), -99, got), values)


def test_lzw_with_its_table():
    # -----A---A of the format's own example: 45, 258 (the code being made), 258, 65, 259, 66
    codes = [256, 45, 258, 258, 65, 259, 66, 257]
    bits = "".join(f"{c:09b}" for c in codes)
    raw = int(bits + "0" * (-len(bits) % 8), 2).to_bytes(-(-len(bits) // 8), "big")
    assert binary.lzw(raw) == b"-" + b"--" + b"--" + b"A" + b"---" + b"B"


def test_geotiff(spark, tmp_path):
    values = np.arange(12).reshape(3, 4)
    (tmp_path / "t.tif").write_bytes(tiff(values))
    got = {(x.r, x.c): x.v for x in binary.geotiff(spark, str(tmp_path)).collect()}
    assert got == {(r, c): float(values[r, c]) for r in range(3) for c in range(4)}
    frame = binary.geotiff_frames(spark, str(tmp_path)).first()
    assert (frame.nlat, frame.nlon, frame.west, frame.north, frame.dx, frame.dy) == (3, 4, -180.0, 90.0, 0.5, 0.25)


def shp(shapes):
    body = b""
    for i, (kind, parts) in enumerate(shapes):
        if kind == 0:
            raw = struct.pack("<i", 0)
        else:
            points = [p for part in parts for p in part]
            starts = np.cumsum([0] + [len(p) for p in parts])[:-1]
            raw = struct.pack("<i4d2i", kind, 0, 0, 0, 0, len(parts), len(points)) + struct.pack(f"<{len(parts)}i", *starts) + b"".join(struct.pack("<dd", *p) for p in points)
        body += struct.pack(">ii", i + 1, len(raw) // 2) + raw
    return b"\0" * 100 + body


def dbf(names):
    head = struct.pack("<B3xIHH20x", 3, len(names), 32 + 32 + 1, 1 + 6) + b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([6, 0]) + b"\0" * 14 + b"\r"
    return head + b"".join(b" " + n.encode().ljust(6) for n in names)


def test_shapefile(spark, tmp_path):
    square = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]
    hole = [(0.2, 0.2), (0.4, 0.2), (0.4, 0.4), (0.2, 0.2)]
    (tmp_path / "p.shp").write_bytes(shp([(5, [square, hole]), (0, []), (15, [square])]))
    (tmp_path / "p.dbf").write_bytes(dbf(["alpha", "", "gamma"]))
    got = binary.shapefile(spark, str(tmp_path)).orderBy("fid").collect()
    assert [[[tuple(p) for p in ring] for ring in x.rings] for x in got] == [[square, hole], [], [square]]
    assert [(x.kind, x.attrs["NAME"]) for x in got] == [(5, "alpha"), (0, None), (5, "gamma")]
    assert binary.require_safe_rings(binary.shapefile(spark, str(tmp_path))).count() == 3


def test_edges_over_the_dateline(spark):
    kind = "file string, fid long, rings array<array<struct<x:double,y:double>>>"
    pole = spark.createDataFrame([("a", 1, [[(-180.0, -90.0), (180.0, -90.0), (180.0, -80.0)]])], kind)
    assert binary.require_safe_rings(pole).count() == 1
    wide = spark.createDataFrame([("a", 2, [[(-170.0, 10.0), (170.0, 10.0)]])], kind)
    with pytest.raises(SourceMismatch):
        binary.require_safe_rings(wide)

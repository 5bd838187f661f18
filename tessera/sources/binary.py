"""Binary sources without reader libraries: classic netCDF, GeoTIFF and shapefiles.

A file is a row of Spark's ``binaryFile`` source (2 GB at most) and is parsed where
it is read, a block of cells at a time; many tiles or slices are many tasks.
"""

from __future__ import annotations

import math
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.readers import SourceMismatch

#: Cells of one batch that a reader hands to Spark.
BATCH_CELLS = 1 << 18
_CELLS = pa.schema([("file", pa.string()), ("k", pa.int32()), ("r", pa.int32()), ("c", pa.int32()), ("v", pa.float64())])
_CELLS_SQL = "file string, k int, r int, c int, v double"
# fixed values: netCDF's external types, TIFF's field types and tags, as their specifications number them
_NC_TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
_TIFF_TYPES = {1: "u1", 2: "S1", 3: "u2", 4: "u4", 5: "u8", 6: "i1", 7: "u1", 8: "i2", 9: "i4", 11: "f4", 12: "f8", 13: "u4", 16: "u8", 17: "i8"}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, STRIP_ROWS, STRIP_SIZES = 256, 257, 258, 259, 273, 277, 278, 279
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_SIZES, FORMAT, PIXEL_SCALE, TIE_POINT, NODATA = 317, 322, 323, 324, 325, 339, 33550, 33922, 42113


def _batches(file: str, k: int, r: np.ndarray, c: np.ndarray, v: np.ndarray):
    for i in range(0, len(v), BATCH_CELLS):
        part = v[i : i + BATCH_CELLS].astype(np.float64)
        n = len(part)
        yield pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array(np.full(n, k, np.int32)), pa.array(r[i : i + n].astype(np.int32)), pa.array(c[i : i + n].astype(np.int32)), pa.array(part, mask=np.isnan(part))], schema=_CELLS)


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    # one file a task: neighbouring small files would otherwise share one, and a large one is read whole anyhow
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return found.select("path", "content")


class Netcdf:
    """Header of a classic netCDF file (CDF 1, 2 or 5): dims {name: length}, attrs, vars {name: (dims, attrs, dtype, begin, is_record)}."""

    def __init__(self, raw: bytes):
        if raw[:3] != b"CDF" or raw[3:4] not in (b"\1", b"\2", b"\5"):
            raise SourceMismatch("not a classic netCDF file")
        self.raw, self.at = raw, 4
        self.wide, self.far = raw[3:4] == b"\5", raw[3:4] != b"\1"
        self.records = self._size()
        listed = self._list(lambda: (self._name(), self._size()))
        self.dims = {name: n for name, n in listed}
        self.attrs = dict(self._list(self._attr))
        self.vars = dict(self._list(lambda: self._var([name for name, _ in listed])))
        record = [self._bytes(x) for x in self.vars.values() if x[4]]
        # a lone record variable is not padded between its records
        self.stride = record[0] if len(record) == 1 else sum(-(-n // 4) * 4 for n in record)

    def _size(self) -> int:
        kind, n = (">q", 8) if self.wide else (">i", 4)
        self.at += n
        return struct.unpack(kind, self.raw[self.at - n : self.at])[0]

    def _tag(self) -> int:
        self.at += 4
        return struct.unpack(">i", self.raw[self.at - 4 : self.at])[0]

    def _name(self) -> str:
        n = self._size()
        self.at += -(-n // 4) * 4
        start = self.at - -(-n // 4) * 4
        return self.raw[start : start + n].decode()

    def _list(self, entry) -> list:
        self._tag()
        return [entry() for _ in range(self._size())]

    def _attr(self):
        name, kind, n = self._name(), np.dtype(_NC_TYPES[self._tag()]), self._size()
        start, size = self.at, n * kind.itemsize
        self.at += -(-size // 4) * 4
        if kind.kind == "S":
            return name, self.raw[start : start + size].decode(errors="replace").rstrip("\0")
        return name, np.frombuffer(self.raw[start : start + size], kind)

    def _var(self, names: list[str]):
        name = self._name()
        dims = [names[self._size()] for _ in range(self._size())]
        attrs, kind = dict(self._list(self._attr)), np.dtype(_NC_TYPES[self._tag()])
        self._size()
        self.at += 8 if self.far else 4
        begin = struct.unpack(">q" if self.far else ">i", self.raw[self.at - (8 if self.far else 4) : self.at])[0]
        return name, (dims, attrs, kind, begin, bool(dims) and self.dims[dims[0]] == 0)

    def _bytes(self, var) -> int:
        dims, _, kind, _, record = var
        return math.prod(self.dims[d] for d in dims[record:]) * kind.itemsize

    def shape(self, name: str) -> tuple[int, ...]:
        dims, _, _, _, record = self.vars[name]
        return tuple(self.records if record and i == 0 else self.dims[d] for i, d in enumerate(dims))

    def slab(self, name: str, k: int) -> np.ndarray:
        """Values of the k-th slab (all but the last two dimensions flattened) as doubles: holes NaN, packing undone."""
        dims, attrs, kind, begin, record = self.vars[name]
        shape = self.shape(name)
        inner = shape[-2:] if len(shape) >= 2 else shape
        n = math.prod(inner)
        if record and len(shape) <= 2:
            each = math.prod(shape[1:])
            v = np.concatenate([np.frombuffer(self.raw, kind, each, begin + i * self.stride) for i in range(shape[0])] or [np.zeros(0, kind)])
        elif record:
            a, b = divmod(k, math.prod(shape[1:-2]))
            v = np.frombuffer(self.raw, kind, n, begin + a * self.stride + b * n * kind.itemsize)
        else:
            v = np.frombuffer(self.raw, kind, n, begin + k * n * kind.itemsize)
        return unpacked(v, attrs)


def unpacked(v: np.ndarray, attrs: dict) -> np.ndarray:
    """Stored numbers as doubles: holes NaN, scale and offset applied."""
    out = v.astype(np.float64)
    for hole in ("_FillValue", "missing_value"):
        if hole in attrs:
            out[v == attrs[hole][0]] = np.nan
    return out * float(attrs.get("scale_factor", [1.0])[0]) + float(attrs.get("add_offset", [0.0])[0])


def netcdf_grid(spark: SparkSession, path: str, variable: str, glob: str = "*.nc") -> DataFrame:
    """(file, k, r, c, v) of a variable whose last dimensions are rows and columns, in the file's order; k counts the slabs before them."""

    def run(batches):
        for batch in batches:
            for file, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                nc = Netcdf(raw.as_py())
                if variable not in nc.vars:
                    raise SourceMismatch(f"{file}: no variable {variable}")
                shape = nc.shape(variable)
                if len(shape) < 2:
                    raise SourceMismatch(f"{file}: {variable} is no grid")
                r, c = np.divmod(np.arange(shape[-2] * shape[-1]), shape[-1])
                for k in range(math.prod(shape[:-2])):
                    yield from _batches(file, k, r, c, nc.slab(variable, k))

    return _files(spark, path, glob).mapInArrow(run, _CELLS_SQL)


def netcdf_axis(spark: SparkSession, path: str, variable: str, glob: str = "*.nc") -> DataFrame:
    """(file, i, x) of a one-dimensional variable."""

    def run(batches):
        for batch in batches:
            for file, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = Netcdf(raw.as_py()).slab(variable, 0)
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(x)), pa.array(np.arange(len(x), dtype=np.int32)), pa.array(x)], names=["file", "i", "x"])

    return _files(spark, path, glob).mapInArrow(run, "file string, i int, x double")


def lzw(raw: bytes) -> bytes:
    """TIFF's LZW: codes from the high bit, 9 to 12 bits wide, one code early."""
    out, table, width, bits, held, last = bytearray(), [], 9, 0, 0, None
    for byte in raw:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & ((1 << width) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, None
            continue
        word = table[code] if code < len(table) else last + last[:1]
        if last is not None:
            table.append(last + word[:1])
        out += word
        last = word
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return bytes(out)


class Tiff:
    """First directory of a TIFF or BigTIFF with one sample a pixel; tags {number: values}."""

    def __init__(self, raw: bytes):
        self.raw = raw
        self.order = {b"II": "<", b"MM": ">"}.get(raw[:2])
        take = lambda form, at: struct.unpack(self.order + form, raw[at : at + struct.calcsize(self.order + form)])
        if not self.order or take("H", 2)[0] not in (42, 43):
            raise SourceMismatch("not a TIFF file")
        big = take("H", 2)[0] == 43
        number, far, entry, inline = ("Q", 8, 20, 8) if big else ("H", 4, 12, 4)
        at = take("Q" if big else "I", 8 if big else 4)[0]
        count = take(number, at)[0]
        at += struct.calcsize(number)
        self.tags = {}
        for i in range(count):
            here = at + i * entry
            tag, kind, n = take("HHQ" if big else "HHI", here)
            if kind not in _TIFF_TYPES:
                continue
            dtype = np.dtype(_TIFF_TYPES[kind]).newbyteorder(self.order)
            place = here + entry - far
            if n * dtype.itemsize > inline:
                place = take("Q" if big else "I", place)[0]
            self.tags[tag] = np.frombuffer(raw[place : place + n * dtype.itemsize], dtype)
        if self.one(SAMPLES, 1) != 1:
            raise SourceMismatch("more than one sample a pixel")
        kind = {1: "u", 2: "i", 3: "f"}[self.one(FORMAT, 1)]
        self.dtype = np.dtype(f"{self.order}{kind}{self.one(BITS, 1) // 8}")
        text = b"".join(self.tags[NODATA]).rstrip(b"\0 ") if NODATA in self.tags else b""
        self.nodata = float(text) if text else None

    def one(self, tag: int, default: int | None = None) -> int:
        return int(self.tags[tag][0]) if tag in self.tags else default

    @property
    def shape(self) -> tuple[int, int]:
        return self.one(HEIGHT), self.one(WIDTH)

    def corner(self) -> tuple[float, float, float, float] | None:
        """(west, north, width and height of a pixel) in the file's coordinates."""
        if PIXEL_SCALE not in self.tags or TIE_POINT not in self.tags:
            return None
        (sx, sy), (i, j, _, x, y) = self.tags[PIXEL_SCALE][:2], self.tags[TIE_POINT][:5]
        return float(x - i * sx), float(y + j * sy), float(sx), float(sy)

    def _decoded(self, place: int, size: int) -> bytes:
        raw, how = self.raw[place : place + size], self.one(COMPRESSION, 1)
        if how == 1:
            return raw
        if how in (8, 32946):
            return zlib.decompress(raw)
        if how == 5:
            return lzw(raw)
        raise SourceMismatch(f"compression {how}")

    @property
    def layout(self) -> tuple[int, int, int]:
        """(rows, columns) of a strip or tile, and how many stand side by side."""
        height, width = self.shape
        wide, high = (self.one(TILE_WIDTH), self.one(TILE_HEIGHT)) if TILES in self.tags else (width, min(height, self.one(STRIP_ROWS, height)))
        return high, wide, -(-width // wide)

    def places(self) -> list[tuple[int, int]]:
        """(offset, bytes) of each strip or tile."""
        return list(zip(*(self.tags[t].tolist() for t in ((TILES, TILE_SIZES) if TILES in self.tags else (STRIPS, STRIP_SIZES)))))

    def blocks(self, some: range | None = None):
        """(row, column, values) of each strip or tile (or those of ``some`` numbers), cut to the image; nodata becomes NaN."""
        height, width = self.shape
        tiled = TILES in self.tags
        high, wide, across = self.layout
        places = self.places()
        for i in range(len(places)) if some is None else some:
            place, size = places[i]
            r, c = i // across * high, i % across * wide
            rows = high if tiled else min(high, height - r)
            raw = self._decoded(place, size)[: rows * wide * self.dtype.itemsize]
            how = self.one(PREDICTOR, 1)
            if how == 3:
                # rows hold all high bytes first, each byte the difference to the one before
                flat = np.cumsum(np.frombuffer(raw, np.uint8).reshape(rows, -1), axis=1, dtype=np.uint8)
                v = np.ascontiguousarray(flat.reshape(rows, self.dtype.itemsize, wide).transpose(0, 2, 1)).view(self.dtype.newbyteorder(">")).reshape(rows, wide)
            else:
                v = np.frombuffer(raw, self.dtype).reshape(rows, wide)
                if how == 2:
                    v = np.cumsum(v, axis=1, dtype=self.dtype.newbyteorder("="))
            out = v[: height - r, : width - c].astype(np.float64)
            if self.nodata is not None:
                # as the samples hold it: a float nodata is rounded like them, an integer type may not have it at all
                out[out == (float(self.dtype.type(self.nodata)) if self.dtype.kind == "f" else self.nodata)] = np.nan
            yield r, c, out


def geotiff(spark: SparkSession, path: str, glob: str = "*.tif*") -> DataFrame:
    """(file, k = 0, r, c, v) of one-band files, north first as stored; uncompressed, deflate or LZW, strips or tiles."""

    def run(batches):
        for batch in batches:
            for file, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                for r, c, v in Tiff(raw.as_py()).blocks():
                    i, j = np.divmod(np.arange(v.size), v.shape[1])
                    yield from _batches(file, 0, r + i, c + j, v.ravel())

    return _files(spark, path, glob).mapInArrow(run, _CELLS_SQL)


def geotiff_frames(spark: SparkSession, path: str, glob: str = "*.tif*") -> DataFrame:
    """(file, nlat, nlon, west, north, dx, dy) of each file."""

    def run(batches):
        for batch in batches:
            rows = []
            for file, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                tiff = Tiff(raw.as_py())
                rows.append((file, *tiff.shape, *(tiff.corner() or (None,) * 4)))
            kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.float64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["file", "nlat", "nlon", "west", "north", "dx", "dy"])

    return _files(spark, path, glob).mapInArrow(run, "file string, nlat int, nlon int, west double, north double, dx double, dy double")


def _shapes(raw: bytes):
    """(record, kind, parts) of a .shp file; a part is an (n, 2) array, a null shape has none."""
    at = 100
    while at + 12 <= len(raw):
        number, words = struct.unpack_from(">ii", raw, at)
        kind = struct.unpack_from("<i", raw, at + 8)[0]
        body, plain = at + 12, kind % 10
        if plain == 1:
            parts = [np.frombuffer(raw, "<f8", 2, body).reshape(1, 2)]
        elif plain == 8:
            n = struct.unpack_from("<i", raw, body + 32)[0]
            parts = [np.frombuffer(raw, "<f8", 2 * n, body + 36).reshape(n, 2)]
        elif plain in (3, 5):
            m, n = struct.unpack_from("<ii", raw, body + 32)
            cuts = [*struct.unpack_from(f"<{m}i", raw, body + 40), n]
            points = np.frombuffer(raw, "<f8", 2 * n, body + 40 + 4 * m).reshape(n, 2)
            parts = [points[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        else:
            parts = []
        yield number - 1, plain, parts
        at += 8 + 2 * words


def _records(raw: bytes, encoding: str):
    """Rows of a .dbf file as {field: text}; blanks become None."""
    n, start, size = struct.unpack_from("<IHH", raw, 4)
    fields, at = [], 32
    while at < start - 1 and raw[at] != 0x0D:
        fields.append((raw[at : at + 11].split(b"\0")[0].decode(encoding), raw[at + 16]))
        at += 32
    for i in range(n):
        here, row = start + i * size + 1, {}
        for name, width in fields:
            row[name] = raw[here : here + width].decode(encoding, "replace").strip(" \0") or None
            here += width
        yield row


def shapefile(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """(file, fid, kind, rings, attrs) of the .shp files in a folder with the .dbf rows beside them; kind 1 points, 3 lines, 5 polygons, 0 null."""
    shape = "file string, fid long, kind int, rings array<array<struct<x:double,y:double>>>"
    point = pa.struct([("x", pa.float64()), ("y", pa.float64())])

    def stem(p: str) -> str:
        return re.sub(r"\.[^.]*$", "", p)

    def shapes(batches):
        for batch in batches:
            for file, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                held: list = []
                for fid, kind, parts in _shapes(raw.as_py()):
                    held.append((stem(file), fid, kind, [[{"x": x, "y": y} for x, y in p.tolist()] for p in parts]))
                    if len(held) == 1000:
                        yield _rows(held, [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.list_(point))], ["file", "fid", "kind", "rings"])
                        held = []
                if held:
                    yield _rows(held, [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.list_(point))], ["file", "fid", "kind", "rings"])

    def records(batches):
        for batch in batches:
            for file, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                held: list = []
                for fid, row in enumerate(_records(raw.as_py(), encoding)):
                    held.append((stem(file), fid, list(row.items())))
                    if len(held) == 1000:
                        yield _rows(held, [pa.string(), pa.int64(), pa.map_(pa.string(), pa.string())], ["file", "fid", "attrs"])
                        held = []
                if held:
                    yield _rows(held, [pa.string(), pa.int64(), pa.map_(pa.string(), pa.string())], ["file", "fid", "attrs"])

    found = _files(spark, path, "*.shp").mapInArrow(shapes, shape)
    rows = _files(spark, path, "*.dbf").mapInArrow(records, "file string, fid long, attrs map<string,string>")
    return found.join(rows, ["file", "fid"], "left")


def _rows(held: list, kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), kinds)], names=names)


def require_safe_rings(rings: DataFrame) -> DataFrame:
    """Raise where an edge spans more than 180 degrees of longitude, unless it closes a polygon along a pole (both ends at |lat| >= 89.9)."""
    step = lambda p: F.exists(F.sequence(F.lit(1), F.size(p) - 1), lambda i: (F.abs(F.get(p, i).x - F.get(p, i - 1).x) > 180) & ~((F.abs(F.get(p, i).y) >= 89.9) & (F.abs(F.get(p, i - 1).y) >= 89.9)))
    bad = rings.where(F.exists("rings", lambda p: F.when(F.size(p) > 1, step(p)).otherwise(False))).select("file", "fid").limit(3).collect()
    if bad:
        raise SourceMismatch(", ".join(f"{x.file} {x.fid}: an edge crosses the dateline" for x in bad))
    return rings

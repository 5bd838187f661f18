"""Grids in binary files by byte ranges: a Python data source whose partitions are strips of rows of one slab.

The driver reads each file's header and deals the rows of its slabs, or its strips or
tiles, into partitions of about STRIP_BYTES; a task reads the bytes of its own
partition only and hands its cells to Spark in batches. So one file is many tasks,
and a task's memory is that of a strip. ``slabs``, ``rows`` and ``columns`` leave
out partitions, and within a partition rows and columns, before anything is read.
Cells and their numbers are those of ``binary.netcdf_grid`` and ``binary.geotiff``.
"""

from __future__ import annotations

import fnmatch
import math
from dataclasses import dataclass, field

import numpy as np

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.sources.binary import _CELLS_SQL, STRIP_SIZES, STRIPS, TILE_SIZES, TILES, Netcdf, Tiff, _batches, unpacked
from tessera.sources.readers import SourceMismatch

#: Stored bytes of a partition, about; a single strip or tile, or a single row, is never cut.
STRIP_BYTES = 16 << 20
#: Bytes that a header is read in.
_AHEAD = 1 << 16


def _opened(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def listed(path: str, glob: str) -> list[str]:
    """Files below a folder whose names match, or the file itself, in order."""
    from pyarrow import fs

    system, inner = _opened(path)
    prefix = path[: len(path) - len(inner)] if ":/" in path else ""
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [path]
    if info.type == fs.FileType.NotFound:
        raise SourceMismatch(f"{path}: no such file or folder")
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(prefix + x.path for x in found if x.type == fs.FileType.File and fnmatch.fnmatch(x.base_name, glob))


class Ranges:
    """Slices of a file, each read where it is asked for; small ones near each other are read once."""

    def __init__(self, path: str):
        system, inner = _opened(path)
        self.file = system.open_input_file(inner)
        self.size, self.at, self.held, self.read = self.file.size(), 0, b"", 0

    def __getitem__(self, part: slice) -> bytes:
        a, b = part.start or 0, min(part.stop, self.size)
        if not (self.at <= a and b <= self.at + len(self.held)):
            n = max(b - a, min(_AHEAD, self.size - a))
            self.at, self.held = a, self.file.read_at(n, a) if n > 0 else b""
            self.read += len(self.held)
        return self.held[a - self.at : b - self.at]

    def exactly(self, a: int, n: int) -> bytes:
        self.read += n
        return self.file.read_at(n, a)


@dataclass
class Strip(InputPartition):
    """Rows r0 to r1 of a slab at a byte offset, or strips or tiles of an image; what a task needs of the header."""

    file: str
    k: int = 0
    r0: int = 0
    r1: int = 0
    width: int = 0
    at: int = 0
    stride: int = 0
    kind: str = ""
    attrs: dict = field(default_factory=dict)
    image: Tiff | None = None
    blocks: list[int] = field(default_factory=list)


def _within(span: tuple[int, int] | None, n: int) -> tuple[int, int]:
    return (0, n) if span is None else (max(0, span[0]), min(n, span[1]))


def netcdf_strips_of(path: str, variable: str, slabs, rows, size: int) -> list[Strip]:
    nc = Netcdf(Ranges(path))
    if variable not in nc.vars:
        raise SourceMismatch(f"{path}: no variable {variable}")
    shape = nc.shape(variable)
    if len(shape) < 2:
        raise SourceMismatch(f"{path}: {variable} is no grid")
    _, attrs, kind, begin, record = nc.vars[variable]
    nlat, nlon = shape[-2:]
    line = nlon * kind.itemsize
    r0, r1 = _within(rows, nlat)
    k0, k1 = _within(slabs, math.prod(shape[:-2]))
    told = {a: attrs[a][:1].tolist() for a in ("_FillValue", "missing_value", "scale_factor", "add_offset") if a in attrs}
    each, out = max(1, size // max(1, line)), []
    for k in range(k0, k1):
        if record and len(shape) == 2:
            start, stride = begin, nc.stride  # a record holds one row
        elif record:
            a, b = divmod(k, math.prod(shape[1:-2]))
            start, stride = begin + a * nc.stride + b * nlat * line, line
        else:
            start, stride = begin + k * nlat * line, line
        out += [Strip(path, k, r, min(r1, r + each), nlon, start, stride, kind.str, told) for r in range(r0, r1, each)]
    return out


def tiff_strips_of(path: str, rows, columns, size: int) -> list[Strip]:
    image = Tiff(Ranges(path))
    high, wide, across = image.layout
    (r0, r1), (c0, c1) = _within(rows, image.shape[0]), _within(columns, image.shape[1])
    places, out, held, room = image.places(), [], [], 0
    image.raw = None
    for i, (_, n) in enumerate(places):
        r, c = i // across * high, i % across * wide
        if r + high <= r0 or r >= r1 or c + wide <= c0 or c >= c1:
            continue
        if held and room + n > size:
            out.append(held)
            held, room = [], 0
        held, room = [*held, i], room + n
    out += [held] if held else []
    offsets, sizes = (TILES, TILE_SIZES) if TILES in image.tags else (STRIPS, STRIP_SIZES)
    few = {t: v for t, v in image.tags.items() if t not in (offsets, sizes)}
    cut = []
    for blocks in out:
        part = Tiff.__new__(Tiff)
        part.__dict__.update(image.__dict__)
        part.tags = few | {offsets: np.array([places[i][0] for i in blocks]), sizes: np.array([places[i][1] for i in blocks])}
        cut.append(Strip(path, image=part, blocks=blocks))
    return cut


class GridReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        span = lambda name: tuple(int(x) for x in options[name].split(":")) if options.get(name) else None
        self.slabs, self.rows, self.columns = span("slabs"), span("rows"), span("columns")

    def partitions(self) -> list[Strip]:
        size, out = int(self.options.get("stripbytes", STRIP_BYTES)), []
        for path in listed(self.options["path"], self.options.get("glob", "*")):
            out += netcdf_strips_of(path, self.options["variable"], self.slabs, self.rows, size) if self.options.get("variable") else tiff_strips_of(path, self.rows, self.columns, size)
        return out or [Strip("")]

    def read(self, part: Strip):
        if not part.file:
            return
        raw = Ranges(part.file)
        if part.image is None:
            yield from self._rows(part, raw)
            return
        image = part.image
        high, wide, across = image.layout
        for place, i in enumerate(part.blocks):
            yield from self._block(part.file, *_one_block(image, raw, place, i, high, wide, across))

    def _rows(self, part: Strip, raw: Ranges):
        kind = np.dtype(part.kind)
        line, n = part.width * kind.itemsize, part.r1 - part.r0
        c0, c1 = _within(self.columns, part.width)
        if part.stride == line:
            v = np.frombuffer(raw.exactly(part.at + part.r0 * line, n * line), kind).reshape(n, part.width)
        else:
            v = np.stack([np.frombuffer(raw.exactly(part.at + r * part.stride, line), kind) for r in range(part.r0, part.r1)])
        v = unpacked(v[:, c0:c1], part.attrs)
        r, c = np.divmod(np.arange(v.size), max(1, c1 - c0))
        yield from _batches(part.file, part.k, part.r0 + r, c0 + c, v.ravel())

    def _block(self, file: str, r: int, c: int, v: np.ndarray):
        (r0, r1), (c0, c1) = _within(self.rows, r + v.shape[0]), _within(self.columns, c + v.shape[1])
        v, r, c = v[max(0, r0 - r) : r1 - r, max(0, c0 - c) : c1 - c], max(r, r0), max(c, c0)
        if v.size:
            i, j = np.divmod(np.arange(v.size), v.shape[1])
            yield from _batches(file, 0, r + i, c + j, v.ravel())


def _one_block(image: Tiff, raw: Ranges, place: int, number: int, high: int, wide: int, across: int) -> tuple[int, int, np.ndarray]:
    """Block ``number`` of an image, the ``place``-th of those that a partition knows."""
    at, n = image.places()[place]
    lone = Tiff.__new__(Tiff)
    lone.__dict__.update(image.__dict__)
    offsets, sizes = (TILES, TILE_SIZES) if TILES in image.tags else (STRIPS, STRIP_SIZES)
    # numbers say where a block lies in the image; its bytes are all that is held
    lone.tags = image.tags | {offsets: np.zeros(number + 1, np.int64), sizes: np.full(number + 1, n)}
    lone.raw = raw.exactly(at, n)
    return next(lone.blocks(range(number, number + 1)))


class GridSource(DataSource):
    """Format ``tessera_grid``: path, glob, variable (of netCDF; an image without), slabs, rows and columns as ``from:to``."""

    @classmethod
    def name(cls) -> str:
        return "tessera_grid"

    def schema(self) -> str:
        return _CELLS_SQL

    def reader(self, schema) -> GridReader:
        return GridReader({k.lower(): v for k, v in dict(self.options).items()})


def grid_strips(spark: SparkSession, path: str, variable: str | None = None, glob: str | None = None, slabs: tuple[int, int] | None = None, rows: tuple[int, int] | None = None, columns: tuple[int, int] | None = None, strip_bytes: int = STRIP_BYTES) -> DataFrame:
    """(file, k, r, c, v) of a netCDF variable, or of one-band images without one, in the file's order; spans are half open."""
    spark.dataSource.register(GridSource)
    told = {"path": path, "variable": variable, "glob": glob or ("*.nc" if variable else "*.tif*"), "stripBytes": strip_bytes}
    told |= {k: f"{v[0]}:{v[1]}" for k, v in {"slabs": slabs, "rows": rows, "columns": columns}.items() if v}
    return spark.read.format("tessera_grid").options(**{k: str(v) for k, v in told.items() if v is not None}).load()




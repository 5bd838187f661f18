"""Sources with a contract of their own: tile sets, time slices, CSV, fixed-width and free-form text. What breaks it raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.stats import finite
from tessera.sources.ordinals import numbered, prefix_sum, records
from tessera.sources.readers import SourceMismatch, require


class SourceNotReady(SourceMismatch):
    """A source of which parts are missing."""


# tiles

# fixed values: tiles of 15 degrees, named by their north and west edges
TILE = 15


def tile_label(north: Column, west: Column) -> Column:
    """N75W030 of a north edge of 75 and a west edge of -30; an edge at 0 is N00 or E000."""
    side = lambda x, a, b, n: F.concat(F.when(x >= 0, a).otherwise(b), F.lpad(F.abs(x).cast("int").cast("string"), n, "0"))
    return F.concat(side(north, "N", "S", 2), side(west, "E", "W", 3))


def tile_bounds(label: Column) -> dict[str, Column]:
    """north and west in degrees; null for what is no label."""
    part = lambda k: F.regexp_extract(label, r"^([NS])(\d\d)([EW])(\d{3})$", k)
    good = part(1) != ""
    return {
        "north": F.when(good, part(2).try_cast("double") * F.when(part(1) == "S", -1).otherwise(1)),
        "west": F.when(good, part(4).try_cast("double") * F.when(part(3) == "W", -1).otherwise(1)),
    }


def all_tiles(spark: SparkSession) -> DataFrame:
    """(label, north, west) of the whole globe."""
    rows, cols = 180 // TILE, 360 // TILE
    at = spark.range(rows * cols).select((90 - TILE * F.floor(F.col("id") / cols)).cast("double").alias("north"), (TILE * (F.col("id") % cols) - 180).cast("double").alias("west"))
    return at.select(tile_label(F.col("north"), F.col("west")).alias("label"), "north", "west")


def tile_files(spark: SparkSession, *folders: str) -> DataFrame:
    """(label, path): of files whose names hold a label, that of the first folder which has one. Contents are not read."""
    out = None
    for i, folder in enumerate(folders):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.lit(i).alias("_p"))
        out = files if out is None else out.union(files)
    named = out.withColumn("label", F.regexp_extract("path", r"([NS]\d\d[EW]\d{3})[^/]*$", 1)).where("label <> ''")
    return named.groupBy("label").agg(F.min_by("path", F.struct("_p", "path")).alias("path"))


def require_tiles(found: DataFrame, expected: DataFrame) -> DataFrame:
    """``found`` if it has every label of ``expected``."""
    missing = [x.label for x in expected.join(found, "label", "left_anti").orderBy("label").select("label").collect()]  # at most a globe's labels
    if missing:
        raise SourceNotReady(f"{len(missing)} tiles missing: {', '.join(missing[:5])}")
    return found


def require_tile(cells: DataFrame, nlat: int, nlon: int, nodata: float | None = None, value: str = "v") -> DataFrame:
    """A tile's (r, c, v) if it has each of its cells once and a value in all of them."""
    v = F.col(value)
    bad = ~finite(v) if nodata is None else ~finite(v) | (v == nodata)
    inside = F.col("r").between(0, nlat - 1) & F.col("c").between(0, nlon - 1)
    n = nlat * nlon
    return require(cells, shape=(F.count("*") == n) & (F.count_if(inside) == n) & (F.count_distinct("r", "c") == n), values=F.count_if(bad) == 0)


def mosaic(tiles: DataFrame, size: int) -> DataFrame:
    """(r, c, v) of the globe, south first, from (label, r, c, v) of tiles of size x size cells, north first."""
    at = tile_bounds(F.col("label"))
    south = ((at["north"] - TILE + 90) / TILE * size).cast("int")
    west = ((at["west"] + 180) / TILE * size).cast("int")
    return tiles.select((south + size - 1 - F.col("r")).cast("int").alias("r"), (west + F.col("c")).cast("int").alias("c"), "v")


# time slices

# fixed values: ages as files of one product name them, and as they are told
SLICE_NAMES = {385.2: 385.0, 390.5: 390.0}
SLICE_RANGE = (0.0, 540.0)


def slice_age(name: Column) -> Column:
    """Million years of a file name that ends in ``_100Ma.nc``; null for another."""
    return F.regexp_extract(name, r"_(\d+(?:\.\d+)?)Ma\.nc$", 1).try_cast("double")


def slices(files: DataFrame, relabel: dict[float, float] = SLICE_NAMES, expected: int | None = None) -> DataFrame:
    """(path, age) in order of age, from a table of paths; ages are unique, in range and as many as expected."""
    age = slice_age(F.col("path"))
    told = F.coalesce(*[F.when(age == a, F.lit(b)) for a, b in relabel.items()], age) if relabel else age
    some = files.withColumn("age", told).where(F.col("age").isNotNull()).select("path", "age")
    rules = {"age twice": F.count("*") == F.count_distinct("age"), "age out of range": F.coalesce(F.min("age") >= SLICE_RANGE[0], F.lit(True)) & F.coalesce(F.max("age") <= SLICE_RANGE[1], F.lit(True))}
    if expected is not None:
        rules["number of slices"] = F.count("*") == expected
    return require(some, **rules).orderBy("age")


# delimited text


def csv_table(spark: SparkSession, path: str, header: list[str], sep: str = ",", numbers: tuple[str, ...] = (), ordinal: str | None = None, parse: str = "raise") -> DataFrame:
    """A CSV whose header is just ``header``: records may span lines, an empty field is null, ``NA`` stays text.

    numbers: columns cast to double; text that is no number raises, or becomes null
    with parse="null". ordinal: a column with each record's place in its file from 1,
    empty lines not counted. A file is read in splits also where records span lines.
    """
    names = [f"_c{i}" for i in range(len(header) + 1)]
    parsed = F.from_csv("value", ", ".join(f"{c} string" for c in names), {"sep": sep, "escape": '"', "emptyValue": "", "multiLine": "true"})
    raw = records(spark, path).select("path", "record", parsed.alias("_r")).select("path", "record", "_r.*")
    first = raw.where("record = 1").withColumn("_head", F.struct(*names))
    same = [F.trim(F.regexp_replace(F.coalesce(F.col(f"_head._c{i}"), F.lit("")), "^﻿", "")) == h for i, h in enumerate(header)]
    ok = F.min((F.forall(F.array(*same), lambda x: x) & F.col(f"_head._c{len(header)}").isNull()).cast("int")) == 1
    require(first, header=F.coalesce(ok, F.lit(True)))
    rows = raw.where("record > 1")
    text = [F.nullif(F.col(f"_c{i}"), F.lit("")) for i in range(len(header))]
    if numbers and parse == "raise":
        wrong = F.array(*[(t.isNotNull() & t.try_cast("double").isNull()) for t, h in zip(text, header) if h in numbers])
        require(rows, numbers=F.count_if(F.array_contains(wrong, True)) == 0)
    out = [t.try_cast("double").alias(h) if h in numbers else t.alias(h) for t, h in zip(text, header)]
    return rows.select(*out, *([(F.col("record") - 1).alias(ordinal)] if ordinal else []))


def require_full_grid(df: DataFrame, nlat: int, nlon: int, r: str = "r", c: str = "c") -> DataFrame:
    """``df`` if each cell of the grid is there just once."""
    n = nlat * nlon
    inside = F.col(r).between(0, nlat - 1) & F.col(c).between(0, nlon - 1)
    return require(df, rows=F.count("*") == n, cells=F.count_distinct(r, c) == n, outside=F.count_if(inside) == n)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` if its key is there and unique in every row."""
    return require(df, null=F.count_if(F.col(key).isNull()) == 0, twice=F.count(key) == F.count_distinct(key))


def locatable(df: DataFrame, lat: str = "lat", lon: str = "lon", expected: int | None = None) -> DataFrame:
    """Rows with both coordinates; ``expected``: how many that must be."""
    some = df.where(finite(F.col(lat)) & finite(F.col(lon)))
    return some if expected is None else require(some, locatable=F.count("*") == expected)


def fixed_width(lines: DataFrame, spec: list[tuple[str, int, str]]) -> DataFrame:
    """Columns (name, width, type) of (value) lines, side by side from the first character; blank numbers are null, other text raises."""
    at, out = 1, []
    for name, width, kind in spec:
        text = F.trim(F.substring("value", at, width))
        out.append((name, F.nullif(text, F.lit("")), kind))
        at += width
    wrong = F.array(*[t.isNotNull() & t.try_cast(kind).isNull() for _, t, kind in out])
    require(lines, fields=F.count_if(F.array_contains(wrong, True)) == 0)
    return lines.select([t.try_cast(kind).alias(name) for name, t, kind in out])


def trailing_off_grid(rows: DataFrame, on_grid: Column, lat_off: Column, lon_off: Column, tolerance: float = 1e-6) -> DataFrame:
    """Rows ``on_grid``; the others go only if both coordinates lie off the grid's lines (distances as ``nearest_line`` gives them)."""
    require(rows, trailing=F.count_if(~on_grid & (F.least(lat_off, lon_off) <= tolerance)) == 0)
    return rows.where(on_grid)


def integer_grid(spark: SparkSession, path: str, nlat: int, nlon: int, header: int = 2) -> DataFrame:
    """(r, c, v), south first, of integers in free form after header lines, north first, whose last column repeats the first.

    Numbers may break over lines as they like: a number's place is that of its line's
    first one, from the counts of the lines before it, in however many splits the file
    is read; ``path`` names one file.
    """
    lines = numbered(spark, path).where(F.col("line") > header).withColumn("t", F.filter(F.split("value", r"\s+"), lambda x: x != ""))
    flat = prefix_sum(lines.select("path", "line", "t"), ["path"], "line", {"before": F.size("t")}, 1 << 17)
    require(flat, size=F.coalesce(F.sum(F.size("t")), F.lit(0)) == nlat * nlon)
    cells = flat.select("before", F.posexplode("t").alias("p", "v")).withColumn("i", F.col("before") + F.col("p"))
    cells = cells.select((nlat - 1 - F.floor(F.col("i") / nlon)).cast("int").alias("r"), (F.col("i") % nlon).cast("int").alias("c"), F.col("v").try_cast("int").alias("v"))
    ends = cells.where(F.col("c").isin(0, nlon - 1)).groupBy("r").agg(F.count("v").alias("n"), (F.min("v") == F.max("v")).alias("same"))
    require(ends, seam=(F.min("n") == 2) & (F.min(F.col("same").cast("int")) == 1))
    return cells.where(F.col("c") < nlon - 1)


def require_poles(nodes: DataFrame, nlat: int, value: str = "v") -> DataFrame:
    """Node grid if each pole's row holds one value."""
    poles = nodes.where(F.col("r").isin(0, nlat - 1)).groupBy("r").agg(F.count_distinct(value).alias("n"))
    require(poles, poles=F.coalesce(F.max("n") <= 1, F.lit(True)))
    return nodes


def require_range(df: DataFrame, low: float, high: float, value: str = "v") -> DataFrame:
    v = F.when(finite(F.col(value)), F.col(value))
    return require(df, range=F.coalesce(F.min(v) >= low, F.lit(True)) & F.coalesce(F.max(v) <= high, F.lit(True)))


# subduction zones and shear


def zone_lattice(nodes: DataFrame, step: float, zone: str = "zone", x: str = "x", y: str = "y") -> DataFrame:
    """(zone, r, c) and all other columns of zone grids whose coordinates are whole steps; depth turns positive, strike is an axis."""
    off = lambda v: F.max(F.abs(F.col(v) / step - F.rint(F.col(v) / step)))
    require(nodes, lattice=F.coalesce(F.greatest(off(x), off(y)) < 1e-6, F.lit(True)))
    out = nodes.withColumns({"r": F.rint((F.col(y) + 90) / step).cast("int"), "c": F.pmod(F.rint((F.col(x) + 180) / step).cast("int"), F.lit(round(360 / step)))})
    if "dep" in nodes.columns:
        out = out.withColumn("dep", -F.col("dep"))
    return out.withColumn("str", F.pmod("str", F.lit(180.0))) if "str" in nodes.columns else out


def shear(vsv: Column, vsh: Column) -> dict[str, Column]:
    """Voigt mean velocity and radial anisotropy of the two shear velocities."""
    return {"vs": F.sqrt((2 * vsv * vsv + vsh * vsh) / 3), "xi": (vsh * vsh) / (vsv * vsv)}


def evaluated(spark: SparkSession, path: str, points: DataFrame, columns: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Rows that an outside evaluator wrote for ``points`` (i, x, y, z), read back with i: as many, in their order, at their coordinates.

    The evaluator's file holds a row a point in order, from i = 0; the first three
    columns are the coordinates. A line's number is its place in the file, in
    however many splits that is read; ``path`` names one file.
    """
    tokens = F.split(F.trim("value"), r"\s+")
    got = numbered(spark, path).select((F.col("line") - 1).alias("i"), tokens.alias("t")).select("i", *[F.get("t", F.lit(k)).try_cast("double").alias(c) for k, c in enumerate(columns)])
    both = points.join(got, "i", "full")
    off = F.greatest(*[F.abs(F.col(a) - F.col(b)) for a, b in zip(("x", "y", "z"), columns)])
    require(both, rows=(F.count("i") == F.count("x")) & (F.count("i") == F.count(columns[0])), once=F.count("i") == F.count_distinct("i"), order=F.coalesce(F.max(off) <= tolerance, F.lit(True)))
    return got

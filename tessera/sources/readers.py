"""Text readers: parse, assert the source's contract, turn to south-first and -180-first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.stats import finite


class SourceMismatch(ValueError):
    """A source that is not what its reader was written for."""


def require(df: DataFrame, **rules: Column) -> DataFrame:
    """``df`` if every aggregate rule holds; one pass decides all of them."""
    got = df.agg(*[rule.alias(name) for name, rule in rules.items()]).first().asDict()
    if broken := [name for name, ok in got.items() if not ok]:
        raise SourceMismatch(", ".join(broken))
    return df


def numbered_lines(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """(path, value) of text files without the first ``skip`` lines of each.

    Lines have no numbers in a distributed scan, but a file's first block is read in
    order: its first row's running id, and the ids after it, are the header's.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"))
    if not skip:
        return lines.select("path", "value")
    first = lines.where("_at = 0").groupBy("path").agg(F.min("_id").alias("_first"))
    return lines.join(first, "path").where(~((F.col("_at") == 0) & (F.col("_id") < F.col("_first") + skip))).select("path", "value")


def fields(spark: SparkSession, path: str, columns: list[str], skip: int = 0, text: tuple[str, ...] = (), use: list[int] | None = None) -> DataFrame:
    """White-space separated fields by position, numbers but for those in ``text``; blank lines go, lines of another width raise.

    skip: header lines of each file. use: positions taken, all of ``width`` fields where it is not given.
    A number that does not parse raises, so no row changes silently.
    """
    tokens = F.split(F.trim("value"), r"\s+")
    rows = numbered_lines(spark, path, skip).where(F.trim("value") != "").select(tokens.alias("t"))
    at = use or list(range(len(columns)))
    least = max(at) + 1
    size = F.size("t")
    width = (F.min(size) == F.max(size)) & (F.min(size) >= least) if use else (F.min(size) == least) & (F.max(size) == least)
    numbers = [k for k, c in zip(at, columns) if c not in text]
    unread = F.count_if(F.array_contains(F.array(*[F.get("t", F.lit(k)).try_cast("double").isNull() for k in numbers]), True)) if numbers else F.lit(0)
    require(rows, width=F.coalesce(width, F.lit(True)), numbers=unread == 0)
    return rows.select([F.col("t")[k].alias(c) if c in text else F.col("t")[k].cast("double").alias(c) for k, c in zip(at, columns)])


def ascii_grid(spark: SparkSession, path: str, header: int = 6) -> DataFrame:
    """(r, c, v) of ESRI ASCII grids, south first; the nodata value becomes null.

    Lines are numbered over a file's splits, so a file of any size is many tasks;
    empty lines may only stand at its end. Its header is a few rows.
    """
    from tessera.sources.ordinals import numbered

    lines = numbered(spark, path).where(F.trim("value") != "")
    number = lambda name: F.max(F.when(F.lower("value").startswith(name), F.regexp_extract("value", r"([-+.\deE]+)\s*$", 1).try_cast("double"))).alias(name)
    heads = lines.where(F.col("line") <= header).groupBy("path").agg(number("nrows"), number("nodata"))
    rows = lines.where(F.col("line") > header).join(heads, "path")
    cells = rows.select((F.col("nrows").cast("int") - F.col("line").cast("int") + header).alias("r"), "nodata", F.posexplode(F.split(F.trim("value"), r"\s+")).alias("c", "v"))
    return cells.select("r", "c", F.nullif(F.col("v").cast("double"), F.col("nodata")).alias("v"))


def south_first(df: DataFrame, nlat: int, r: str = "r") -> DataFrame:
    return df.withColumn(r, nlat - 1 - F.col(r))


def roll_half(df: DataFrame, nlon: int, c: str = "c") -> DataFrame:
    """Columns from 0..360 to -180..180."""
    return df.withColumn(c, F.pmod(F.col(c) + nlon // 2, F.lit(nlon)))


def drop_seam(df: DataFrame, nlon: int, tolerance: float = 0.0, value: str = "v") -> DataFrame:
    """Without the column that repeats the first one at +180; raises where the two differ by more than ``tolerance`` or only one is missing."""
    v = F.when(finite(F.col(value)), F.col(value))
    edge = df.where(F.col("c").isin(0, nlon)).groupBy("r").agg((F.max(v) - F.min(v)).alias("d"), F.count(v).alias("n"))
    require(edge, seam=F.coalesce(F.max("d") <= tolerance, F.lit(True)), one_sided=F.count_if(F.col("n") == 1) == 0)
    return df.where(F.col("c") < nlon)


def average_seam(df: DataFrame, nlon: int, keys: tuple[str, ...] = (), value: str = "v", guard: float | None = None) -> DataFrame:
    """The two independent columns at -180 and +180 become their mean; raises where they are farther apart than ``guard``."""
    if guard is not None:
        edge = df.where(F.col("c").isin(0, nlon)).groupBy(*keys, "r").agg((F.max(value) - F.min(value)).alias("d"))
        require(edge, guard=F.coalesce(F.max("d") <= guard, F.lit(True)))
    return df.groupBy(*keys, "r", F.pmod("c", F.lit(nlon)).alias("c")).agg(F.avg(value).alias(value))


def delimited_lines(spark: SparkSession, path: str, mark: str = "***") -> DataFrame:
    """(line, title, seq, x, y) of a text of titled vertex lists, each closed by a line that starts with ``mark``.

    Lists are numbered by the marks before them, over all splits of the file.
    """
    from tessera.sources.ordinals import numbered, prefix_sum

    lines = numbered(spark, path).where(F.trim("value") != "")
    closes = F.trim("value").startswith(mark)
    told = prefix_sum(lines, ["path"], "line", {"list": closes.cast("int"), "place": F.lit(1)}, 1 << 17).where(~closes)
    first = told.groupBy("path", "list").agg(F.min("place").alias("first"), F.min_by("value", "place").alias("title"))
    at = F.split(F.trim("value"), r"\s*,\s*|\s+")
    points = told.join(first, ["path", "list"]).where("place > first")
    return points.select(F.col("list").cast("int").alias("line"), F.trim("title").alias("title"), (F.col("place") - F.col("first") - 1).cast("int").alias("seq"), at[0].cast("double").alias("x"), at[1].cast("double").alias("y"))

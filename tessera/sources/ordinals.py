"""Line numbers of text files that are read in many splits, and records that span lines.

A first pass counts each split's lines, its quotes and the records that begin in it,
for either parity of the quotes before it. Prefix sums over a file's splits, within
stretches of the file and then over its stretches, tell what stands before each
split. A second pass numbers the lines of every split as it streams by; nothing is
shuffled but a row for each split. Splits are joined by path, start and length, and
a split that the first pass did not see raises, so a file that is cut anew between
the passes never gets wrong numbers.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.readers import SourceMismatch, require

#: Bytes of a file whose splits are summed up in one group: some thousand splits.
STRETCH = 1 << 38
_SPLITS_SQL = "path string, at long, size long, n long, quotes long, even long, odd long"
_LINES_SQL = "path string, at long, size long, value string, i long, quoted int, even long, odd long"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(meta.file_path.alias("path"), meta.file_block_start.alias("at"), meta.file_block_length.alias("size"), "value")


def _pieces(batch: pa.RecordBatch):
    """Ranges of rows of one split: a task reads its splits one after another."""
    n = batch.num_rows
    if not n:
        return
    path, at = batch.column(0), batch.column(1)
    new = pc.or_(pc.not_equal(path.slice(1), path.slice(0, n - 1)), pc.not_equal(at.slice(1), at.slice(0, n - 1))).to_numpy(zero_copy_only=False)
    cuts = [0, *(i + 1 for i in new.nonzero()[0].tolist()), n]
    yield from zip(cuts[:-1], cuts[1:])


class _Counter:
    """Running counts of the split that a task is in."""

    def __init__(self, quote: str):
        self.quote, self.split = quote, None

    def take(self, batch: pa.RecordBatch, a: int, b: int):
        """(split, first number, quotes before each line as parity, records begun before each line if none is open at the split's start, and if one is)."""
        split = tuple(batch.column(k)[a].as_py() for k in range(3))
        if split != self.split:
            self.split, self.n, self.quotes, self.begun = split, 0, 0, [0, 0]
        count = pc.count_substring(batch.column(3).slice(a, b - a), self.quote).to_numpy(zero_copy_only=False)
        before = (self.quotes + count.cumsum() - count) % 2
        blank = pc.match_substring_regex(batch.column(3).slice(a, b - a), r"^\r?$").to_numpy(zero_copy_only=False)
        begins = [(before == k) & ~blank for k in (0, 1)]
        begun = [self.begun[k] + (begins[k].cumsum() - begins[k]) for k in (0, 1)]
        first = self.n
        self.n, self.quotes = self.n + b - a, self.quotes + int(count.sum())
        for k in (0, 1):
            self.begun[k] += int(begins[k].sum())
        return split, first, before, begun


def _count(quote: str):
    def run(batches):
        counter, done = _Counter(quote), {}
        for batch in batches:
            for a, b in _pieces(batch):
                split, *_ = counter.take(batch, a, b)
                done[split] = (counter.n, counter.quotes, *counter.begun)  # a task has as many splits as fit into a partition
        if done:
            rows = list(zip(*((*k, *v) for k, v in done.items())))
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), *(pa.array(x, pa.int64()) for x in rows[1:])], names=[c.split()[0] for c in _SPLITS_SQL.split(", ")])

    return run


def _number(quote: str):
    def run(batches):
        counter = _Counter(quote)
        for batch in batches:
            for a, b in _pieces(batch):
                _, first, before, begun = counter.take(batch, a, b)
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(range(first, first + b - a), pa.int64()), pa.array(before, pa.int32()), *(pa.array(x, pa.int64()) for x in begun)],
                    names=["path", "at", "size", "value", "i", "quoted", "even", "odd"],
                )

    return run


def prefix_sum(rows: DataFrame, keys: list[str], at: str, values: dict[str, Column], stretch: int = STRETCH) -> DataFrame:
    """``rows`` with the sums of ``values`` over the rows before each, in order of the whole number ``at``; names are those of ``values``.

    Two levels: within stretches of ``at``, and over the stretches' sums, so that
    neither a window over a long file nor one over many has to hold all its rows.
    """
    g = "__stretch"
    rows = rows.withColumns({g: F.floor(F.col(at) / stretch), **{f"__v_{n}": v for n, v in values.items()}})
    by, part = ", ".join(f"`{k}`" for k in keys), "rows between unbounded preceding and 1 preceding"
    tops = rows.groupBy(*keys, g).agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in values])
    tops = tops.select(*keys, g, *[F.expr(f"coalesce(sum(`__t_{n}`) over (partition by {by or '1'} order by {g} {part}), 0)").alias(f"__t_{n}") for n in values])
    own = {n: F.expr(f"coalesce(sum(`__v_{n}`) over (partition by {by + ', ' if by else ''}{g} order by `{at}` {part}), 0)") for n in values}
    out = rows.withColumns({f"__o_{n}": v for n, v in own.items()}).join(tops, [*keys, g])
    return out.withColumns({n: (F.col(f"__o_{n}") + F.col(f"__t_{n}")).cast("long") for n in values}).drop(g, *[f"__{k}_{n}" for n in values for k in "vot"])


def _placed(spark: SparkSession, path: str, quote: str) -> tuple[DataFrame, DataFrame]:
    """(lines with all that stands before their split, splits)."""
    lines = _lines(spark, path)
    splits = lines.mapInArrow(_count(quote), _SPLITS_SQL)
    splits = prefix_sum(splits, ["path"], "at", {"lines_before": F.col("n"), "quotes_before": F.col("quotes")})
    splits = splits.withColumn("open", F.col("quotes_before") % 2).withColumn("records", F.when(F.col("open") == 0, F.col("even")).otherwise(F.col("odd")))
    splits = prefix_sum(splits, ["path"], "at", {"records_before": F.col("records")})
    told = splits.select("path", "at", "size", "lines_before", "records_before", "open")
    found = lines.mapInArrow(_number(quote), _LINES_SQL).join(told, ["path", "at", "size"], "left")
    seen = F.when(F.col("lines_before").isNull(), F.raise_error(F.concat(F.lit("split anew between two passes: "), F.col("path")))).otherwise(F.col("lines_before"))
    return found.withColumn("line", seen + F.col("i") + 1), splits


def numbered(spark: SparkSession, path: str, across: bool = False) -> DataFrame:
    """(path, line, value): each line with its number in its file from 1, however many splits a file is read in.

    across: numbers run on over the files, in order of their paths. A file without
    lines has no rows; a carriage return at a line's end goes.
    """
    found, splits = _placed(spark, path, '"')
    value = F.regexp_replace("value", "\r$", "")
    if not across:
        return found.select("path", "line", value.alias("value"))
    sizes = splits.groupBy("path").agg(F.sum("n").alias("n"))
    # a row for each file
    before = sizes.select("path", F.expr("coalesce(sum(n) over (order by path rows between unbounded preceding and 1 preceding), 0)").alias("files_before"))
    return found.join(before, "path").select("path", (F.col("line") + F.col("files_before")).alias("line"), value.alias("value"))


def records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(path, record, value): records of delimited text, numbered from 1 in their file, whose quoted fields may span lines.

    A line begins a record where an even number of quotes stands before it, unless
    it is empty: such lines between records do not count. A file with an odd number of quotes raises, since its last record would never end; so
    a record is as long as its quoted text, and only its own lines meet.
    """
    found, splits = _placed(spark, path, quote)
    require(splits.groupBy("path").agg(F.sum("quotes").alias("q")), quotes=F.coalesce(F.max(F.col("q") % 2) == 0, F.lit(True)))
    inside = (F.col("quoted") + F.col("open")) % 2 == 1
    begun = F.when(F.col("open") == 0, F.col("even")).otherwise(F.col("odd")) + F.col("records_before")
    found = found.where(inside | ~F.col("value").rlike("^\r?$"))
    at = found.select("path", "line", "value", (begun + F.when(inside, 0).otherwise(1)).alias("record"))
    whole = at.groupBy("path", "record").agg(F.sort_array(F.collect_list(F.struct("line", "value"))).alias("l"))
    return whole.select("path", "record", F.regexp_replace(F.array_join("l.value", "\n"), "\r$", "").alias("value"))


def row_major(rows: DataFrame, ordinal: str, lat: str, lon: str, lat0: float, lon0: float, step: float, nlat: int, nlon: int, values: list[str], trailing: int | None = None, tolerance: float = 1e-6) -> DataFrame:
    """(r, c, values) of a grid written row by row from its south-west corner, and after it rows that belong to no cell.

    The row of ``ordinal`` k (from 0) is cell (k div nlon, k mod nlon) and must stand
    at its coordinates; grid and values are complete and finite. Later rows, as many
    as ``trailing`` says, must lie off the grid's lines in both coordinates. Anything
    else raises; one pass decides.
    """
    n = nlat * nlon
    k = F.col(ordinal)
    off = F.greatest(F.abs(F.col(lat) - (lat0 + step * F.floor(k / nlon))), F.abs(F.col(lon) - (lon0 + step * (k % nlon))))
    near = lambda v, o, m: F.abs(v - (o + step * F.least(F.greatest(F.rint((v - o) / step), F.lit(0)), F.lit(m - 1))))
    later = F.least(near(F.col(lat), lat0, nlat), near(F.col(lon), lon0, nlon))
    finite = F.forall(F.array(*[F.col(c).cast("double") for c in (lat, lon, *values)]), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rules = {
        "rows": F.count("*") == (n + trailing if trailing is not None else F.greatest(F.count("*"), F.lit(n))),
        "ordinals": (F.count_distinct(k) == F.count("*")) & F.coalesce(F.min(k) == 0, F.lit(True)) & F.coalesce(F.max(k) == F.count("*") - 1, F.lit(True)),
        "row major": F.count_if((k < n) & ~F.coalesce(off <= tolerance, F.lit(False))) == 0,
        "trailing rows on the grid": F.count_if((k >= n) & F.coalesce(later <= tolerance, F.lit(True))) == 0,
        "values": F.count_if(~F.coalesce(finite, F.lit(False))) == 0,
    }
    require(rows, **rules)
    return rows.where(k < n).select(F.floor(k / nlon).cast("int").alias("r"), (k % nlon).cast("int").alias("c"), *values)


def strain_grid(spark: SparkSession, path: str, nlat: int, nlon: int, lat0: float, lon0: float, step: float, columns: list[str], skip: int, trailing: int | None = None) -> DataFrame:
    """(r, c, columns) of white-space separated text: ``skip`` header lines, then latitude, longitude, ``columns`` (more may follow), as ``row_major`` has it."""
    tokens = F.split(F.trim("value"), r"\s+")
    lines = numbered(spark, path).where(F.col("line") > skip)
    number = lambda i: F.get("t", F.lit(i)).try_cast("double")
    rows = lines.select((F.col("line") - skip - 1).alias("k"), tokens.alias("t")).select("k", number(0).alias("lat"), number(1).alias("lon"), *[number(i + 2).alias(c) for i, c in enumerate(columns)])
    return row_major(rows, "k", "lat", "lon", lat0, lon0, step, nlat, nlon, columns, trailing)


__all__ = ["SourceMismatch", "numbered", "prefix_sum", "records", "row_major", "strain_grid"]

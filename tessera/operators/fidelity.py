"""Checks of a built layer against what it was made from: rows (name, status, summary), status pass, FAIL or report.

Each check is one aggregate query; only its single row reaches the driver, when a report is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.geometry import haversine, segment_distance, unit_vector
from tessera.functions.grid import RADIUS_KM, TIERS, row_areas, shape
from tessera.operators.stats import hist_quantiles, histogram, pair_stats
from tessera.sources.scratch import dealt

#: Greatest relative deviation of an area integral.
INTEGRAL_TOLERANCE = 1e-3
QUANTILES = (0.01, 0.25, 0.5, 0.75, 0.99)


def verdict(name: str, ok: Column, summary: Column) -> list[Column]:
    """Aggregates of one check; what cannot be decided (null) fails."""
    return [F.lit(name).alias("name"), F.when(F.coalesce(ok, F.lit(False)), "pass").otherwise("FAIL").alias("status"), summary.alias("summary")]


def same_cells(stored: DataFrame, again: DataFrame, name: str, keys: tuple[str, ...] = ("r", "c"), value: str = "v") -> DataFrame:
    """Stored values equal recomputed ones, missing where they are missing; an absent cell is a missing one."""
    some = lambda x: x.where(F.col(value).isNotNull())
    both = some(stored).select(*keys, F.col(value).alias("a")).join(some(again).select(*keys, F.col(value).alias("b")), list(keys), "full")
    got = both.agg(F.count_if(F.col("a").isNull() != F.col("b").isNull()).alias("valid"), F.count_if(F.col("a") != F.col("b")).alias("wrong"), F.count("*").alias("n"))
    return got.select(*verdict(name, (F.col("valid") == 0) & (F.col("wrong") == 0), F.format_string("%d cells, %d differ, %d of them only missing on one side", "n", F.col("wrong") + F.col("valid"), "valid")))


def integral_kept(source: DataFrame, built: DataFrame, name: str, value: str = "v", weight: str = "w", tolerance: float = INTEGRAL_TOLERANCE) -> DataFrame:
    """Value times weight over all cells is the same on both sides; tables of (value, weight)."""
    total = lambda x, s: x.agg(F.sum(F.col(value) * F.col(weight)).alias(s), F.sum(F.abs(F.col(value)) * F.col(weight)).alias(f"{s}_size"))
    both = total(source, "a").join(total(built, "b"))  # one row each
    off = F.abs(F.col("b") - F.col("a")) / F.nullif(F.col("a_size"), F.lit(0.0))
    return both.select(off.alias("off")).select(*verdict(name, F.col("off") < tolerance, F.format_string("relative deviation %.3e", F.coalesce("off", F.lit(float("nan"))))))


def counts_kept(fine: DataFrame, coarse: DataFrame, name: str, value: str = "v") -> DataFrame:
    """Sums agree exactly, and no count is negative."""
    both = fine.agg(F.sum(F.col(value).cast("long")).alias("a")).join(coarse.agg(F.sum(F.col(value).cast("long")).alias("b"), F.min(value).alias("low")))  # one row each
    return both.select(*verdict(name, (F.coalesce("a", F.lit(0)) == F.coalesce("b", F.lit(0))) & F.coalesce(F.col("low") >= 0, F.lit(True)), F.format_string("%s to %s", F.col("a").cast("string"), F.col("b").cast("string"))))


def in_codes(cells: DataFrame, codes: list[int], name: str, value: str = "v") -> DataFrame:
    """Every present value is one of ``codes``."""
    wrong = F.count_if(~F.col(value).isin(codes) & F.col(value).isNotNull())
    return cells.agg(wrong.alias("n")).select(*verdict(name, F.col("n") == 0, F.format_string("%d cells outside the code table", "n")))


def in_range(cells: DataFrame, low: float, high: float, name: str, value: str = "v") -> DataFrame:
    got = cells.agg(F.min(value).alias("a"), F.max(value).alias("b"))
    ok = F.coalesce((F.col("a") >= low) & (F.col("b") <= high), F.lit(True))
    return got.select(*verdict(name, ok, F.format_string("%s to %s", F.col("a").cast("string"), F.col("b").cast("string"))))


def share_in(cells: DataFrame, test: Column, low: float, high: float, name: str, weight: str = "w") -> DataFrame:
    """The weighted share of cells that pass ``test`` lies between two bounds (land among all area, say)."""
    got = cells.agg((F.sum(F.when(test, F.col(weight)).otherwise(0.0)) / F.sum(weight)).alias("share"))
    return got.select(*verdict(name, F.col("share").between(low, high), F.format_string("share %.4f", "share")))


def quantile_shift(source: DataFrame, built: DataFrame, name: str, low: float, high: float, width: float, qs: tuple[float, ...] = QUANTILES, value: str = "v") -> DataFrame:
    """Report only: how far fixed quantiles of the histograms move."""
    take = lambda x, s: hist_quantiles(histogram(x, value, low, high, width), list(qs), low, width).withColumnRenamed("value", s)
    both = take(source, "a").join(take(built, "b"), "q")
    each = F.array_sort(F.collect_list(F.struct("q", "a", "b")))
    text = F.array_join(F.transform(each, lambda x: F.format_string("q%02d %.4g to %.4g", F.round(x.q * 100).cast("int"), x.a, x.b)), ", ")
    return both.agg(text.alias("summary")).select(F.lit(name).alias("name"), F.lit("report").alias("status"), "summary")


def share_drift(fine: DataFrame, coarse: DataFrame, name: str, value: str = "v") -> DataFrame:
    """Report only: the class whose share of present cells moves most between two tiers."""
    part = lambda x, s: x.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n")).select(value, (F.col("n") / F.sum("n").over(_all())).alias(s))
    both = part(fine, "a").join(part(coarse, "b"), value, "full").withColumn("d", F.coalesce("b", F.lit(0.0)) - F.coalesce("a", F.lit(0.0)))
    got = both.agg(F.max_by(F.struct(value, "d"), F.struct(F.abs("d"), value)).alias("m"))
    return got.select(F.lit(name).alias("name"), F.lit("report").alias("status"), F.format_string("class %s by %+.4f", F.col(f"m.{value}").cast("string"), "m.d").alias("summary"))


def _all():
    from pyspark.sql import Window

    return Window.partitionBy()  # over a row for each class


def level_curves(fine: DataFrame, coarse: DataFrame, name: str, tolerance: float, key: str = "k", value: str = "v", weight: str = "w") -> DataFrame:
    """Both tiers have the same levels, and each level's weighted mean agrees."""
    mean = lambda x, s: x.where(F.col(value).isNotNull()).groupBy(key).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias(s))
    both = mean(fine, "a").join(mean(coarse, "b"), key, "full")
    got = both.agg(F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("lone"), F.max(F.abs(F.col("a") - F.col("b"))).alias("d"), F.count("*").alias("n"))
    return got.select(*verdict(name, (F.col("lone") == 0) & (F.coalesce("d", F.lit(0.0)) <= tolerance), F.format_string("%d levels, %d on one side, greatest difference %.3g", "n", "lone", F.coalesce("d", F.lit(0.0)))))


def evenly(df: DataFrame, n_cells: int, n: int, nlon: int) -> DataFrame:
    """About ``n`` cells evenly spaced in row-major order: a check's stated sample."""
    return df.where((F.col("r").cast("long") * nlon + F.col("c")) % max(1, n_cells // n) == 0)


def distances_hold(cells: DataFrame, segs: DataFrame, name: str, tier: str, sample: int = 64, value: str = "v") -> DataFrame:
    """Distances of an evenly spaced sample of cells against every segment, within max(0.001 km, 3e-7 of the distance).

    The sample (64 cells as it stands) is what is repeated for each segment; the least distances are combined map-side.
    """
    nlat, nlon = shape(tier)
    res = float(TIERS[tier])
    some = evenly(cells, nlat * nlon, sample, nlon).select("r", "c", F.col(value).alias("v"))
    met = dealt(segs).join(F.broadcast(some))
    lat, lon = (F.col("r") + 0.5) * res - 90, (F.col("c") + 0.5) * res - 180
    km = segment_distance(unit_vector(lat, lon), unit_vector(F.col("lat"), F.col("lon")), unit_vector(F.col("lat2"), F.col("lon2")))
    ends = F.least(haversine(lat, lon, F.col("lat"), F.col("lon")), haversine(lat, lon, F.col("lat2"), F.col("lon2")))
    least = met.groupBy("r", "c", "v").agg(F.min(km).alias("km"), F.min(ends).alias("ends"))
    off = F.abs(F.col("v") - F.col("km"))
    got = least.agg(F.count("*").alias("n"), F.count_if(off > F.greatest(F.lit(1e-3), 3e-7 * F.col("km"))).alias("wrong"), F.count_if(F.col("v") > F.col("ends") + 1e-3).alias("far"))
    return got.select(*verdict(name, (F.col("n") > 0) & (F.col("wrong") == 0) & (F.col("far") == 0), F.format_string("%d cells, %d off, %d beyond an end point", "n", "wrong", "far")))


def area_weighted(cells: DataFrame, tier: str) -> DataFrame:
    """``cells`` with ``w``, a cell's area; a row of weights for each latitude is all that is joined."""
    areas = row_areas(cells.sparkSession, tier).select("r", (F.col("area_km2") / RADIUS_KM**2).alias("w"))
    return cells.join(F.broadcast(areas), "r")


#: Latitude beyond which a cell is polar.
POLAR = 60.0


def cross_check(pairs: DataFrame, x: str, y: str) -> DataFrame:
    """(segment, n, r, ...) of two sources at the same cells: ``pair_stats`` in each segment a cell belongs to, which may be several.

    ``land`` is a boolean column of the cells, ``lat`` their latitude.
    """
    tests = {"global": F.lit(True), "land": F.col("land"), "sea": ~F.col("land"), "polar": F.abs("lat") > POLAR, "non-polar": F.abs("lat") <= POLAR}
    segments = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))
    return pair_stats(pairs.withColumn("segment", F.explode(segments)), x, y, "segment")


def run_groups(groups: dict) -> list[dict]:
    """Checks of several groups, {name: function that gives rows (name, status, summary)}; a group that raises is a FAIL of its own."""
    out = []
    for name, run in groups.items():
        try:
            out += [{"name": f"{name}: {x['name']}", "status": x["status"], "summary": x["summary"]} for x in (r.asDict() for r in run().collect())]
        except Exception as e:  # noqa: BLE001 - whatever it is, the sheet must show it
            out.append({"name": name, "status": "FAIL", "summary": f"{type(e).__name__}: {e}".split("\n")[0][:300]})
    return out

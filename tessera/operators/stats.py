"""Histograms, paired statistics, coverage and checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str, low: float, high: float, width: float, nodata: float = -99999) -> DataFrame:
    """(bin, n): fixed bins; what lies outside counts in the end bins, null, NaN, infinity and ``nodata`` do not count."""
    v = F.col(value).cast("double")
    bins = round((high - low) / width)
    some = df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")) & (v != nodata))
    return some.groupBy(F.least(F.greatest(F.floor((v - low) / width), F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def hist_quantiles(hist: DataFrame, qs: list[float], low: float, width: float) -> DataFrame:
    """(q, value) by linear interpolation in the binned distribution; the histogram's size does not depend on the rows."""
    run = hist.withColumn("cum", F.sum("n").over(Window.orderBy("bin"))).withColumn("total", F.sum("n").over(Window.partitionBy()))
    run = run.withColumn("q", F.explode(F.array(*[F.lit(q) for q in qs]))).withColumn("t", F.col("q") * F.col("total")).where(F.col("cum") >= F.col("t"))
    value = low + (F.col("bin") + (F.col("t") - (F.col("cum") - F.col("n"))) / F.col("n")) * width
    return run.groupBy("q").agg(F.min_by(value, "bin").alias("value"))


#: Accuracy of the sketch that brackets a quantile: its rank is off by at most rows / ACCURACY.
ACCURACY = 10_000
#: Ranks by which a bracket is wider than that, on both sides; a rank outside its bracket raises.
BRACKET = 3


def finite(v: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v.cast("double")), F.lit(False))


def exact_quantiles(df: DataFrame, value: str, qs: list[float], *keys: str) -> DataFrame:
    """(keys, q, value): exact quantiles, interpolated between neighbours, of the finite values of each group.

    A mergeable sketch brackets each rank, then only the distinct values within the
    brackets are counted and ordered: about 6 / ACCURACY of a group's values meet in
    a task, however many rows or ties it has. Groups of fewer than 10 * ACCURACY
    rows are ordered whole.
    """
    some = df.where(finite(F.col(value))).select(*keys, F.col(value).cast("double").alias("_v"))
    off = BRACKET / ACCURACY
    edges = F.percentile_approx("_v", [min(1.0, max(0.0, q + d)) for q in qs for d in (-off, off)], ACCURACY)
    first, last = F.min("_v"), F.max("_v")
    sketch = some.groupBy(*keys).agg(F.count("*").alias("_n"), edges.alias("_e"), first.alias("_first"), last.alias("_last"))
    # an edge cut off at 0 or 1 is the least or the greatest value
    low = lambda i, q: F.when(F.lit(q - off <= 0) | (F.col("_n") < 10 * ACCURACY), F.col("_first")).otherwise(F.col("_e")[2 * i])
    high = lambda i, q: F.when(F.lit(q + off >= 1) | (F.col("_n") < 10 * ACCURACY), F.col("_last")).otherwise(F.col("_e")[2 * i + 1])
    spans = sketch.select(*keys, "_n", F.array(*[F.struct(F.lit(q).alias("q"), low(i, q).alias("a"), high(i, q).alias("b")) for i, q in enumerate(qs)]).alias("_s"))
    met = some.join(spans, list(keys)) if keys else some.join(F.broadcast(spans))  # one row without keys
    each = met.select(*keys, "_n", "_v", F.explode("_s").alias("_s")).where(F.col("_v") <= F.col("_s.b"))
    inside = F.when(F.col("_v") >= F.col("_s.a"), F.col("_v"))
    counts = each.groupBy(*keys, "_n", F.col("_s.q").alias("q"), inside.alias("_v")).agg(F.count("*").alias("_k"))
    w = Window.partitionBy(*keys, "q").orderBy(F.col("_v").asc_nulls_first())  # what lies below the bracket is one row, the first
    run = counts.withColumn("_upto", F.sum("_k").over(w)).withColumn("_at", F.col("q") * (F.col("_n") - 1))
    take = lambda rank: F.min(F.when(F.col("_upto") > rank, F.col("_v")))
    lower, upper = take(F.floor("_at")), take(F.ceil("_at"))
    part = F.first("_at") - F.floor(F.first("_at"))
    below = F.coalesce(F.max(F.when(F.col("_v").isNull(), F.col("_upto"))), F.lit(0))
    held = (below <= F.floor(F.first("_at"))) & (F.max("_upto") > F.ceil(F.first("_at")))
    return run.groupBy(*keys, "q").agg(F.when(held, lower + (upper - lower) * part).otherwise(F.raise_error(F.lit("a rank lies outside its bracket"))).alias("value"))


def pair_stats(df: DataFrame, x: str, y: str, *keys: str) -> DataFrame:
    """Of y - x: n, r, mean, median, population deviation, absolute and quadratic means, 5th and 95th percentiles, regression line.

    Only pairs whose two values are finite count; with fewer than two of them all but n is null.
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    group = list(keys) or ["_all"]
    some = df.withColumn("_all", F.lit(0)).select(*group, F.when(finite(a) & finite(b), a).alias("_a"), F.when(finite(a) & finite(b), b).alias("_b"))
    some = some.withColumn("_d", F.col("_b") - F.col("_a"))
    d = F.col("_d")
    plain = {
        "r": F.corr("_a", "_b"), "mean_diff": F.avg(d), "std_diff": F.stddev_pop(d), "mae": F.avg(F.abs(d)), "rmse": F.sqrt(F.avg(d * d)),
        "slope": F.regr_slope("_b", "_a"), "intercept": F.regr_intercept("_b", "_a"),
    }
    out = some.groupBy(*group).agg(F.count(d).alias("n"), *[F.when(F.count(d) >= 2, v).alias(k) for k, v in plain.items()])
    names = {0.5: "median_diff", 0.05: "p05", 0.95: "p95"}
    ranks = exact_quantiles(some, "_d", list(names), *group).groupBy(*group).agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(k) for q, k in names.items()])
    out = out.join(ranks, group, "left")
    order = ("r", "mean_diff", "median_diff", "std_diff", "mae", "rmse", "p05", "p95", "slope", "intercept")
    return out.select(*keys, "n", *[F.when(F.col("n") >= 2, F.col(k)).alias(k) for k in order])


def present(v: Column, zero_is_missing: bool = False) -> Column:
    """1 where a value is there: not null nor NaN, and for class layers not 0."""
    ok = v.isNotNull() & ~F.coalesce(F.isnan(v.cast("double")), F.lit(False))
    return (ok & (v != 0) if zero_is_missing else ok).cast("int")


def layer_checksum(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, cells, checksum): order-free, exact under any partitioning; sums of row digests, so no layer meets in one task."""
    # a null takes no part in the hash: layers without levels have the same checksum whether or not the table has a k
    row = F.xxhash64(*[x for x in ("k",) if x in df.columns], "r", "c", value).cast("decimal(38,0)")
    return df.groupBy(*keys).agg(F.count("*").alias("cells"), F.sum(row).cast("string").alias("checksum"))


def layer_sha256(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, sha256): of each layer's cells in order, south to north; rows of cells are digested first, so a task holds one row or one column of digests."""
    level = F.col("k").cast("string") if "k" in df.columns else F.lit("")
    line = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(level.alias("k"), "c", F.coalesce(F.col(value).cast("string"), F.lit("-")).alias("v")))), lambda x: F.concat_ws(",", x.k, x.c, x.v)), ";")
    rows = df.groupBy(*keys, "r").agg(F.sha2(line, 256).alias("d"))
    return rows.groupBy(*keys).agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "d"))), lambda x: F.concat_ws(":", x.r, x.d)), ";"), 256).alias("sha256"))


def checksum_differences(a: DataFrame, b: DataFrame, keys: list[str], value: str = "sha256") -> DataFrame:
    """(keys, left, right) of layers that only one side has or whose digests differ: none for equal stores."""
    both = a.select(*keys, F.col(value).alias("left")).join(b.select(*keys, F.col(value).alias("right")), keys, "full")
    return both.where(~F.col("left").eqNullSafe(F.col("right")))


def continuation_fit(df: DataFrame, k: str, ratio: str, low: float, high: float) -> DataFrame:
    """Height difference from the slope of log ratio over wavenumber; null with fewer than three bins."""
    some = df.where(F.col(k).between(low, high) & (F.col(ratio) > 0))
    y = F.ln(ratio)
    enough = F.count("*") >= 3
    return some.agg(F.count("*").alias("n"), F.when(enough, -F.regr_slope(y, F.col(k)) / 2).alias("dz"), F.when(enough, F.regr_r2(y, F.col(k))).alias("r2"), F.avg((F.col(ratio) > 1).cast("int")).alias("above"))

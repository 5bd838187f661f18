"""Merging sources on the cells they share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shallowest(zones: DataFrame, depth: str = "dep", zone: str = "zone", payload: tuple[str, ...] = ()) -> DataFrame:
    """Per cell everything of the zone with the least depth, the first zone of ties, and how many zones cover it."""
    best = F.min_by(F.struct(zone, depth, *payload), F.struct(depth, zone))
    return zones.where(F.col(depth).isNotNull()).groupBy("r", "c").agg(best.alias("b"), F.count("*").alias("n_zones")).select("r", "c", "b.*", "n_zones")


def zone_counts(zones: DataFrame, factor: int, zone: str = "zone") -> DataFrame:
    """Distinct zones that meet a coarse cell: a union, not a sum."""
    return zones.groupBy(F.expr(f"int(r div {factor})").alias("r"), F.expr(f"int(c div {factor})").alias("c")).agg(F.count_distinct(zone).alias("n"))


def zone_overlaps(zones: DataFrame, zone: str = "zone") -> DataFrame:
    """(zone_a, zone_b, cells) of each pair: the zones of a cell are a short sorted list, its pairs are taken there."""
    lists = zones.groupBy("r", "c").agg(F.array_sort(F.collect_set(zone)).alias("z")).where(F.size("z") > 1)
    pairs = F.flatten(F.transform("z", lambda a, i: F.transform(F.filter("z", lambda b: b > a), lambda b: F.struct(a.alias("zone_a"), b.alias("zone_b")))))
    return lists.select(F.explode(pairs).alias("p")).groupBy("p.zone_a", "p.zone_b").agg(F.count("*").alias("cells"))


def overlay(*layers: DataFrame, key: tuple[str, ...], value: str) -> DataFrame:
    """Per key the value of the first layer that has it."""
    marked = [x.select(*key, F.lit(i).alias("_p"), value) for i, x in enumerate(layers)]
    out = marked[0]
    for x in marked[1:]:
        out = out.unionByName(x)
    return out.groupBy(*key).agg(F.min_by(value, "_p").alias(value))


def smallest_wins(hits: DataFrame, size: str, order: str, value: str) -> DataFrame:
    """Per cell the value of the smallest hit; of equal sizes the later one."""
    return hits.groupBy("r", "c").agg(F.min_by(value, F.struct(F.col(size), (-F.col(order)).alias("o"))).alias(value), F.count("*").alias("n_hits"))


def anti_merge(primary: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """All of ``primary`` and the rows of ``extra`` whose key it lacks; a null key in ``extra`` never joins in."""
    new = extra.where(F.col(key).isNotNull()).join(primary.select(key).distinct(), key, "left_anti")
    return primary.withColumn("source", F.lit("primary")).unionByName(new.withColumn("source", F.lit("extra")), allowMissingColumns=True)


def reconcile(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side): what only one of two registries has."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").withColumn("side", F.lit("left")).union(y.join(x, key, "left_anti").withColumn("side", F.lit("right")))


def nearest_match(left: DataFrame, right: DataFrame, key: list[str], id_: str, a: str, b: str) -> DataFrame:
    """(id, d): per left row the least difference to the rows of ``right`` at its key."""
    return left.join(right, key).groupBy(id_).agg(F.min(F.abs(F.col(a) - F.col(b))).alias("d"))


def match_counts(left: DataFrame, right: DataFrame, key: list[str], id_: str, a: str, b: str, identical: float = 0.01) -> DataFrame:
    """(exact, comparable, identical): rows of ``left`` whose key ``right`` has, those with values to compare, and those that differ by ``identical`` at most."""
    met = left.join(right.select(*key, b), key)
    each = met.groupBy(id_).agg(F.min(F.abs(F.col(a) - F.col(b))).alias("d"))
    return each.agg(F.count("*").alias("exact"), F.count("d").alias("comparable"), F.count_if(F.col("d") <= identical).alias("identical"))


def stratified(df: DataFrame, stratum: str, order: str, n: int) -> DataFrame:
    """At most ``n`` rows of each stratum, the first by a hash of ``order``: the same rows however the table is cut; partial ranks come before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(F.xxhash64(order), order))
    return df.withColumn("_n", rank).where(F.col("_n") <= n).drop("_n")

"""Mergeable states of tiles: counts, exact sums, bounds and histograms kept as rows, merged later, refreshed where cells changed.

Sums are of decimals, so a merge gives the same number whatever its order. A tile's
digest is a sum of its cells' hashes: a pass that only hashes finds the tiles that
changed, and only their cells are counted anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.stats import finite

_EXACT = "decimal(38,9)"


def _tile(size: int) -> list[Column]:
    return [F.expr(f"int(r div {size})").alias("tr"), F.expr(f"int(c div {size})").alias("tc")]


def _digest(value: str) -> Column:
    return F.sum(F.xxhash64("r", "c", F.col(value).cast("double")).cast("decimal(38,0)"))


def tile_states(cells: DataFrame, size: int, low: float, width: float, bins: int, value: str = "v") -> DataFrame:
    """(tr, tc, n, total, least, most, hist, digest) of tiles of size x size cells; hist: {bin: cells}.

    Only finite values count, in n as in all else; values outside the bins fall into
    the first or last one. The digest is of all cells, missing ones too.
    """
    v = F.when(finite(F.col(value)), F.col(value).cast("double"))
    at = F.when(v.isNotNull(), F.least(F.greatest(F.floor((v - low) / width), F.lit(0)), F.lit(bins - 1)).cast("int"))
    part = cells.groupBy(*_tile(size), at.alias("bin")).agg(F.count(v).alias("n"), F.sum(v.cast(_EXACT)).alias("total"), F.min(v).alias("least"), F.max(v).alias("most"), _digest(value).alias("digest"))
    entry = F.when(F.col("bin").isNotNull(), F.struct("bin", "n"))
    return part.groupBy("tr", "tc").agg(
        F.sum("n").alias("n"), F.sum("total").cast(_EXACT).alias("total"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("hist"), F.sum("digest").cast("decimal(38,0)").alias("digest"),
    )


def merged(states: DataFrame, *keys: Column) -> DataFrame:
    """(keys, n, total, mean, least, most) of any grouping of tiles, from their states alone."""
    total = F.sum("total").cast("double")
    return states.groupBy(*keys).agg(F.sum("n").alias("n"), total.alias("total"), (total / F.sum("n")).alias("mean"), F.min("least").alias("least"), F.max("most").alias("most"))


def merged_histogram(states: DataFrame, *keys: Column) -> DataFrame:
    """(keys, bin, n), as a histogram of all cells has it."""
    named = states.select(*[k.alias(f"_k{i}") for i, k in enumerate(keys)], F.explode("hist").alias("bin", "n"))
    return named.groupBy(*[f"_k{i}" for i in range(len(keys))], "bin").agg(F.sum("n").alias("n"))


def changed_tiles(states: DataFrame, cells: DataFrame, size: int, value: str = "v") -> DataFrame:
    """(tr, tc) of tiles whose cells are not those of their state: new, gone or different."""
    now = cells.groupBy(*_tile(size)).agg(_digest(value).cast("decimal(38,0)").alias("now"))
    both = states.select("tr", "tc", "digest").join(now, ["tr", "tc"], "full")
    return both.where(~F.col("digest").eqNullSafe(F.col("now"))).select("tr", "tc")


def refreshed(states: DataFrame, cells: DataFrame, size: int, low: float, width: float, bins: int, value: str = "v") -> DataFrame:
    """``tile_states`` of ``cells``, of which only those in changed tiles are counted; other tiles keep their states."""
    changed = changed_tiles(states, cells, size, value)
    tr, tc = _tile(size)
    some = cells.withColumns({"tr": tr, "tc": tc}).join(changed, ["tr", "tc"], "left_semi").drop("tr", "tc")
    return states.join(changed, ["tr", "tc"], "left_anti").unionByName(tile_states(some, size, low, width, bins, value))

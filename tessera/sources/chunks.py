"""Layers stored by chunk and bucket: boxes read their chunks only, and stored layers join without a shuffle.

A chunk is a block of cells with a number, a folder of its own; within it cells are
bucketed and sorted by (r, c). Layers of one tier are cut alike, so a join on (r, c)
finds equal buckets and needs no exchange, and a filter on chunks prunes folders.
Each chunk's count, least and greatest value are a small table beside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.grid import TIERS, shape

# fixed values: rows and columns of a chunk
CHUNKS = {"1deg": (180, 360), "30min": (360, 720), "6min": (900, 900), "3min": (900, 900), "30sec": (1080, 1080)}
#: Buckets of a layer; those of two layers must be as many to join without a shuffle.
BUCKETS = 16


def chunk_of(r: Column, c: Column, tier: str) -> Column:
    """Number of a cell's chunk, south to north and within that west to east."""
    high, wide = CHUNKS[tier]
    across = shape(tier)[1] // wide
    return (F.floor(r / high) * across + F.floor(c / wide)).cast("int")


def chunks_of_box(tier: str, south: float, north: float, west: float, east: float) -> list[int]:
    """Chunks that a box of degrees meets (``west`` beyond ``east``: across the dateline)."""
    (nlat, nlon), (high, wide), res = shape(tier), CHUNKS[tier], float(TIERS[tier])
    row = lambda y: min(max(int((y + 90) // res), 0), nlat - 1) // high
    col = lambda x: min(max(int((x + 180) // res), 0), nlon - 1) // wide
    across = nlon // wide
    columns = [*range(col(west), col(east) + 1)] if west <= east else [*range(col(west), across), *range(col(east) + 1)]
    return sorted({i * across + j for i in range(row(south), row(north) + 1) for j in columns})


def write_chunks(cells: DataFrame, name: str, tier: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Store (r, c, ...) as table ``name`` at ``path``; gives the stored table. One file for each chunk and bucket."""
    cut = cells.withColumn("chunk", chunk_of(F.col("r"), F.col("c"), tier)).repartition(buckets, "r", "c")
    cut.write.mode("overwrite").partitionBy("chunk").bucketBy(buckets, "r", "c").sortBy("r", "c").option("path", path).saveAsTable(name)
    return cells.sparkSession.table(name)


def attach(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The table of an earlier session at ``path``, under ``name``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (chunk) CLUSTERED BY (r, c) SORTED BY (r, c) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def in_box(stored: DataFrame, tier: str, south: float, north: float, west: float, east: float) -> DataFrame:
    """Cells whose centres lie in a box of degrees, from the chunks that it meets."""
    res = float(TIERS[tier])
    lat, lon = (F.col("r") + 0.5) * res - 90, (F.col("c") + 0.5) * res - 180
    across = lon.between(west, east) if west <= east else (lon >= west) | (lon <= east)
    return stored.where(F.col("chunk").isin(chunks_of_box(tier, south, north, west, east))).where(lat.between(south, north) & across)


def chunk_values(stored: DataFrame, value: str = "v") -> DataFrame:
    """(chunk, n, least, most): a row for each chunk."""
    return stored.groupBy("chunk").agg(F.count(value).alias("n"), F.min(value).alias("least"), F.max(value).alias("most"))


def in_range(stored: DataFrame, values: DataFrame, low: float, high: float, value: str = "v") -> DataFrame:
    """Cells with a value between two bounds, from the chunks that can hold one; ``values`` as ``chunk_values`` gives them."""
    some = [x.chunk for x in values.where((F.col("most") >= low) & (F.col("least") <= high)).select("chunk").collect()]  # at most a tier's chunks
    return stored.where(F.col("chunk").isin(some)).where(F.col(value).between(low, high))

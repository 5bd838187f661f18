"""Vector and point tables beside the store: geometry columns, set checks, verbatim copies of folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.grid import wrap_lon
from tessera.sources.copies import copied, files_below
from tessera.sources.readers import SourceMismatch


def point_table(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """``df`` with lon_180 and the point as WKT, both null where a coordinate is missing or off the globe."""
    there = F.col(lat).between(-90, 90) & F.col(lon).isNotNull() & ~F.isnan(lon)
    turned = F.when(there, wrap_lon(F.col(lon)))
    return df.withColumn("lon_180", turned).withColumn("geometry", F.when(there, F.format_string("POINT (%s %s)", turned.cast("string"), F.col(lat).cast("string"))))


def union_sources(parts: dict[str, DataFrame]) -> DataFrame:
    """All rows of several sources with a ``source`` column; a column that one lacks is null there."""
    out = None
    for name, df in parts.items():
        df = df.withColumn("source", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def require_same_keys(a: DataFrame, b: DataFrame, key: str) -> None:
    """Raise unless both tables hold the same keys."""
    lone = a.join(b, key, "left_anti").select(key).union(b.join(a, key, "left_anti").select(key)).limit(5).collect()
    if lone:
        raise SourceMismatch(f"{key} on one side only: {', '.join(str(x[0]) for x in lone)}")


def tree_stats(spark: SparkSession, path: str) -> tuple[int, int]:
    """(files, bytes) under a folder, by Spark's listing; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    got = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    return int(got[0]), int(got[1])


def array_stats(spark: SparkSession, store: str) -> DataFrame:
    """(layer, files, bytes) of a store's data files, summed over tiers."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(store)
    layer = F.regexp_extract(F.col("path"), r"/layer=([^/]+)/", 1)
    return files.select(layer.alias("layer"), "length").groupBy("layer").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def copy_tree(spark: SparkSession, source: str, target: str) -> tuple[int, int]:
    """Copy a folder as it is, its files dealt over tasks, and give its (files, bytes); raises if the copy has others."""
    place = spark._jvm.org.apache.hadoop.fs.Path(target)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        raise SourceMismatch(f"{target} exists")
    copied(files_below(spark, source), target)
    want, got = tree_stats(spark, source), tree_stats(spark, target)
    if want != got:
        raise SourceMismatch(f"copied {got} of {want} files and bytes")
    return got


def code_table(shapes: DataFrame, label: str, codes: dict[str, int]) -> DataFrame:
    """Shapes with the ``code`` of their label; one that the table lacks raises."""
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    out = shapes.withColumn("code", F.try_element_at(table, F.col(label)))
    lone = out.where(F.col(label).isNotNull() & F.col("code").isNull()).select(label).distinct().limit(5).collect()
    if lone:
        raise SourceMismatch(f"no code for {', '.join(str(x[0]) for x in lone)}")
    return out


def write_table(df: DataFrame, path: str) -> int:
    """Write a sidecar as Parquet and give its rows as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()

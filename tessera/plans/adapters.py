"""Deterministic stand-ins for cube sources, made from the driver's tables; each has its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTS_SQL = """SELECT event_id, user_id, event_type, ts, value, CAST((event_id * 7919) % 180001 AS DOUBLE) / 1000 - 90 AS lat,
  CAST((user_id * 104729 + event_id * 613) % 360000 AS DOUBLE) / 1000 - 180 AS lon FROM events"""
RASTER_SQL = """SELECT CAST(l_partkey % 36 AS INT) AS r, CAST(l_orderkey % 72 AS INT) AS c, sum(CAST(l_quantity AS BIGINT)) AS v FROM lineitem GROUP BY 1, 2"""
DENSE_SQL = f"""SELECT CAST(a.range AS INT) AS r, CAST(b.range AS INT) AS c, CAST(coalesce(x.v, 0) AS DOUBLE) AS z
  FROM range(36) a CROSS JOIN range(72) b LEFT JOIN ({RASTER_SQL}) x ON x.r = a.range AND x.c = b.range"""
ZONES_SQL = """SELECT CAST(l_suppkey % 7 AS INT) AS zone, CAST(l_partkey % 36 AS INT) AS r, CAST(l_orderkey % 72 AS INT) AS c,
  min(CAST(round(l_extendedprice * 100) AS BIGINT)) AS dep, CAST(max(l_linenumber) AS INT) AS dip FROM lineitem GROUP BY 1, 2, 3"""
PRIMARY_SQL = """SELECT c_custkey AS id, CAST((c_custkey * 7919) % 180001 AS DOUBLE) / 1000 - 90 AS lat, CAST((c_custkey * 104729) % 360000 AS DOUBLE) / 1000 - 180 AS lon, c_acctbal AS q FROM customer"""
EXTRA_SQL = """SELECT s_suppkey AS id, CAST((s_suppkey * 6007) % 180001 AS DOUBLE) / 1000 - 90 AS lat, CAST((s_suppkey * 50021) % 360000 AS DOUBLE) / 1000 - 180 AS lon, s_acctbal AS q FROM supplier"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat = ((F.col("event_id") * 7919) % 180001).cast("double") / 1000 - 90
    lon = ((F.col("user_id") * 104729 + F.col("event_id") * 613) % 360000).cast("double") / 1000 - 180
    return read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value", lat.alias("lat"), lon.alias("lon"))


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, c = (F.col("l_partkey") % 36).cast("int"), (F.col("l_orderkey") % 72).cast("int")
    return read(spark, sf_dir, "lineitem").groupBy(r.alias("r"), c.alias("c")).agg(F.sum(F.col("l_quantity").cast("long")).alias("v"))


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = spark.range(36 * 72).select((F.col("id") / 72).cast("int").alias("r"), (F.col("id") % 72).cast("int").alias("c"))
    return cells.join(raster(spark, sf_dir), ["r", "c"], "left").select("r", "c", F.coalesce("v", F.lit(0)).cast("double").alias("z"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = [(F.col("l_suppkey") % 7).cast("int").alias("zone"), (F.col("l_partkey") % 36).cast("int").alias("r"), (F.col("l_orderkey") % 72).cast("int").alias("c")]
    return read(spark, sf_dir, "lineitem").groupBy(*key).agg(F.min(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("dep"), F.max("l_linenumber").cast("int").alias("dip"))


def _sites(spark, sf_dir, table, prefix, a, b):
    key = F.col(f"{prefix}key")
    lat, lon = ((key * a) % 180001).cast("double") / 1000 - 90, ((key * b) % 360000).cast("double") / 1000 - 180
    return read(spark, sf_dir, table).select(key.alias("id"), lat.alias("lat"), lon.alias("lon"), F.col(f"{prefix[0]}_acctbal").alias("q"))


def primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sites(spark, sf_dir, "customer", "c_cust", 7919, 104729)


def extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sites(spark, sf_dir, "supplier", "s_supp", 6007, 50021)

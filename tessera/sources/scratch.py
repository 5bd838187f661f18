"""A folder that driver and executors share, for tables that are written and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, or below a local folder where that is unset and all runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = getattr(spark, "_tessera_scratch", None) or "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark._tessera_scratch = folder
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch path and read back: computed once, and safe from lost executors. The table stays for as long as results may read it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` over as many partitions as tasks run at once, twice: for few rows in few files that each make much work."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)

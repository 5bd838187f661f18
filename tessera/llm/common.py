"""Shared plumbing of the training-data operators: tables, the shared folder, Arrow text access."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that the numpy operators hold in work arrays at a time.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or a local one where it is unset and all runs on one machine (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = getattr(spark, "_tessera_shared", None) or "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark._tessera_shared = path
    return path.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors, forgets partitioning.

    The table stays, since results are read from it lazily; the folder is the caller's to empty after a job.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Prefix of working columns that stand beside a caller's.
OWN = "__tessera_"
#: A key with more than this share of the rows is dealt to many tasks; there are fewer than 1 / HOT such keys.
HOT = 0.001


def join_dealt(rows: DataFrame, found: DataFrame, keys: list[str], n: str, how: str = "inner") -> DataFrame:
    """Inner or left join of ``rows`` with one row of ``found`` a key, whose column ``n`` (dropped) is the number of rows that have it.

    Keys with more than HOT of these rows, so fewer than 1 / HOT keys, are
    broadcast; their rows are dealt over all partitions by a hash of the row.
    """
    spark = rows.sparkSession
    total = found.agg(F.sum(n)).first()[0] or 0
    deal = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt, hot = f"{OWN}salt", f"{OWN}hot"
    many = F.broadcast(found.where(F.col(n) > F.lit(HOT * total)).select(*keys, F.lit(True).alias(hot)))
    mine = F.when(F.col(hot), F.pmod(F.hash(*[f"`{c}`" for c in rows.columns]), F.lit(deal))).otherwise(0)
    dealt = rows.join(many, keys, "left").withColumn(salt, mine).drop(hot)
    every = F.when(F.col(n) > F.lit(HOT * total), F.sequence(F.lit(0), F.lit(deal - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(found.withColumn(salt, F.explode(every)).drop(n), [*keys, salt], how).drop(salt)


def named(docs: DataFrame, replaced: dict, dropped: tuple[str, ...] = ()) -> list:
    """A caller's columns, some replaced; what an operator adds takes the place of a column of that name."""
    out = {x.lower() for x in dropped}
    return [replaced[c].alias(c) if c in replaced else docs[f"`{c}`"] for c in docs.columns if c.lower() not in out]


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a null text as the empty one; every other column stays out. A row without a doc_id is no document."""
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


#: Texts longer than this are never kept in a memo, so that entries bound its bytes.
KEPT_LETTERS = 48

#: Caches of a Python worker that outlive a task, and the step that it last ran.
CACHES: list[dict] = []
_step: list[str] = []


def enter(step: str) -> None:
    """A Python worker starts a task (or group) of ``step``: what it kept for another one goes, and freed memory goes back to the system.

    Workers outlive stages, so without this an executor holds the caches of every operator that has run.
    """
    if _step == [step]:
        return
    _step[:] = [step]
    for cache in CACHES:
        cache.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass


def held_out(doc_id) -> "F.Column":
    """Fold 1 of 3 by crc32 of the id as text; its labels are never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n+1 offsets of its rows, without copying to Python strings."""
    column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]] if len(at) else raw[:0], at - (at[0] if len(at) else 0)


def slices(offsets: np.ndarray, size: int = SLICE_BYTES):
    """Ranges of rows of about ``size`` bytes each (a longer row stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))

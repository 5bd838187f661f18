"""Files copied by tasks, piece by piece: what the driver knows of them is a row each, not their bytes."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.readers import SourceMismatch
from tessera.sources.strips import _opened

#: Bytes that a task holds of a file.
PIECE = 4 << 20


def files_below(spark: SparkSession, folder: str) -> DataFrame:
    """(path, inner, length) of all files below a folder, by Spark's listing; inner: the path within it, hidden ones left out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    root = "/" + folder.split(":", 1)[-1].strip("/")
    bare = F.regexp_replace("path", "^[a-z0-9]+:/+", "/")
    return found.select("path", F.substring(bare, len(root) + 2, 1 << 20).alias("inner"), "length")


def _copy(batches):
    for batch in batches:
        done = []
        for source, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            (a, inner), (b, place) = _opened(source), _opened(target)
            b.create_dir(place.rsplit("/", 1)[0], recursive=True)
            part = f"{place.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
            size = 0
            with a.open_input_stream(inner) as read, b.open_output_stream(part) as write:
                while piece := read.read(PIECE):
                    write.write(piece)
                    size += len(piece)
            b.move(part, place)  # a task that runs again replaces the file as a whole
            done.append(size)
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(done, pa.int64())], names=["path", "length"])


def copied(files: DataFrame, target: str) -> tuple[int, int]:
    """Copy (path, inner, length) below ``target`` and give (files, bytes); raises if a copy has another length.

    Files are dealt over all tasks. File systems are those that pyarrow opens:
    local or mounted paths, and the remote ones it knows.
    """
    spark = files.sparkSession
    told = files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.concat(F.lit(target.rstrip("/") + "/"), "inner").alias("target"), "length")
    dealt = told.repartition(max(1, spark.sparkContext.defaultParallelism), "path")
    made = dealt.select("path", "target").mapInArrow(_copy, "path string, length long")
    both = told.select(F.col("target").alias("path"), F.col("length").alias("want")).join(made, "path", "full")
    n, size, wrong = both.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.count_if(~F.col("want").eqNullSafe(F.col("length")))).first()
    if wrong:
        raise SourceMismatch(f"{wrong} of {n} files are not whole copies")
    return int(n), int(size)

"""How large a store's public part will be, and in which form it fits a repository's records."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.sources.sidecars import array_stats
from tessera.sources.store import MASK

# fixed values: what one record of the repository may hold
MAX_FILES = 100
MAX_BYTES = 50 * 10**9


def estimate(spark: SparkSession, store: str, keep: list[str]) -> dict[str, tuple[int, int]]:
    """(files, bytes) of all layers (full) and of the kept ones with their masks (public), by listing; nothing is read or written."""
    wanted = F.col("layer").isin([*keep, *[x + MASK for x in keep]])
    part = lambda x: F.coalesce(F.sum(x), F.lit(0))
    got = array_stats(spark, store).agg(part("files"), part("bytes"), part(F.when(wanted, F.col("files"))), part(F.when(wanted, F.col("bytes")))).first()
    return {"full": (int(got[0]), int(got[1])), "public": (int(got[2]), int(got[3]))}


def packaging(files: int, size: int) -> dict:
    """What goes beyond a record's limits, and the form that fits: the files themselves, one archive, or an archive in ``parts``."""
    over_files, over_bytes = files > MAX_FILES, size > MAX_BYTES
    form = "split archive" if over_bytes else "archive" if over_files else "files"
    return {"files": files, "bytes": size, "over_files": over_files, "over_bytes": over_bytes, "form": form, "parts": max(1, -(-size // MAX_BYTES))}

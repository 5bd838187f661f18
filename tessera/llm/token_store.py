"""Token ids in directly addressable codes (operator 3).

A shard holds the ids of consecutive documents: level by level the low LEVEL_BITS
bits of every id that reaches the level, a bitmap of the ids that continue, and a
directory of ranks. Any token is read from its place by ranks alone; no block is
decoded. Shards are rows of a Parquet table in ascending doc_id order.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import wordbpe
from tessera.llm.common import documents, materialize

LEVEL_BITS = 8
#: Tokens of a full shard, bits of a rank directory's entry, UTF-8 bytes of text dealt to a partition.
SHARD, RANK_BITS, PARTITION_BYTES = 1 << 20, 512, 24 << 20
#: Parts that one task of the prefix sum takes.
GROUP = 1024
_MAGIC = b"DAC1"
_POP = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint32)


def encode(ids: np.ndarray) -> bytes:
    """magic, n, levels; for each level: count, codes, bitmap, rank directory."""
    now, levels = np.asarray(ids, np.uint32), []
    while True:
        more = now >> LEVEL_BITS > 0
        bitmap = np.packbits(more, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(_POP[bitmap], np.arange(0, len(bitmap), RANK_BITS // 8)))]) if len(bitmap) else np.zeros(1)
        levels.append(struct.pack("<I", len(now)) + (now & (1 << LEVEL_BITS) - 1).astype(np.uint8).tobytes() + bitmap.tobytes() + ranks.astype("<u4").tobytes())
        now = now[more] >> LEVEL_BITS
        if not len(now):
            break
    return _MAGIC + struct.pack("<II", len(ids), len(levels)) + b"".join(levels)


class Codes:
    """Random access to the ids of a shard, by views of its bytes."""

    def __init__(self, raw: bytes):
        if raw[:4] != _MAGIC:
            raise ValueError("not a token shard")
        self.n, levels = struct.unpack_from("<II", raw, 4)
        at, self.levels = 12, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<I", raw, at)
            codes = np.frombuffer(raw, np.uint8, n, at + 4)
            bitmap = np.frombuffer(raw, np.uint8, -(-n // 8), at + 4 + n)
            at += 4 + n + len(bitmap)
            ranks = np.frombuffer(raw, "<u4", -(-n // RANK_BITS) + 1, at)
            at += 4 * len(ranks)
            self.levels.append((codes, bitmap, ranks))

    def _rank(self, level: int, i: int) -> int:
        """Continuing ids before place i of a level."""
        _, bitmap, ranks = self.levels[level]
        entry = i // RANK_BITS
        whole = _POP[bitmap[entry * RANK_BITS // 8 : i // 8]].sum()
        part = _POP[bitmap[i // 8] & (1 << i % 8) - 1] if i % 8 else 0
        return int(ranks[entry]) + int(whole) + int(part)

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for k, (codes, bitmap, _) in enumerate(self.levels):
            out |= int(codes[i]) << k * LEVEL_BITS
            if not bitmap[i >> 3] >> (i & 7) & 1:
                return out
            i = self._rank(k, i)
        return out

    def range(self, a: int, b: int) -> np.ndarray:
        """Ids at places a to b, touching what lies there and nothing else."""
        out = np.zeros(b - a, np.uint32)
        where = np.arange(b - a)
        for k, (codes, bitmap, _) in enumerate(self.levels):
            if a == b:
                break
            out[where] |= codes[a:b].astype(np.uint32) << np.uint32(k * LEVEL_BITS)
            more = np.unpackbits(bitmap[a >> 3 : (b + 7) >> 3], bitorder="little")[a & 7 : (a & 7) + b - a].astype(bool)
            where = where[more]
            a = self._rank(k, a)
            b = a + len(where)
        return out


def _write(path: str | None):
    def run(batches):
        from pyspark import TaskContext

        part, bpe = TaskContext.get().partitionId(), wordbpe.load(path)
        end = np.array([wordbpe.END], "<u4").tobytes()
        ids: list[int] = []
        held: list[bytes] = []
        size, start, serial = 0, 0, 0

        def flush():
            nonlocal ids, held, size, start, serial
            tokens = np.frombuffer(b"".join(held), "<u4")
            ends = np.cumsum([len(x) // 4 for x in held])
            row = part, serial, start, len(tokens), np.array(ids, "<i8").tobytes(), ends.astype("<i8").tobytes(), encode(tokens)
            start, serial, ids, held, size = start + len(tokens), serial + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["part", "serial", "start", "n_tokens", "docs", "ends", "codes"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = bpe.encode(text) + end
                ids.append(doc)
                held.append(raw)
                size += len(raw) // 4
                if size >= SHARD:
                    yield flush()
        if ids:
            yield flush()

    return run


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in ascending doc_id order: partitions by range, rows sorted; equal ids lie together, by text."""
    docs = documents(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return docs.repartitionByRange(max(1, -(-size // PARTITION_BYTES)), "doc_id").sortWithinPartitions("doc_id", "text")


def write_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The table of shards: part, serial, start (within the part), n_tokens, docs, ends, codes.

    Null and empty texts are the end id alone. A very long text is one document of
    one shard, however large (a shard ends with a document). Rows of equal doc_id
    (ties) lie together, ordered by text; other columns are ignored; an empty
    table gives no shards.
    """
    kind = "part long, serial long, start long, n_tokens long, docs binary, ends binary, codes binary"
    return materialize(in_order(docs).mapInArrow(_write(path), kind), "tokens")


def part_starts(counts: DataFrame, n: str) -> DataFrame:
    """(part, base): the sum of ``n`` over all parts before, from counts a part.

    A prefix sum in two levels: parts of a group of GROUP in order, and the groups' sums in order.
    """
    parts = materialize(counts.groupBy("part").agg(F.sum(n).alias("n")).withColumn("group", F.floor(F.col("part") / GROUP)), "counts")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    groups = parts.groupBy("group").agg(F.sum("n").alias("n"))
    groups = groups.select("group", F.coalesce(F.sum("n").over(before.orderBy("group")), F.lit(0)).alias("first"))
    inner = parts.select("part", "group", F.coalesce(F.sum("n").over(before.partitionBy("group").orderBy("part")), F.lit(0)).alias("inner"))
    return inner.join(groups, "group").select("part", (F.col("first") + F.col("inner")).alias("base"))


def _read(batches):
    for batch in batches:
        for part, start, docs, ends, codes in zip(*(batch.column(i).to_pylist() for i in range(5))):
            shard = Codes(codes)
            last = np.frombuffer(ends, "<i8")
            first = np.concatenate([[0], last[:-1]])
            crc = [zlib.crc32(shard.range(int(a), int(b)).astype("<u4").tobytes()) for a, b in zip(first, last)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(last), part)), pa.array(np.frombuffer(docs, "<i8")), pa.array(start + first), pa.array(last - first), pa.array(crc, pa.int64())], names=["part", "doc_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the shards; an empty table gives no rows."""
    rows = shards.select("part", "start", "docs", "ends", "codes").mapInArrow(_read, "part long, doc_id long, start long, n_tokens long, ids_crc32 long")
    return rows.join(part_starts(shards, "n_tokens"), "part").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")

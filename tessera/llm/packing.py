"""Order-preserving packing by dynamic programming (operator 6).

Documents lie one after another in ascending doc_id order. Windows of at most
LENGTH tokens are cut at document ends, at sentence ends for a penalty, or, in a
stretch with neither, anywhere for a higher one. The cheapest cuts (padding, cut
penalties, a little for each window) come from a monotone queue: with f the
cheapest cost up to a cut, f(i) + place(i) is what a later cut looks for; windows
of a power of two, which count no padding, are looked up by place. Cuts are the
cheapest within a segment of SEGMENT tokens of a partition (PARTITION_BYTES of
text): a segment's last window is left to the next one, whose programme starts
there, and a partition's last window ends with the partition. So at most one
window in SEGMENT / LENGTH is not chosen with all that follows in view, and one a
partition may be short.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import wordbpe
from tessera.llm.common import enter, materialize
from tessera.llm.token_store import in_order, part_starts

LENGTH = 4096
#: In tokens of padding: a cut at a sentence's end, a cut elsewhere, a window.
SENTENCE_CUT, FORCED_CUT, WINDOW = 8, 64, 256
#: Tokens that are packed at a time; the last window of them goes on to the next.
SEGMENT = 1 << 20
_POWERS = tuple(1 << k for k in range(12))


def padding(n: int, length: int = LENGTH) -> int:
    """Of a sequence of n tokens: up to ``length``, none at a power of two."""
    return 0 if n & n - 1 == 0 else length - n


def cuts(ends: np.ndarray, sentences: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Places where windows may be cut, and the penalty of each."""
    total = int(ends[-1])
    places = np.unique(np.concatenate([[0], sentences, ends]))
    gaps = np.flatnonzero(np.diff(places) > length)
    forced = np.concatenate([np.arange(places[g] + length, places[g + 1], length) for g in gaps] + [np.zeros(0, np.int64)])
    # beyond a forced cut, the rest up to the gap's end may also be aligned from behind
    behind = np.concatenate([np.arange(places[g + 1] - length, places[g], -length) for g in gaps] + [np.zeros(0, np.int64)])
    places = np.unique(np.concatenate([places, forced, behind])).astype(np.int64)
    places = places[(places >= 0) & (places <= total)]
    cost = np.full(len(places), FORCED_CUT)
    cost[np.isin(places, sentences)] = SENTENCE_CUT
    cost[np.isin(places, ends)] = 0
    cost[0] = 0
    return places, cost


def windows(places: np.ndarray, cost: np.ndarray, length: int = LENGTH) -> list[int]:
    """Places of the cheapest cuts, from 0 to the end."""
    at, pen = places.tolist(), cost.tolist()
    n = len(at)
    best, back = [0] * n, [0] * n
    # for each place, the places that lie a power of two or ``length`` before it
    exact: list[list[int]] = [[] for _ in at]
    for k in {*(k for k in _POWERS if k <= length), length}:
        x = np.minimum(np.searchsorted(places, places - k), n - 1)
        for j, i in zip(*(y[places[x] == places - k].tolist() for y in (np.arange(n), x))):
            exact[j].append(i)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (best + place, index), rising
    for j in range(1, n):
        p = at[j]
        low = p - length
        while at[queue[0][1]] < low:
            queue.popleft()
        value, i = queue[0]
        value += length - p
        for x in exact[j]:
            if best[x] < value:
                value, i = best[x], x
        best[j] = value = value + pen[j] + WINDOW
        back[j] = i
        value += p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    out, j = [], n - 1
    while j:
        out.append(at[j])
        j = back[j]
    return [0, *out[::-1]]


def sentence_ids(path: str | None = None) -> np.ndarray:
    """Which ids end a sentence: tokens of punctuation that end in a full stop, question or exclamation mark."""
    vocab = wordbpe.load(path).tokenizer.get_vocab()
    out = np.zeros(max(vocab.values()) + 1, bool)
    for token, i in vocab.items():
        t = token.removesuffix("</w>")
        out[i] = t[-1:] in (".", "!", "?") and not any(c.isalnum() for c in t)
    return out


def pack_segment(docs: list[tuple[int, int, int, bytes]], ends_sentence: np.ndarray, length: int = LENGTH, last: bool = True):
    """docs: (doc_id, start, doc_tokens, id bytes) -> pieces (doc_id, start, length, crc32, doc_tokens, window, offset), windows used, docs left over."""
    tokens = np.frombuffer(b"".join(d[3] for d in docs), "<u4")
    ends = np.cumsum([len(d[3]) // 4 for d in docs])
    stop = np.flatnonzero(ends_sentence[np.minimum(tokens, len(ends_sentence) - 1)] & (tokens < len(ends_sentence))) + 1
    chosen = windows(*cuts(ends, stop, length), length)
    if not last:
        chosen = chosen[:-1]
    used, pieces, d, begin = chosen[-1], [], 0, 0
    for w, (a, b) in enumerate(zip(chosen[:-1], chosen[1:])):
        at = a
        while at < b:
            while ends[d] <= at:
                begin = int(ends[d])
                d += 1
            upto = min(b, int(ends[d]))
            doc, start, total, raw = docs[d]
            pieces.append((doc, start + at - begin, upto - at, zlib.crc32(raw[4 * (at - begin) : 4 * (upto - begin)]), total, w, at - a))
            at = upto
    left = []
    for (doc, start, total, raw), e in zip(docs, ends):
        if e > used:
            skip = max(0, used - (int(e) - len(raw) // 4))
            left.append((doc, start + skip, total, raw[4 * skip :]))
    return pieces, len(chosen) - 1, left


def _pack(path: str | None, length: int):
    def run(batches):
        from pyspark import TaskContext

        enter("packing")
        part, bpe, stops = TaskContext.get().partitionId(), wordbpe.load(path), sentence_ids(path)
        end = np.array([wordbpe.END], "<u4").tobytes()
        held: list[tuple[int, int, int, bytes]] = []
        size = serial = 0

        def flush(last: bool):
            nonlocal held, size, serial
            pieces, n, held = pack_segment(held, stops, length, last)
            size = sum(len(d[3]) // 4 for d in held)
            rows = [(part, *p[:5], serial + p[5], p[6]) for p in pieces]
            serial += n
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["part", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "window", "offset"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = bpe.encode(text) + end
                held.append((doc, 0, len(raw) // 4, raw))
                size += len(raw) // 4
                if size >= SEGMENT:
                    yield flush(False)
        if held:
            yield flush(True)

    return run


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are their end id alone. A very long text is cut into
    pieces; its ids are in memory at once. Rows of equal doc_id (ties) follow one
    another, ordered by text; of cuts that cost the same the earliest found wins.
    Other columns are ignored; an empty table gives no rows. Sequence ids go on
    from one partition to the next.
    """
    kind = "part long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, offset long"
    packed = materialize(in_order(docs).mapInArrow(_pack(path, length), kind), "packed")
    base = part_starts(packed.groupBy("part").agg((F.max("window") + 1).alias("n")), "n")
    return packed.join(base, "part").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("window")).alias("sequence_id"), "offset")

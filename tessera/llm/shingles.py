"""64-bit hashes of 5-word shingles, vectorised over the bytes of many documents."""

from __future__ import annotations

import numpy as np

from tessera.llm.common import mix

WORDS = 5
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER += np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.array([mix(np.array([i + 1], np.uint64))[0] | np.uint64(1) for i in range(WORDS)], np.uint64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of them."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n + n // 4, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def word_spans(data: np.ndarray, offsets: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words ``[^\\x20\\x09-\\x0D]+`` of all rows; a word ends behind a byte that ``cut`` marks, too."""
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = edge[:-1].copy()
    before[1:] |= space[:-1]
    after = edge[1:].copy()
    after[:-1] |= space[1:]
    if cut is not None:
        ends = cut[data]
        before[1:] |= ends[:-1]
        after |= ends
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the bytes between starts and ends, A-Z lower-cased."""
    # words at equal byte values hash alike wherever they stand: the prefix sum's difference is shifted back to exponent 0
    power, inverse = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def shingle_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every shingle in order; A-Z are lower-cased; a row of fewer than five words has one shingle, an empty row none."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts, ends, row = word_spans(data, offsets)
    word = word_hashes(data, starts, ends)
    n = len(word)
    count = np.bincount(row, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(count)])
    out_row, out = [], []
    if n >= WORDS:
        whole = row[: n - WORDS + 1] == row[WORDS - 1 :]
        at = np.flatnonzero(whole)
        h = np.zeros(len(at), np.uint64)
        for k in range(WORDS):
            h += word[at + k] * _STEP[k]
        out_row.append(row[at])
        out.append(h)
    short = np.flatnonzero((count > 0) & (count < WORDS))
    if len(short):
        h = count[short].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(WORDS - 1):
            more = count[short] > k
            h[more] += word[first[short[more]] + k] * _STEP[k]
        out_row.append(short)
        out.append(h)
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rows = np.concatenate(out_row)
    hashes = mix(np.concatenate(out))
    if len(short) and len(out) > 1:
        order = np.argsort(rows, kind="stable")
        rows, hashes = rows[order], hashes[order]
    return rows, hashes


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    rows, hashes = shingle_rows(data, offsets)
    cuts = np.searchsorted(rows, np.arange(len(offsets)))
    return [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]

"""Media columns: GIF (operator 4).

``encode_gif`` stores bytes losslessly as an animated GIF: a grey palette of 256
colours, frames of WIDTH x up to ROWS pixels, variable-width LZW. ``decode_gif``
reads any GIF87a/89a: logical screen, global and local palettes, interlace,
graphic control (delay, disposal, transparency), and composes each timed frame.
``gif_frames`` gives a table of frames with their times, rules and histograms.
What is no whole GIF raises ValueError in ``decode_gif``; the tables name the
fault in a column of the file's row instead and go on.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import documents, materialize

#: Pixels of a row, rows of a full frame, hundredths of a second of a frame.
WIDTH, ROWS, DELAY = 64, 256, 10
_BITS, _LIMIT = 8, 4096
_GREY = bytes(np.repeat(np.arange(256, dtype=np.uint8), 3))
_HEAD = b"GIF89a" + WIDTH.to_bytes(2, "little")


def _widths(n: int, bits: int) -> np.ndarray:
    """Code widths of the n codes after a clear code: the decoder's table is one entry behind."""
    size = (1 << bits) + 1 + np.arange(n)
    return np.minimum(12, np.floor(np.log2(np.maximum(size, 1))).astype(np.int64) + 1)


_SCHEDULE = {b: _widths(_LIMIT + 8, b) for b in range(2, 9)}
_OFFSETS = {b: np.concatenate([[0], np.cumsum(w)]) for b, w in _SCHEDULE.items()}


def lzw_encode(data: bytes) -> bytes:
    """LZW codes of 8-bit pixels, packed; the table is cleared when it is full."""
    clear, end = 256, 257
    runs: list[list[int]] = []
    codes: list[int] = []
    add = codes.append
    table: dict[int, int] = {}
    get = table.get
    free = 258
    w = data[0]
    for b in data[1:]:
        k = w << 8 | b
        n = get(k)
        if n is None:
            add(w)
            if free < _LIMIT:
                table[k] = free
                free += 1
            else:
                runs.append(codes)
                codes = []
                add = codes.append
                table.clear()
                free = 258
            w = b
        else:
            w = n
    add(w)
    runs.append(codes)
    values, widths = [np.array([clear])], [np.array([9])]
    for i, run in enumerate(runs):
        follow = end if i == len(runs) - 1 else clear
        values.append(np.array([*run, follow]))
        widths.append(_SCHEDULE[8][: len(run) + 1])
    value, width = np.concatenate(values), np.concatenate(widths)
    at = np.concatenate([[0], np.cumsum(width)])
    bits = np.zeros(at[-1], np.uint8)
    for j in range(12):
        some = slice(None) if j < 9 else np.flatnonzero(width > j)
        bits[at[:-1][some] + j] = value[some] >> j & 1
    return np.packbits(bits, bitorder="little").tobytes()


def lzw_decode(packed: bytes, bits: int, size: int) -> bytes:
    """Pixels of a code stream with ``bits`` bits a pixel, at most ``size``.

    Within a run without clear codes, the widths and each entry's place in the
    output follow from the code's number: entry k repeats the output of code k
    and the byte after it.
    """
    if not 2 <= bits <= 8:
        raise ValueError(f"code size {bits}")
    clear, end = 1 << bits, (1 << bits) + 1
    raw = np.frombuffer(packed + b"\0\0\0\0", np.uint8).astype(np.uint32)
    total, at = len(packed) * 8, 0
    out = bytearray()
    schedule, offsets = _SCHEDULE[bits], _OFFSETS[bits]
    base = end + 1
    literal = [bytes([i]) for i in range(clear)]
    while at < total and len(out) < size:
        n = int(np.searchsorted(offsets, total - at, "right")) - 1
        pos = at + offsets[:n]
        byte = pos >> 3
        word = raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16
        code = word >> (pos & 7).astype(np.uint32) & ((1 << schedule[:n]) - 1).astype(np.uint32)
        stops = np.flatnonzero((code == clear) | (code == end))
        if len(stops):
            n = int(stops[0])
            at += int(offsets[n + 1])
        elif n >= len(schedule):  # a full table that is not cleared: 12-bit codes go on
            code = np.concatenate([code, _late(raw, at + int(offsets[n]), total, clear, end)])
            stops = np.flatnonzero((code == clear) | (code == end))
            n = int(stops[0]) if len(stops) else len(code)
            at += int(offsets[len(schedule)]) + 12 * (n + 1 - len(schedule))
        else:
            at = total
        starts: list[int] = []
        begin = starts.append
        here = len(out)
        lengths: list[int] = []
        known = lengths.append
        for c in code[:n].tolist():
            begin(here)
            if c < clear:
                out += literal[c]
                known(1)
                here += 1
            else:
                k = c - base
                if not 0 <= k < len(lengths):
                    raise ValueError(f"code {c} before its entry")
                a = starts[k]
                m = lengths[k] + 1
                if a + m > here:  # the entry that this very code completes
                    out += out[a:here]
                    out.append(out[a])
                else:
                    out += out[a : a + m]
                known(m)
                here += m
        if len(stops) and code[n] == end:
            break
    return bytes(out[:size])


def _late(raw: np.ndarray, at: int, total: int, clear: int, end: int) -> np.ndarray:
    pos = np.arange(at, total - 11, 12)
    byte = pos >> 3
    code = (raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16) >> (pos & 7).astype(np.uint32) & 0xFFF
    stops = np.flatnonzero((code == clear) | (code == end))
    return code[: int(stops[0]) + 1] if len(stops) else code


def encode_gif(payload: bytes) -> bytes:
    """An animated GIF whose frames' pixels, one after another, are the payload (a positive multiple of WIDTH bytes)."""
    rows = len(payload) // WIDTH
    out = [_HEAD, min(rows, ROWS).to_bytes(2, "little"), b"\xf7\0\0", _GREY]
    for a in range(0, len(payload), WIDTH * ROWS):
        part = payload[a : a + WIDTH * ROWS]
        out += [b"\x21\xf9\x04\x04", DELAY.to_bytes(2, "little"), b"\0\0", b"\x2c\0\0\0\0", WIDTH.to_bytes(2, "little"), (len(part) // WIDTH).to_bytes(2, "little"), b"\0\x08"]
        packed = lzw_encode(part)
        for i in range(0, len(packed), 255):
            block = packed[i : i + 255]
            out += [bytes([len(block)]), block]
        out.append(b"\0")
    return b"".join([*out, b"\x3b"])


#: Pixels of a screen at most, and of all frames' screens beyond twice the pixels that the frames draw.
LARGEST = 1 << 24


def _blocks(raw: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while raw[at]:
        if at + raw[at] >= len(raw):
            raise ValueError("cut off in a block")
        parts.append(raw[at + 1 : at + 1 + raw[at]])
        at += 1 + raw[at]
    return b"".join(parts), at + 1


def decode_gif(raw: bytes, compose: bool = True) -> list[dict]:
    """Frames of a GIF: index (h, w uint8), palette (n, 3), place, delay, disposal, transparent, and image, the composed RGB screen.

    ValueError for what is no whole GIF: another signature, a file cut off, an
    unknown block, a code that no entry stands for, an image without a palette, and
    for screens that would take far more memory than the frames' own pixels.
    """
    try:
        return _decode(raw, compose)
    except IndexError:
        raise ValueError("cut off") from None


def _decode(raw: bytes, compose: bool) -> list[dict]:
    if raw[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = int.from_bytes(raw[6:8], "little"), int.from_bytes(raw[8:10], "little"), raw[10]
    at, palette = 13, None
    if flags & 0x80:
        n = 3 << (flags & 7) + 1
        palette, at = np.frombuffer(raw, np.uint8, n, at).reshape(-1, 3), at + n
    if compose and width * height > LARGEST:
        raise ValueError(f"a screen of {width} x {height}")
    screen = np.zeros((height, width, 3), np.uint8) if compose else None
    control, frames, drawn = (0, 0, None), [], 0
    while raw[at] != 0x3B:
        kind = raw[at]
        if kind == 0x21:
            body, after = _blocks(raw, at + 2)
            if raw[at + 1] == 0xF9:
                control = int.from_bytes(body[1:3], "little"), body[0] >> 2 & 7, body[3] if body[0] & 1 else None
            at = after
            continue
        if kind != 0x2C:
            raise ValueError(f"unknown block {kind:#x}")
        x, y, w, h = (int.from_bytes(raw[at + 1 + 2 * i : at + 3 + 2 * i], "little") for i in range(4))
        own, at = raw[at + 9], at + 10
        colours = palette
        if own & 0x80:
            n = 3 << (own & 7) + 1
            colours, at = np.frombuffer(raw, np.uint8, n, at).reshape(-1, 3), at + n
        packed, after = _blocks(raw, at + 1)
        if colours is None:
            raise ValueError("no palette")
        pixels = lzw_decode(packed, raw[at], w * h)
        if len(pixels) < w * h:
            raise ValueError(f"{len(pixels)} of {w * h} pixels")
        drawn += w * h
        if compose and (len(frames) + 1) * width * height > LARGEST + 2 * drawn:
            raise ValueError("screens beyond what its frames draw")
        index = np.frombuffer(pixels, np.uint8).reshape(h, w)
        if own & 0x40:
            order = np.concatenate([np.arange(a, h, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])
            index = index[np.argsort(order)]
        at = after
        delay, disposal, clear = control
        frame = {"index": index, "palette": colours, "place": (x, y, w, h), "delay": delay, "disposal": disposal, "transparent": clear}
        if compose:
            before = screen.copy() if disposal == 3 else None
            part = screen[y : y + h, x : x + w]
            seen = colours[np.minimum(index, len(colours) - 1)][: part.shape[0], : part.shape[1]]
            if clear is None:
                part[:] = seen
            else:
                np.copyto(part, seen, where=(index != clear)[: part.shape[0], : part.shape[1], None])
            frame["image"] = screen.copy()
            if disposal == 2:
                part[:] = 0
            elif disposal == 3:
                screen = before
        frames.append(frame)
        control = (0, 0, None)
    return frames


def gif_payload(frames: list[dict]) -> bytes:
    """The pixels' red values, frame after frame: what encode_gif was given."""
    return b"".join(np.ascontiguousarray(f["image"][f["place"][1] : f["place"][1] + f["place"][3], f["place"][0] : f["place"][0] + f["place"][2], 0]).tobytes() for f in frames)


def histogram(frame: dict) -> np.ndarray:
    """(3, 16): pixels of the frame's place, as composed, by channel and 16 levels."""
    x, y, w, h = frame["place"]
    levels = frame["image"][y : y + h, x : x + w].reshape(-1, 3) >> 4
    return np.stack([np.bincount(levels[:, c], minlength=16) for c in range(3)])


def gif_feature(frames: list[dict]) -> str:
    """Frame count, duration and the colour histogram of all frames: 16 levels, once for grey, else for red, green and blue."""
    bins = sum((histogram(f) for f in frames), np.zeros((3, 16), np.int64))
    grey = (bins[0] == bins[1]).all() and (bins[0] == bins[2]).all()
    return f"{len(frames)}f {sum(f['delay'] for f in frames)}cs {';'.join(','.join(map(str, b)) for b in bins[: 1 if grey else 3])} top{int(bins[0].argmax())}"


def payload_of(text: str) -> tuple[int, bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes(-len(raw) % 64 or (0 if raw else 64))


def _store(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            made = [(n, encode_gif(p)) for n, p in map(payload_of, part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([g for _, g in made], pa.binary())], names=["doc_id", "n_bytes", "gif"])


def _opened(gif: bytes | None) -> tuple[list[dict], str | None]:
    """Frames, or none and why."""
    try:
        return decode_gif(gif or b""), None
    except ValueError as fault:
        return [], str(fault)


def _read(batches):
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_frames", "fault"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    for batch in batches:
        rows = []
        for doc, n, gif in zip(*(batch.column(i).to_pylist() for i in range(3))):
            frames, fault = _opened(gif)
            media = (len(gif), hashlib.sha256(gif).hexdigest()) if gif is not None else (None, None)
            if fault:
                rows.append((doc, n, None, None, None, *media, None, None, fault))
                continue
            payload = gif_payload(frames)
            rows.append((doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *media, gif_feature(frames), len(frames), None))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)


def _frames(batches):
    names = ["doc_id", "frame", "starts_cs", "delay_cs", "disposal", "transparent", "x", "y", "width", "height", "n_colours", "red", "green", "blue"]
    for batch in batches:
        for doc, gif in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows, at = [], 0
            for k, f in enumerate(_opened(gif)[0]):
                rows.append((doc, k, at, f["delay"], f["disposal"], f["transparent"], *f["place"], len(f["palette"]), *histogram(f).tolist()))
                at += f["delay"]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.int64()) if i > 10 else pa.int64()) for i, x in enumerate(zip(*rows))], names=names)


def gif_column(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, gif): each text's UTF-8 bytes, padded to a positive multiple of 64, as a GIF.

    Null texts are empty. A very long text is one GIF of many frames, whole in its
    row. Equal texts (ties) give equal GIFs; other columns are ignored; an empty
    table gives no rows.
    """
    return documents(docs).mapInArrow(_store, "doc_id long, n_bytes long, gif binary")


def gif_features(stored: DataFrame) -> DataFrame:
    """What the stored GIFs hold: payload and media digests, histogram feature and frame count of each row; fault: why one is no whole GIF, its other values being null."""
    kind = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long, fault string"
    return stored.select("doc_id", "n_bytes", "gif").mapInArrow(_read, kind)


def gif_frames(stored: DataFrame) -> DataFrame:
    """A row for each frame of (doc_id, gif): when it starts and how long it stays, how it goes, its place, and 16 levels of each colour. No rows of what is no whole GIF."""
    kind = "doc_id long, frame long, starts_cs long, delay_cs long, disposal long, transparent long, x long, y long, width long, height long, n_colours long, red array<long>, green array<long>, blue array<long>"
    return stored.select("doc_id", "gif").mapInArrow(_frames, kind)


def stored_and_read(docs: DataFrame) -> DataFrame:
    """Write the GIF column to the shared folder, read it back, compute features. One row for each row; equal texts give equal values."""
    return gif_features(materialize(gif_column(docs), "gif"))

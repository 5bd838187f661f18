"""Quality classifier: a byte-level convolutional network in numpy (operator 7).

Bytes are embedded; learned filters of WIDTH bytes run over the whole document
every STRIDE bytes; the responses are max-pooled over overlapping chunks of
CHUNK positions; chunk vectors are combined, as mean and as maximum, into one
logit. A text of any length is scored in whole, chunk by chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import documents, enter, held_out, text_bytes

EMBED, WIDTH, STRIDE, FILTERS = 8, 8, 4, 16
#: Positions of a pooled chunk; half of them belong to the next chunk too.
CHUNK = 64
#: Labelled rows that the classifier is fitted on at most, for each label, and bytes of their texts, which are taken whole.
SAMPLE, LONGEST = 1000, 200_000
EPOCHS, BATCH, RATE, SEED = 8, 16, 0.005, 7
#: Share of training texts that come once more, cut to a few words, so that short texts are no surprise; bytes of these.
SHORT_SHARE, SHORT_BYTES = 0.25, 120
THRESHOLD = 0.5
#: Positions scored at a time: a multiple of half a chunk.
_ROWS = 1 << 16


def initial(rng) -> dict[str, np.ndarray]:
    draw = lambda *s: rng.normal(0, 1, s).astype(np.float32)
    return {"E": draw(257, EMBED) * 0.5, "W": draw(WIDTH * EMBED, FILTERS) * (WIDTH * EMBED) ** -0.5, "b": np.zeros(FILTERS, np.float32), "v": draw(2 * FILTERS) * 0.1, "c": np.zeros(1, np.float32)}


def _positions(n: int) -> int:
    """Filter positions of n bytes: the last one reaches the end."""
    return max(1, -(-(n - WIDTH) // STRIDE) + 1)


def _chunks(positions: int) -> np.ndarray:
    """Starts of the overlapping chunks; the last one covers what is left."""
    return np.arange(0, max(1, positions - CHUNK // 2), CHUNK // 2)


def _codes(data: np.ndarray) -> np.ndarray:
    """Byte codes up to the last position's end; 256 stands for what lies beyond the text."""
    out = np.full((_positions(len(data)) - 1) * STRIDE + WIDTH, 256, np.int16)
    out[: len(data)] = data
    return out


def _halves(data: np.ndarray, net: dict) -> tuple[np.ndarray, np.ndarray]:
    """Of each half chunk the greatest response of every filter, and its position; _ROWS positions at a time."""
    p, full, half = _positions(len(data)), _codes(data), CHUNK // 2
    top, where = [], []
    for a in range(0, p, _ROWS):
        b = min(p, a + _ROWS)
        e = net["E"][full[a * STRIDE : (b - 1) * STRIDE + WIDTH]]
        r = np.lib.stride_tricks.as_strided(e, (b - a, WIDTH * EMBED), (STRIDE * e.strides[0], e.strides[1])) @ net["W"]
        whole = (b - a) // half * half
        blocks = [r[:whole].reshape(-1, half, FILTERS)] if whole else []
        if whole < b - a:
            blocks.append(r[None, whole:])
        at = a
        for block in blocks:
            arg = block.argmax(1)
            top.append(np.take_along_axis(block, arg[:, None], 1)[:, 0])
            where.append(arg + at + half * np.arange(len(block))[:, None])
            at += whole
    return np.concatenate(top), np.concatenate(where)


def _pool(data: np.ndarray, net: dict, places: bool = False):
    """Chunk maxima of the responses, and where they are."""
    top, where = _halves(data, net)
    k = len(_chunks(_positions(len(data))))
    if k == len(top):
        return (top, where) if places else top
    if not places:
        return np.maximum(top[:k], top[1 : k + 1])
    later = top[1 : k + 1] > top[:k]
    return np.where(later, top[1 : k + 1], top[:k]), np.where(later, where[1 : k + 1], where[:k])


def logit(data: np.ndarray, net: dict) -> float:
    """Of one text's bytes (all of them); an empty text has one window beyond its end."""
    h = np.maximum(_pool(data, net) + net["b"], 0)
    return float(np.concatenate([h.mean(0), h.max(0)]) @ net["v"] + net["c"][0])


def _gradient(data: np.ndarray, label: float, weight: float, net: dict, grad: dict) -> None:
    """Adds one text's gradient of the weighted logistic loss."""
    r, arg = _pool(data, net, places=True)
    z = r + net["b"]
    h = np.maximum(z, 0)
    top = h.argmax(0)
    pooled = np.concatenate([h.mean(0), h.max(0)])
    p = 1 / (1 + np.exp(-np.clip(pooled @ net["v"] + net["c"][0], -30, 30)))
    d = np.float32((p - label) * weight)
    grad["v"] += d * pooled
    grad["c"] += d
    dh = np.tile(d * net["v"][:FILTERS] / len(h), (len(h), 1))
    dh[top, np.arange(FILTERS)] += d * net["v"][FILTERS:]
    dh *= z > 0
    grad["b"] += dh.sum(0)
    full = _codes(data)
    for a in range(0, len(arg), _ROWS // FILTERS):
        used, place = np.unique(arg[a : a + _ROWS // FILTERS], return_inverse=True)
        dr = np.zeros((len(used), FILTERS), np.float32)
        np.add.at(dr, (place.ravel(), np.tile(np.arange(FILTERS), len(place.ravel()) // FILTERS)), dh[a : a + _ROWS // FILTERS].ravel())
        codes = full[used[:, None] * STRIDE + np.arange(WIDTH)]
        grad["W"] += net["E"][codes].reshape(len(used), -1).T @ dr
        np.add.at(grad["E"], codes.ravel(), (dr @ net["W"].T).reshape(-1, EMBED))


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Adam on the logistic loss, classes weighted alike, over whole texts; some come once more as a short stretch."""
    rng = np.random.default_rng(seed)
    net = initial(rng)
    m = {k: np.zeros_like(x) for k, x in net.items()}
    s = {k: np.zeros_like(x) for k, x in net.items()}
    share = np.clip(labels.mean(), 0.01, 0.99)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            grad = {k: np.zeros_like(x) for k, x in net.items()}
            some = order[lo : lo + BATCH]
            for i in some:
                data = np.frombuffer(texts[i], np.uint8)
                _gradient(data, labels[i], weight[i] / len(some), net, grad)
                if rng.random() < SHORT_SHARE:
                    at = int(rng.integers(0, max(1, len(data) - SHORT_BYTES + 1)))
                    _gradient(data[at : at + int(rng.integers(4, SHORT_BYTES))], labels[i], weight[i] / len(some), net, grad)
            step += 1
            rate = RATE * (1 - 0.9 * epoch / epochs)
            for k in net:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                s[k] = 0.999 * s[k] + 0.001 * grad[k] ** 2
                net[k] = net[k] - (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int | tuple[int, int]) -> tuple[list[str], np.ndarray]:
    """At most ``sample`` rows of each label (or so many of label 0, of label 1) with texts of LONGEST bytes or less, the first by a hash of the id; never of the held-out fold.

    Both bounds hold for rows, however often ids are repeated in either table; so
    the driver never gets more than their product in bytes.
    """
    marked = labels.where(~held_out(F.col("doc_id")) & F.col(label).isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).distinct()
    bounds = sample if isinstance(sample, tuple) else (sample, sample)
    short = docs.where(F.octet_length("text") <= LONGEST)
    rows = []
    for y, n in enumerate(bounds):
        picked = marked.where(f"y = {y}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)  # as many ids at most
        rows += short.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "y").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(n).collect()
    rows.sort(key=lambda r: (r.doc_id, r.y, r.text))
    return [r.text for r in rows], np.array([r.y for r in rows], np.float32)


def _score(net: dict, threshold: float):
    def run(batches):
        enter("quality")
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            z = np.array([logit(data[a:b], net) for a, b in zip(offsets[:-1], offsets[1:])], np.float64)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return run


def network(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Fitted on at most ``sample`` labelled rows of each label; untrained without a row of each."""
    texts, y = training_rows(documents(docs), labels, "quality", sample)
    return fit([t.encode() for t in texts], y) if len(set(y.tolist())) == 2 else initial(np.random.default_rng(SEED))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose whole text scores ``threshold`` or more."""
    net, least = network(docs, labels, sample), float(np.log(threshold / (1 - threshold)))

    def run(batches):
        enter("quality")
        for batch in batches:
            data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
            yield batch.filter(pa.array([logit(data[a:b], net) >= least for a, b in zip(offsets[:-1], offsets[1:])], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Null and empty texts are scored as no bytes, a very long text in blocks of
    positions. The fit takes at most ``sample`` labelled rows of each label, whole,
    its one bound; without a row of each label every score is the untrained
    network's. A score of just ``threshold`` (a tie) is predicted 1. Ids repeated in
    ``docs`` are scored row by row; other columns are no inputs. An empty table
    gives no rows.
    """
    net = network(docs, labels, sample)
    docs = documents(docs)
    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(_score(net, threshold), "doc_id long, held_out boolean, score double, predicted int")

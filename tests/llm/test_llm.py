"""The training-data operators against brute force, round trips and held-out accuracy, with the odd rows each must take."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from tessera.llm import byte_cnn, gif_media, line_dedup, packing, piece_codec, quality_rules, substring_dedup, token_store, toxicity, wordbpe
from tessera.llm.components import components
from tessera.llm.jaccard_join import adaptive_links, jaccard_groups

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
LONG = " ".join(f"w{i % 977}x{i}" for i in range(20000))
PASSAGE = "Here " + " ".join(f"passage{i}" for i in range(60)) + "."
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, "One  TWO"), (7, LONG), (8, LONG + " tail"), (9, LONG), (9, LONG),
    (10, "First line here.\nSecond line there.\nThird."), (11, "Intro of eleven.\nFirst line here.\nSecond line there.\nThird."), (12, "x" * 5000), (13, "日本語 😀 ï\r\nß"),
    (14, "Some own words come first " + PASSAGE + " and then some more"), (15, "Quite other words begin here " + PASSAGE + " with another end"), (16, PASSAGE),
    (17, " ".join("a b c".split() * 30)), (18, "One.\n\nTwo.\n \nThree.\nFour."), (19, "One.\nTwo.\nThree.\n\n\nFour."), (20, "Same.\n" * 40), (21, "Same.\n" * 41), (None, "no id"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s", "kept", i) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_lines string, `a.b` long")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def empty(spark, odd):
    return odd.where("false")


def sets(rows):
    out = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def brute_groups(s):
    top = {i: i for i in s}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(s)
    for a in ids:
        for b in ids:
            if a < b and s[a] and s[b] and find(a) != find(b):
                o = len(s[a] & s[b])
                if 100 * o >= 75 * (len(s[a]) + len(s[b]) - o):
                    x, y = sorted((find(a), find(b)))
                    top[y] = x
    return {i: find(i) for i in s}


@pytest.mark.parametrize("which", ["docs", "odd", "empty"])
def test_jaccard(which, request):
    df = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text) for r in df.collect() if r.doc_id is not None]
    s = sets(rows)
    want = {i: (len(s[i]), g) for i, g in brute_groups(s).items()}
    got = jaccard_groups(df).collect()
    assert len(got) == len(rows) and {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_adaptive_links():
    rng = np.random.default_rng(5)
    for _ in range(40):
        base = [rng.choice(400, 60, replace=False) for _ in range(3)]
        s = [frozenset(rng.permutation(base[i % 3])[: rng.integers(40, 60)].tolist()) | frozenset(rng.integers(1000, 9999, rng.integers(0, 12)).tolist()) for i in range(30)]
        n, t = [len(x) for x in s], [np.array(sorted(x), np.int64) for x in s]
        link = lambda a, b: 100 * len(a & b) >= 75 * len(a | b)
        assert sorted(adaptive_links(n, t)) == [(i, j) for i in range(30) for j in range(i + 1, 30) if link(s[i], s[j])]
        assert sorted(adaptive_links(n[:10], t[:10], n[10:], t[10:])) == [(i, j) for i in range(10) for j in range(20) if link(s[i], s[10 + j])]


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    top = {x: x for e in edges for x in e}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        top[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    joined = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in joined}


def test_quality_rules(spark, docs, odd, empty):
    for df in (docs, odd, empty):
        got = quality_rules.quality_rules(df).collect()
        rows = df.collect()
        assert len(got) == len(rows)
        want = collections.Counter()
        for r in rows:
            t = r.text or ""
            w = WORD.findall(t)
            c = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
            cover = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
            lines = [x for x in t.split("\n") if WORD.search(x)]
            want[r.doc_id, len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w)] += 1
        assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want


def brute_lines(rows):
    seen, out = set(), {}
    for i, t in sorted(set(rows)):
        lines = t.split("\n")
        at = [k for k, x in enumerate(lines) if WORD.search(x)]
        h = [0, 0, *(int(hashlib.md5(lines[k].encode()).hexdigest()[:7], 16) for k in at)]
        marks = [((h[k + 2] * line_dedup.BASE + h[k + 1]) * line_dedup.BASE + h[k]) % line_dedup.MODULUS % line_dedup.ONE_IN == 0 for k in range(len(at))]
        start, gone = 0, set()
        for k in range(len(at)):
            if k == len(at) - 1 or (0 < k < len(at) - 2 and marks[k] and not (k > 1 and marks[k - 1])):
                body = "\n".join(lines[x] for x in at[start : k + 1])
                if k > start:
                    if body in seen:
                        gone.update(range(at[start], at[k] + 1))
                    seen.add(body)
                start = k + 1
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone)
    return out


def test_line_dedup_of_copies(spark):
    """Whole copies go but for nothing, however many of their lines are equal; a shared run goes but for its edges."""
    same = "\n".join(["Head line one.", "Second line.", *["Equal line."] * 6, "Last line."])
    shared = [f"Shared line number {k}." for k in range(30)]
    texts = [same, same, same, "\n".join(["Own a.", "Own b.", *shared, "End a."]), "\n".join(["Other c.", *shared, "End d.", "End e.", "End f."]), "\n\n".join(shared)]
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0] == same and got[1] == got[2] == "" and got[3] == texts[3]
    assert sum(x in got[4] for x in shared) <= 6 and sum(x in got[5] for x in shared) <= 6 and all(x in got[4] for x in ("Other c.", "End d.", "End f."))


@pytest.mark.parametrize("which", ["docs", "odd", "empty"])
def test_line_dedup(which, request):
    df = request.getfixturevalue(which)
    got = line_dedup.line_dedup(df)
    assert [c for c in df.columns if c != "n_lines"] + ["n_lines", "n_removed_lines"] == got.columns
    want = brute_lines([(r.doc_id, r.text) for r in df.collect() if r.doc_id is not None and r.text is not None])
    rows = got.collect()
    assert len(rows) == df.count()
    for r in rows:
        if r.doc_id is not None and r.text is not None:
            assert (r.text, r.n_lines, r.n_removed_lines) == want[r.doc_id]


def test_substring_dedup(odd, empty, docs):
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(odd).collect()}
    texts = dict(ODD)
    assert got[14].text == texts[14] and "passage7" not in got[15].text and "another end" in got[15].text and got[16].text == ""
    assert got[1].text is None and got[2].text == "" and got[None].text == "no id" and got[15].removed[0].source == 14
    for i, r in got.items():
        t, at, kept = texts[i], 0, ""
        for s in r.removed:
            kept, at = kept + t[at : s.start], s.end
        assert t is None or kept + t[at:] == r.text
    assert substring_dedup.substring_dedup(empty).count() == 0
    cleaned = substring_dedup.substring_dedup(docs).collect()
    assert len(cleaned) == docs.count()
    where = collections.defaultdict(set)
    for r in cleaned:
        w = r.text.lower().split()
        for k in range(len(w) - 49):
            where[tuple(w[k : k + 50])].add(r.doc_id)
    assert sum(len(x) > 1 for x in where.values()) < 0.002 * len(where)


def test_tokens_and_packing(odd, empty, docs):
    bpe = wordbpe.load()
    lib = lambda t: bpe.tokenizer.encode(t or "", add_special_tokens=False).ids + [wordbpe.END]
    for df in (docs, odd):
        rows = sorted(((r.doc_id, r.text or "") for r in df.collect() if r.doc_id is not None))
        got = sorted(map(tuple, token_store.read_tokens(token_store.write_tokens(df)).collect()))
        start, want, by = 0, [], {}
        for i, t in rows:
            ids = lib(t)
            want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            by[i] = ids
            start += len(ids)
        assert [x[:1] + x[2:] for x in got] == [x[:1] + x[2:] for x in want] and [x[1] for x in got] == [x[1] for x in want]
        pieces = packing.pack(df).collect()
        fill, seen = collections.defaultdict(list), collections.Counter()
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(np.array(by[p.doc_id][p.start : p.start + p.length], "<u4").tobytes()) and p.doc_tokens == len(by[p.doc_id])
            fill[p.sequence_id].append((p.offset, p.length))
            seen[p.doc_id] += p.length
        assert sorted(fill) == list(range(len(fill))) and seen == collections.Counter({i: len(by[i]) * sum(r[0] == i for r in rows) for i in by})
        for f in fill.values():
            at = 0
            for o, n in sorted(f):
                assert o == at
                at += n
            assert at <= packing.LENGTH
    assert token_store.read_tokens(token_store.write_tokens(empty)).count() == 0 and packing.pack(empty).count() == 0


def test_prefix_sums(spark):
    """Two levels: parts of many groups, some missing, in several rows."""
    rng = np.random.default_rng(8)
    rows = [(int(p), int(n)) for p, n in zip(rng.integers(0, 5000, 9000), rng.integers(0, 1 << 33, 9000))]
    each = collections.Counter()
    for p, n in rows:
        each[p] += n
    total, want = 0, {}
    for p in sorted(each):
        want[p] = total
        total += each[p]
    assert {r.part: r.base for r in token_store.part_starts(spark.createDataFrame(rows, "part long, n long"), "n").collect()} == want


def test_long_documents(spark):
    """Above a shard and a segment of 2**20 tokens: every id is there once, in order, and little is padding."""
    long = " ".join(f"word{k % 7919} and." for k in range(230000))
    rows = [(1, "short one."), (2, long), (3, None), (4, long[: len(long) // 3]), (5, "last")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bpe = wordbpe.load()
    ids = {i: np.append(np.frombuffer(bpe.encode(t or ""), "<u4"), wordbpe.END).astype("<u4") for i, t in rows}
    assert len(ids[2]) > token_store.SHARD
    start = 0
    for r in token_store.read_tokens(token_store.write_tokens(df)).orderBy("doc_id").collect():
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids[r.doc_id]), zlib.crc32(ids[r.doc_id].tobytes()))
        start += r.n_tokens
    pieces = packing.pack(df).orderBy("doc_id", "start").collect()
    at, fill = collections.Counter(), collections.Counter()
    for p in pieces:
        assert p.start == at[p.doc_id] and p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
        at[p.doc_id] += p.length
        fill[p.sequence_id] += p.length
    assert at == {i: len(x) for i, x in ids.items()} and sorted(fill) == list(range(len(fill))) and max(fill.values()) <= packing.LENGTH
    assert sum(packing.padding(n) for n in fill.values()) < 0.01 * start and len(fill) < 1.05 * start / packing.LENGTH + 2


def test_codes():
    rng = np.random.default_rng(0)
    for ids in (rng.integers(0, 50000, 5000), np.zeros(0), np.array([0, 255, 256, 2**32 - 1] * 300), np.zeros(1500)):
        ids = ids.astype(np.uint32)
        c = token_store.Codes(token_store.encode(ids))
        assert (c.range(0, len(ids)) == ids).all()
        for _ in range(50 * bool(len(ids))):
            a = int(rng.integers(len(ids)))
            b = int(rng.integers(a, len(ids) + 1))
            assert c[a] == ids[a] and (c.range(a, b) == ids[a:b]).all()


def test_packing_is_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(60):
        ends = np.cumsum(rng.integers(1, 150, rng.integers(1, 12)))
        stops = np.unique(rng.integers(1, ends[-1] + 1, 20))
        places, cost = packing.cuts(ends, stops, 64)
        best = [0] + [10**9] * (len(places) - 1)
        for j in range(1, len(places)):
            for i in range(j):
                if places[j] - places[i] <= 64:
                    best[j] = min(best[j], best[i] + packing.padding(int(places[j] - places[i]), 64) + int(cost[j]) + packing.WINDOW)
        chosen, pen = packing.windows(places, cost, 64), dict(zip(places.tolist(), cost.tolist()))
        assert sum(packing.padding(b - a, 64) + pen[b] + packing.WINDOW for a, b in zip(chosen[:-1], chosen[1:])) == best[-1]


def test_pieces(odd, empty):
    c = piece_codec.load()
    rng = np.random.default_rng(4)
    texts = [t or "" for _, t in ODD] + ["".join(rng.choice(list("ab c\n.é1<>▁ñ字 \0�"), 30)) for _ in range(400)]
    for t in texts:
        ids = c.library.encode(t)
        assert c.encode(t) == ids and c.decode(ids) == c.library.decode(ids)
    got = {r.doc_id: r for r in piece_codec.piece_digests(odd).collect()}
    ids = c.library.encode(dict(ODD)[13])
    assert got[13].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and got[13].decoded_sha256 == hashlib.sha256(c.library.decode(ids).encode()).hexdigest()
    assert got[1].n_tokens == 0 and piece_codec.piece_digests(empty).count() == 0


def test_gif(odd, empty):
    got = {r.doc_id: r for r in gif_media.stored_and_read(odd).collect()}
    for i, t in ODD:
        if i is not None:
            n, p = gif_media.payload_of(t or "")
            assert (got[i].n_bytes, got[i].payload_sha256, got[i].tail_crc32) == (n, hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])) and len(p) % 64 == 0 and p
    assert got[4].media_sha256 == got[5].media_sha256 and gif_media.stored_and_read(empty).count() == 0


def test_gif_rules():
    """Transparency, disposal to background and to before, a local palette and interlace."""
    pal = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])

    def frame(index, w, h, x=0, y=0, flags=0, control=b"", local=b""):
        size = gif_media.lzw_encode(bytes(index))
        return control + b"\x2c" + b"".join(v.to_bytes(2, "little") for v in (x, y, w, h)) + bytes([flags]) + local + b"\x08" + bytes([len(size)]) + size + b"\0"

    control = lambda disposal, clear=None: b"\x21\xf9\x04" + bytes([disposal << 2 | (clear is not None)]) + b"\x05\0" + bytes([clear or 0]) + b"\0"
    raw = b"GIF89a" + (2).to_bytes(2, "little") + (2).to_bytes(2, "little") + b"\x81\0\0" + pal
    raw += frame([1, 1, 1, 1], 2, 2, control=control(1)) + frame([2, 0, 0, 2], 2, 2, control=control(3, 0)) + frame([3], 1, 1, control=control(2)) + frame([1, 0], 1, 2, x=1, flags=0xC1, local=pal[::-1], control=control(0)) + b"\x3b"
    f = gif_media.decode_gif(raw)
    red, green, blue, black = (255, 0, 0), (0, 255, 0), (0, 0, 255), (0, 0, 0)
    show = lambda k: [tuple(map(int, p)) for p in f[k]["image"].reshape(-1, 3)]
    assert show(0) == [red] * 4 and show(1) == [green, red, red, green] and show(2) == [blue, red, red, red]
    assert show(3)[0] == black and [x["delay"] for x in f] == [5] * 4 and f[1]["transparent"] == 0


def test_gif_frames_and_faults(spark):
    """A table of frames, and files that are no whole GIF."""
    whole = gif_media.encode_gif(bytes(range(256)) * 100)
    wrong = gif_media.encode_gif(bytes(64))
    at = wrong.index(b"\x2c\0\0\0\0") + 10
    files = [whole, whole[:-1], whole[: len(whole) // 2], whole[:10], b"", None, b"PNG", wrong[:at] + b"\x0c" + wrong[at + 1 :], wrong[: at + 2] + b"\xff" * 20 + wrong[at + 2 :], whole[:13] + b"\x99" + whole[14:]]
    df = spark.createDataFrame([(i, 25600, f, "x") for i, f in enumerate(files)], "doc_id long, n_bytes long, gif binary, feature string")
    got = {r.doc_id: r for r in gif_media.gif_features(df).collect()}
    assert len(got) == len(files) and got[0].fault is None and got[0].payload_bytes == 25600
    assert all(got[i].fault and got[i].payload_sha256 is None for i in range(1, 9)) and got[9].fault is None
    frames = gif_media.gif_frames(df.where("doc_id < 9")).orderBy("frame").collect()
    assert [(r.doc_id, r.frame, r.starts_cs, r.delay_cs, r.width, r.height) for r in frames] == [(0, 0, 0, 10, 64, 256), (0, 1, 10, 10, 64, 144)]
    assert sum(frames[0].red) == 64 * 256 and frames[0].red == frames[0].blue == [1024] * 16 and frames[1].n_colours == 256
    assert gif_media.gif_frames(df.where("false")).count() == 0
    huge = whole[:6] + b"\xff\xff\xff\xff" + whole[10:]
    wide = whole[:6] + b"\0\x0c\0\x0c" + whole[10:-1] + whole[whole.index(b"\x21\xf9") : -1] * 3 + b"\x3b"
    for raw, fault in ((huge, "a screen of 65535 x 65535"), (wide, "screens beyond")):
        with pytest.raises(ValueError, match=fault):
            gif_media.decode_gif(raw)
        assert len(gif_media.decode_gif(raw, compose=False)) >= 2
    rng = np.random.default_rng(0)
    for _ in range(300):
        raw = bytearray(whole[: int(rng.integers(len(whole)))] if rng.random() < 0.5 else whole)
        for k in rng.integers(0, max(1, len(raw)), 3):
            if len(raw):
                raw[k] = rng.integers(256)
        if raw[6:10] == whole[6:10]:
            try:
                gif_media.decode_gif(bytes(raw), compose=False)
            except ValueError:
                pass


def plain_logit(text, net):
    """The network in loops: every position by itself, every chunk by itself."""
    c = byte_cnn
    p = max(1, -(-(len(text) - c.WIDTH) // c.STRIDE) + 1)
    r = np.array([sum(net["E"][text[i * c.STRIDE + j] if i * c.STRIDE + j < len(text) else 256].astype(float) @ net["W"][j * c.EMBED : (j + 1) * c.EMBED].astype(float) for j in range(c.WIDTH)) for i in range(p)])
    h = np.array([np.maximum(r[a : a + c.CHUNK].max(0) + net["b"], 0) for a in range(0, max(1, p - c.CHUNK // 2), c.CHUNK // 2)])
    return float(np.concatenate([h.mean(0), h.max(0)]) @ net["v"] + net["c"][0])


def test_network(monkeypatch):
    """Scores against loops, whatever the blocks; gradients against differences."""
    rng = np.random.default_rng(1)
    net = byte_cnn.initial(rng)
    net["b"] += 0.1
    for n in (0, 1, 7, 8, 9, 12, 130, 131, 260, 400, 1000, 5000):
        t = rng.integers(0, 256, n).astype(np.uint8)
        want = plain_logit(t.tolist(), net)
        for rows in (64, 96, 1 << 16):
            monkeypatch.setattr(byte_cnn, "_ROWS", rows)
            assert abs(byte_cnn.logit(t, net) - want) < 1e-3
    t = rng.integers(0, 256, 900).astype(np.uint8)
    grad = {k: np.zeros_like(x) for k, x in net.items()}
    byte_cnn._gradient(t, 1.0, 1.0, net, grad)
    loss = lambda: np.log1p(np.exp(-plain_logit(t.tolist(), net)))
    for k in net:
        i = np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape)
        old = net[k][i]
        net[k][i] = old + 1e-3
        high = loss()
        net[k][i] = old - 1e-3
        low = loss()
        net[k][i] = old
        assert abs((high - low) / 2e-3 - grad[k][i]) < 0.02 * abs(grad[k][i]) + 1e-3, k


def edits(a, b):
    """Insertions, deletions, changes and swaps of neighbours that turn a into b."""
    d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_against_edit_distance():
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcd"), rng.integers(3, 12))) for _ in range(30)]
    terms = {w + "*" * (k % 5 == 0): 0.5 + k / 100 for k, w in enumerate(dict.fromkeys(words))}
    x = toxicity.Lexicon(terms, exact=frozenset(list(terms)[3:5]))
    hits = 0
    for _ in range(1500):
        w = list(rng.choice(words))
        for _ in range(rng.integers(0, 4)):
            k = int(rng.integers(len(w) + 1))
            w[k : k + int(rng.integers(2))] = list("".join(rng.choice(list("abcde"), rng.integers(0, 2))))
        w = "".join(w)
        want = 0.0
        for term, worth in terms.items():
            word = term.rstrip("*")
            if term.endswith("*"):
                want = max(want, worth if w.startswith(word) else 0)
                continue
            most = 0 if term in x.exact else next((k for n, k in toxicity.EDITS if len(word) >= n), 0)
            e = edits(word, w)
            want = max(want, worth * toxicity.WORTH[e] if e <= most else 0)
        hits += want > 0
        assert abs(x._run(w) - want) < 1e-12, w
    assert hits > 500


def held_out(df, labels, score, column):
    y = {r.doc_id: r[column] for r in labels.collect()}
    return [(r.score, r.predicted, y[r.doc_id]) for r in score.collect() if r.held_out and r.doc_id in y]


def test_models(spark, odd, empty):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    auc = lambda rows: np.mean([(a > b) + (a == b) / 2 for a, _, y in rows if y for b, _, z in rows if not z])
    got = held_out(big, labels, byte_cnn.quality_scores(big, labels), "quality")
    assert auc(got) > 0.98 and np.mean([p == y for _, p, y in got]) > 0.95 and np.mean([not p for _, p, y in got if not y]) > 0.9
    tox = held_out(big, labels, toxicity.toxicity_scores(big, labels), "toxic")
    assert auc(tox) > 0.85 and np.mean([p for _, p, y in tox if y]) > 0.7 and np.mean([p for _, p, y in tox if not y]) < 0.03
    for score in (byte_cnn.quality_scores, toxicity.toxicity_scores):
        rows = score(odd, labels).collect()
        assert len(rows) == len(ODD) - 1 and all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
        assert score(empty, labels).count() == 0 and score(odd, labels.where("false")).count() == len(ODD) - 1


def test_lexicon():
    x = toxicity.Lexicon({"idiot": 0.99, "worthless": 0.99, "sluggar*": 0.9, "scum": 0.99}, frozenset({"idiom"}))
    assert x.worth("idiot,") == 0.99 and 0.8 < x.worth("1diot") and x.worth("idoit") > 0.8 and x.worth("worthlss") > 0.8 and x.worth("wrthlss") > 0.7
    assert x.worth("sluggards") == 0.9 and x.worth("scam") == 0 and x.worth("idiom") == 0 and x.worth("plain") == 0
    assert x.score("you idiot")[0] > 0.98 and x.score('he wrote "idiot" there')[0] < 0.7 and x.score("")[0] < 0.1
    for word in ("idiots", "diot", "idot", "iidiot", "xdiot"):
        assert x.worth(word) > 0.8


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, DATA)
        assert after.columns == docs.columns, name
        docs = after
    kept = {r.doc_id: r.text for r in docs.collect()}
    pieces = corpus_pipeline.run(spark, DATA).collect()
    tokens = collections.Counter()
    for p in pieces:
        tokens[p.doc_id] += p.length
    bpe = wordbpe.load()
    assert tokens == {i: len(bpe.encode(t)) // 4 + 1 for i, t in kept.items()}


def cut(spark, texts):
    return {r.doc_id: r.text for r in substring_dedup.substring_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}


def test_substring_dedup_keeps_unique_short_units(spark):
    head, foot = "shared header line of our site here\n", "\nshared footer line of our site there"
    own = [" ".join(f"{c}{i}" for i in range(40)) for c in "QX"] + ["\n".join(f"{c}{i}" for i in range(40)) for c in "rs"]
    got = cut(spark, [head + x + foot for x in own])
    assert all(x in got[i] for i, x in enumerate(own))


def test_substring_dedup_finds_short_units(spark):
    title = " ".join(f"Title{i}" for i in range(60))
    capitals = " ".join(f"CAPS{i}" for i in range(60))
    pairs = "\n".join(f"left{i} right{i}" for i in range(60))
    unspaced = "。".join("".join(chr(0x4E00 + 97 * i + j) for j in range(8)) for i in range(9)) + "。"
    for p in (title, capitals, pairs, unspaced):
        got = cut(spark, [f"Some own words come first\n{p}\nand then some more", f"Quite other words begin here\n{p}\nwith another end"])
        assert p in got[0] and got[1] == "Quite other words begin here\nwith another end"


def test_quality_rules_boilerplate(spark):
    words = " ".join(f"word{i}" for i in range(60))
    texts = [f"{words} design in, catalog in, analog in.", f"{words} and then sign in.", f"{words}.\nPlease sign in or log in.", "We design in steel.\n" + words + "."]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(got[i].kept for i in range(4)) and [got[i].n_failed_lines for i in range(4)] == [0, 0, 1, 0]


def test_quality_rules_carriage_returns(spark):
    """Lines that end in a carriage return are judged like those that do not; phrases of other languages count."""
    lines = [f"Short{k} good{k} line{k}." for k in range(40)]
    texts = ["\n".join(lines), "\r\n".join(lines), "\r\n".join([*lines, "Alle Rechte vorbehalten."]), "\n".join([*lines, "Tous droits réservés, cliquez ici."])]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(r.kept for r in got.values()) and [got[i].n_failed_lines for i in range(4)] == [0, 0, 1, 1]

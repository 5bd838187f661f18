"""Operators 11 to 13 against plain Python over all rows, planted cases and odd tables."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest

from tessera.llm import merkle, personal_data, ranked_search, registry

DATA = "/root/testdata/sf0.001"
ODD = [(1, "One TWO two 3."), (2, None), (3, ""), (4, " \n "), (4, "Other text, one two"), (5, "word " * 30000), (5, "word " * 30000), (6, "日本語 ß\x85é one"), (7, "\0\x7f"), (8, "one two 3"), (None, "one two"), (-9, "Straße two TWO\r\n")]
NAMES = "g part level i h n row key leaf left right root item term terms counts kind start end base added fillers pattern score rank q w id".split()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, lang, None if k == 3 else "s", k) for k, ((i, t), lang) in enumerate(zip(ODD, ["en", None, "de", "en", "", "é"] * 2))], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit(7).alias(c) for c in NAMES], F.lit("x").alias("a.b"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


# --- operator 13


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def climb(nodes):
    """(root, siblings of each node level by level) of a list of digests."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(place):
            run = range(p - p % 8, min(p - p % 8 + 8, len(nodes)))
            paths[k].append(("".join(nodes[j] for j in run if j < p), "".join(nodes[j] for j in run if j > p)))
        nodes = [digest(*nodes[j : j + 8]) for j in range(0, len(nodes), 8)]
        place = [p // 8 for p in place]
    return nodes[0], paths


def brute_proofs(rows):
    leaf = lambda r: digest(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r.doc_id, r.source, r.lang, r.n_chars, r.text)))
    groups = collections.defaultdict(list)
    for r in rows:
        groups[(r.lang is not None, (r.lang or "").encode())].append((r.doc_id is not None, r.doc_id or 0, leaf(r)))
    keys = sorted(groups)
    trees = {k: (sorted(groups[k]), *climb([x[2] for x in sorted(groups[k])])) for k in keys}
    root, tops = climb([trees[k][1] for k in keys])
    return sorted(((x[1] if x[0] else None, x[2], trees[k][1], root, tuple(p + top)) for k, top in zip(keys, tops) for x, p in zip(trees[k][0], trees[k][2])), key=repr), root


@pytest.mark.parametrize("which", ["docs", "odd", "clashing"])
@pytest.mark.parametrize("part_rows", [5, 200_000])
def test_proofs(spark, which, part_rows, request, monkeypatch):
    """Partitions of a few rows have ragged ends at every level; every proof leads to the root."""
    monkeypatch.setattr(merkle, "PART_ROWS", part_rows)
    df = request.getfixturevalue(which)
    want, root = brute_proofs(df.select("doc_id", "source", "lang", "n_chars", "text").collect()) if which != "clashing" else (None, None)
    got = merkle.merkle_proofs(df).withColumn("folded", merkle.folded("leaf", "proof")).collect()
    assert len({r.root for r in got}) == 1 and all(r.folded == r.root for r in got) and len(got) == df.count()
    if want:
        assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple((p.left, p.right) for p in r.proof)) for r in got), key=repr) == sorted(want, key=repr)


def test_small_trees(spark, odd):
    assert merkle.merkle_proofs(odd.where("false")).count() == 0
    (r,) = merkle.merkle_proofs(odd.where("doc_id = 8")).collect()
    assert r.leaf == r.subroot == r.root and r.proof == []


def test_levels_of_stretches():
    """What stretches of a row of nodes leave at their ends, put together, has all that is not built in one of them."""
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 8, 9, 64, 65, 513, 600):
        nodes = [digest(str(i)) for i in range(n)]
        root, _ = climb(nodes)
        cuts = sorted({0, n, *rng.integers(0, n + 1, 5).tolist()})
        left = collections.defaultdict(dict)
        for a, b in zip(cuts[:-1], cuts[1:]):
            for level, (at, h, x, y) in enumerate(merkle.local_levels(nodes[a:b], a, n)):
                left[level].update({at + j: h[j] for j in (*range(x), *range(y, len(h)))})
        level, m = 0, n
        while m > 1:
            for up in {i // 8 for i in left[level]}:
                run = [left[level][i] for i in range(up * 8, min(up * 8 + 8, m))]
                left[level + 1][up] = digest(*run)
            level, m = level + 1, -(-m // 8)
        assert left[level] == {0: root}


@pytest.mark.parametrize("name", ["op12_ranked_search", "op13_merkle_manifest"])
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = registry.QUERIES[name](spark, DATA).toPandas(), con.sql(registry.ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and len(got)
    assert sorted(map(tuple, got[columns].astype(str).values)) == sorted(map(tuple, want[columns].astype(str).values))


def test_tampered(spark):
    for r in registry.QUERIES["op13_merkle_manifest"](spark, DATA).collect():
        assert r.verified == (r.folded_root == r.root) and (r.verified or zlib.crc32(str(r.doc_id).encode()) % 3 == 0)


# --- operator 12


def brute_search(docs, items, k):
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(i, collections.Counter(w), len(w)) for i, t in docs if i is not None and (w := cut(t))]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        if item is None:
            continue
        scored = []
        for i, c, n in held:
            m = 25 + 75 * n * n_docs // length
            s = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in cut(text) if t in c)
            if s > 0:
                scored.append((-s, i))
        out += [(item, p + 1, i, -s) for p, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("small", [0, 50_000])
@pytest.mark.parametrize("k", [1, 3, 10])
def test_search(spark, docs, odd, clashing, k, small, monkeypatch):
    """Equal to scoring every pair, on odd rows and on a table with many thresholds; joins broadcast and shuffled."""
    monkeypatch.setattr(ranked_search, "SMALL", small)
    items = spark.createDataFrame([(1, "two TWO one"), (2, None), (3, "nothing here"), (4, "word 3 3 straße"), (None, "one"), (5, "日本語")], "item_id long, text string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    pairs = lambda df: [tuple(r) for r in df.collect()]
    want = brute_search(pairs(odd.select("doc_id", "text")), pairs(items), k)
    assert rows(ranked_search.ranked_search(odd, items, k)) == want and rows(ranked_search.ranked_search(clashing, items, k)) == want
    if k > 1:
        mine = spark.read.parquet(f"{DATA}/benchmark.parquet")
        assert rows(ranked_search.ranked_search(docs, mine, k)) == brute_search(pairs(docs.select("doc_id", "text")), pairs(mine.select("item_id", "text")), k)
    else:
        assert ranked_search.ranked_search(odd.where("false"), items).count() == 0 and ranked_search.ranked_search(odd, items.where("false")).count() == 0


# --- operator 11

RULES = [
    (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), lambda m: True),
    (re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m.split("."))),
    (re.compile(r"[0-9](?:[\x20-]?[0-9])+"), lambda m: 16 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and sum(x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0),
    (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def brute_base(text):
    return [(k, m.start(), m.end()) for k, (rule, holds) in enumerate(RULES) for m in rule.finditer(text or "") if holds(m[0])]


def brute_added(texts, support=personal_data.SUPPORT, confident=personal_data.CONFIDENT, rounds=personal_data.ROUNDS):
    """The same bootstrapping on plain strings and dictionaries."""
    edges, plain, kinds, placed = collections.Counter(), collections.Counter(), {}, []
    for row, text in enumerate(texts):
        words = [(m.start(), m.end()) for m in re.finditer(r"[^ \t-\r=:]*[=:]|[^ \t-\r=:]+", text)]
        low = [text[a:b].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for a, b in words]

        def around(first, last):
            out = [tuple(low[first - k : first]) for k in (1, 2, 3) if first >= k]
            return out + [(low[first - 1], None, low[last + 1])] if first and last + 1 < len(low) else out

        data = text.encode()
        point = lambda x: len(data[:x].decode())
        base = personal_data.base_spans(data)
        for kind, a, b in personal_data.fillers(data, base):
            a, b = point(a), point(b)
            first = max(i for i, w in enumerate(words) if w[0] <= a)
            last = max(i for i, w in enumerate(words) if w[0] <= b - 1)
            name = text[a:b].lower()
            for p in around(first, last):
                edges[p, name] += 1
                placed.append((row, kind, a, b, p))
            if kind >= 0 and around(first, last):
                kinds[name] = max(kinds.get(name, -1), kind)
        for i, w in enumerate(words):
            if not re.search("[0-9@]", text[w[0] : w[1]]):
                plain.update(around(i, i))
    held = collections.defaultdict(dict)
    for (p, f), n in edges.items():
        held[p][f] = n
    held = {p: fs for p, fs in held.items() if len(fs) >= support}
    members = {f: (1.0, k) for f, k in kinds.items()}
    accepted, before = {}, -1
    for _ in range(rounds):
        accepted = {}
        for p, fs in held.items():
            for kind in range(5):
                mine = [(n, members[f][0]) for f, n in fs.items() if f in members and members[f][1] == kind]
                worth = sum(n * w for n, w in mine) / (sum(fs.values()) + plain[p])
                if len(mine) >= support and worth >= confident - 1e-12:
                    accepted[p] = (worth, kind)
        if len(accepted) == before:
            break
        before = len(accepted)
        found = collections.defaultdict(list)
        for p, best in accepted.items():
            for f in held[p]:
                if f not in kinds:
                    found[f].append(best)
        members = {f: (1.0, k) for f, k in kinds.items()} | {f: max(x) for f, x in found.items()}
    best = {}
    for row, kind, a, b, p in placed:
        if p in accepted and kind not in range(4):
            best[row, a, b] = max(best.get((row, a, b), (0, 0)), accepted[p])
    return sorted((row, k, a, b) for (row, a, b), (_, k) in best.items())


PLANTED = [
    *[f"Some {w} words, please call me at +1 ({i}00) 555-01{i}9 soon {w}" for i, w in enumerate("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split(), 2)],
    "Then do call me at 555 0199 or write", "You may call me at ext-77 tomorrow",
    *[f"mail box: u{i}@host{i}.example.org ok" for i in range(5)], "mail box: someone@localhost ok",
    *[f"given {w} token = \"{'%040x' % (7**40 + i)}\" there" for i, w in enumerate("one two three four".split())], 'their token = "hunter2" is short',
    "The year 1999 was at 7 o'clock", "Version 2.0 of 3 parts at 9",
]


def spans_of(df):
    return [(r.doc_id, [tuple(s) for s in r.base], [tuple(s) for s in r.added]) for r in df.collect()]


def test_base_rules():
    odd = ["a@b", "a@b.c@d.e", "@x.y", "x@@y.z", "1.2.3.4.5.6.7.8", "300.1.1.1 1.2.3.004", "4111 1111-1111 1111 0", "+1 2345678", "++49 (30) 1234-5678.", "+1" + " " * 50, "é a.b+c@d-e.f.g, ü", "9" * 40, "4111111111111111", "1" * 3000 + "@" + "a" * 3000, ""]
    rng = np.random.default_rng(3)
    odd += ["".join(rng.choice(list("aZ0123459.@+- (é)%"), 60)) for _ in range(3000)]
    for text in odd:
        data = text.encode()
        point = lambda x: len(data[:x].decode())  # noqa: E731, B023
        assert sorted((k, point(a), point(b)) for k, a, b in personal_data.base_spans(data)) == sorted(brute_base(text)), text


def test_private(spark, docs, odd, clashing):
    """Base rules and the bootstrapped rest on documents with planted contexts; the same by brute force."""
    texts = [*PLANTED, *[r.text or "" for r in docs.select("text").collect()]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = spans_of(personal_data.personal_data(df))
    assert sorted((i, b) for i, b, _ in got) == [(i, sorted(brute_base(t))) for i, t in enumerate(texts)]
    added = sorted((i, *s) for i, _, a in got for s in a)
    assert added == brute_added(texts)
    said = {(personal_data.KINDS[k], texts[i][a:b]) for i, k, a, b in added}
    assert {("phone", "555 0199"), ("phone", "ext-77"), ("email", "someone@localhost"), ("secret", "hunter2")} <= said
    assert not {x for _, x in said} & {"1999", "7", "2.0", "3", "9"}
    rows = lambda df: sorted(map(repr, spans_of(personal_data.personal_data(df))))
    assert rows(odd) == rows(clashing) and len(rows(odd)) == len(ODD) - 1 and rows(odd.where("false")) == []


def test_private_query(spark):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in registry.QUERIES["op11_personal_data"](spark, DATA).collect():
        base = [f"{personal_data.KINDS[k]}:{a}:{b}" for k, a, b in sorted(brute_base(rows[r.doc_id].text))]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= set(r.spans.split(",")) | {""}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k + ":") for x in base) for k in personal_data.KINDS[:4]]


# --- bounds of the other operators


def test_samples_are_of_rows(spark):
    """A repeated id gives no more rows than the sample says, and no text is longer than it says."""
    from tessera.llm import byte_cnn, toxicity

    labels = spark.createDataFrame([(i, i % 2) for i in (2, 4, 5, 7) for _ in range(30)], "doc_id long, quality int").selectExpr("*", "quality as toxic")
    docs = spark.createDataFrame([(i, f"text {k % 3}") for i in (2, 4, 5, 7) for k in range(50)] + [(4, "x" * (byte_cnn.LONGEST + 1))], "doc_id long, text string")
    for sample in (1, (2, 3), 500):
        texts, y = byte_cnn.training_rows(docs, labels, "quality", sample)
        most = sample if isinstance(sample, tuple) else (sample, sample)
        assert sum(y == 0) <= most[0] and sum(y == 1) <= most[1] and len(texts) == len(y) > 0 and max(map(len, texts)) < 9
    assert toxicity.toxicity_scores(docs, labels, (1, 1)).count() == 201


def test_memos_keep_no_long_words():
    from tessera.llm import common, piece_codec, toxicity, wordbpe

    long, short = "q" * 400, "plain words here"
    codec, bpe, lexicon = piece_codec.load(), wordbpe.load(), toxicity.Lexicon({"scum": 0.9})
    for use, memo in ((codec.encode, codec.memo), (bpe.encode, bpe.memo), (lexicon.score, lexicon.seen)):
        use(f"{short} {long}")
        assert memo and max(len(k) for k in memo) <= common.KEPT_LETTERS


def test_copies_make_no_terms():
    """What near copies of one toxic text share is no term; what many toxic texts share is."""
    from tessera.llm import toxicity

    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 7))
    shared = " ".join(word() for _ in range(60))
    toxic = [f"{shared} moron {word()}" for _ in range(300)] + [" ".join([*(word() for _ in range(40)), "moron"]) for _ in range(40)]
    clean = [" ".join(word() for _ in range(40)) for _ in range(300)]
    lexicon = toxicity.mine([*toxic, *clean], np.array([1] * len(toxic) + [0] * len(clean)))
    assert set(lexicon.terms) == {"moron"}

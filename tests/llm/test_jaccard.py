"""The Jaccard join on families larger than a block, against brute force."""

import numpy as np
import pytest

from tessera.llm.jaccard_join import jaccard_groups


def brute(sets):
    """{id: (size, smallest linked id, number of different linked sets)}"""
    ids = sorted(sets)
    index = {x: k for k, x in enumerate(sorted({t for s in sets.values() for t in s}))}
    m = np.zeros((len(ids), len(index)), np.float32)
    for r, i in enumerate(ids):
        m[r, [index[t] for t in sets[i]]] = 1
    size = m.sum(1)
    both = m @ m.T
    link = 100 * both >= 75 * (size[:, None] + size[None] - both)
    link &= (size > 0)[:, None] & (size > 0)[None]
    top = np.arange(len(ids))
    while True:
        new = np.minimum(top, np.where(link, top[None], len(ids)).min(1))
        if (new == top).all():
            break
        top = new
    distinct = {}
    for r, i in enumerate(ids):
        distinct.setdefault(sets[i], r)
    first = sorted(distinct.values())
    return {i: (int(size[r]), ids[top[r]], int(sum(link[r, f] for f in first if sets[ids[f]] != sets[i]))) for r, i in enumerate(ids)}


def shingles(text):
    w = text.split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("block", [8, 256])
def test_families(spark, block):
    """Near copies in a large family, and documents that one frequent passage alone brings together."""
    rng = np.random.default_rng(3)
    base = [f"b{k}" for k in range(90)]
    texts = []
    for _ in range(90):  # near copies, some alike
        w = list(base)
        for k in rng.integers(0, 90, rng.integers(0, 4)):
            w[k] = f"x{rng.integers(0, 6)}"
        texts.append(" ".join(w))
    common = " ".join(f"c{k}" for k in range(8))
    pool = [" ".join(f"p{j}_{k}" for k in range(6)) for j in range(40)]
    for _ in range(120):  # made of shared passages
        texts.append(" ".join([common, *(pool[j] for j in rng.choice(40, 3, replace=False))]))
    texts += [common] * 5 + ["one"] * 12 + ["two words"] * 12 + [""] * 3
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), block=block).collect()}
    assert got == brute({i: shingles(t) for i, t in enumerate(texts)})


def test_columns_of_the_same_names(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 5, "x", 0.5), (2, "a b c d e f", 6, "y", 0.6)], "doc_id long, text string, component_id int, rep string, tokens double")
    assert sorted(map(tuple, jaccard_groups(df).collect())) == [(1, 2, 1, 0), (2, 2, 1, 0)]

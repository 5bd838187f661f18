"""Substring dedup against a plain version that looks every window up in a dictionary."""

import re

import pytest
import regex

from tessera.llm import substring_dedup as sd

UNITS = regex.compile(r"(?<=\n)|(?<=[.!?][ \t])(?=[^ \t\n])|(?<=[ \t])(?=\p{Lu})|(?<=[。！？])(?=[^ \t\n])", regex.V1)


def brute(rows):
    """{doc_id: removed (start, end) ranges} of (doc_id, text) rows."""
    where, held = {}, {}
    for doc, text in sorted(rows):
        at, worded = 0, []
        for u in UNITS.split(text):
            plain = re.sub(r"[ \t-\r]+", " ", u).strip(" ").lower()
            if plain:
                worded.append((at, at + len(u), plain, len(re.findall(sd._WORD, plain))))
            at += len(u)
        held[doc] = worded
        for p, unit in enumerate(worded):
            spans = [(p, p)] if unit[3] >= sd.SHORT else []
            if not spans:
                for step in (1, -1):
                    e, n = p, 0
                    while 0 <= e < len(worded):
                        n += worded[e][3]
                        if n >= sd.WINDOW:
                            spans.append((min(p, e), max(p, e)))
                            break
                        e += step
            for s, e in spans:
                where.setdefault(" ".join(x[2] for x in worded[s : e + 1]), set()).add((doc, s, e))
    covered = {doc: set() for doc in held}
    for places in where.values():
        first = min(places)
        for doc, s, e in places:
            if doc != first[0] or s > first[2]:
                covered[doc].update(range(s, e + 1))
    out = {}
    for doc, worded in held.items():
        runs, k = [], 0
        while k < len(worded):
            j = k
            while j < len(worded) and j in covered[doc]:
                j += 1
            if j > k and sum(x[3] for x in worded[k:j]) >= sd.MIN_WORDS:
                runs.append((worded[k][0], worded[j - 1][1]))
            k = max(j, k + 1)
        out[doc] = runs
    return out


def words(text):
    """Of a text, with blanks where units may end."""
    return " " + re.sub(r"[ \t-\r]+", " ", re.sub("([。！？])", r"\1 ", text)).strip(" ").lower() + " "


PASSAGE = " ".join(f"passage{i}" for i in range(60)).capitalize() + "."
LIST = "\n".join(f"Name{i} Other{i}" for i in range(40))
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "Some own words. " + PASSAGE + " and more"), (5, "Other own words " + PASSAGE + " with an end"), (6, PASSAGE), (6, PASSAGE),
    (7, LIST), (8, "head\n\n" + LIST.replace("\n", "\n\n") + "\ntail"), (9, PASSAGE + "\n" + LIST + "\n" + PASSAGE), (10, "Same short line here.\n" * 30), (11, "Same short line here.\n"),
    (12, " ".join(f"word{i}" for i in range(200000))), (13, "日本語の文章です。" * 40), (14, "日本語の文章です。" * 40), (15, "A B c. D! E? " * 50), (None, PASSAGE),
]


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_against_brute_force(spark, which):
    rows = ROWS if which == "odd" else [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r for r in sd.substring_dedup(df).collect()]
    assert len(got) == len(rows)
    texts = {i: t for i, t in rows if i is not None and t is not None}
    want = brute(set(texts.items()))
    assert sum(map(bool, want.values())) > 3
    for r in got:
        if r.doc_id not in texts:
            assert not r.removed
            continue
        text, joined, at, kept = texts[r.doc_id], [], 0, ""
        for s in r.removed:
            assert words(text[s.start : s.end]) in words(texts[s.source]) and s.start >= at
            joined = joined[:-1] + [(joined[-1][0], s.end)] if joined and joined[-1][1] == s.start else [*joined, (s.start, s.end)]
            kept, at = kept + text[at : s.start], s.end
        assert joined == want[r.doc_id] and kept + text[at:] == r.text


def test_columns_of_the_same_names(spark):
    df = spark.createDataFrame([(1, PASSAGE, 5, "x", 0.5), (2, PASSAGE, 6, "y", 0.6)], "doc_id long, text string, removed int, units string, `h1` double")
    got = sd.substring_dedup(df)
    assert got.columns == ["doc_id", "text", "units", "h1", "removed"]
    assert [(r.text, r.units, len(r.removed)) for r in got.orderBy("doc_id").collect()] == [(PASSAGE, "x", 0), ("", "y", 1)]
    assert sd.substring_dedup(df.where("false")).count() == 0

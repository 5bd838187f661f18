"""Toxicity by Levenshtein automata over a lexicon trie, with context windows (operator 2).

Terms and stems are mined from labelled training rows. The trie of all terms and
the Levenshtein automaton of each term's edit limit run as one automaton whose
deterministic states are built as words need them, so most words die after a few
characters. A match counts for what its term is worth, less with edits; the words
around it tell quotation or talk about the term (less) from address (more).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.byte_cnn import training_rows
from tessera.llm.common import KEPT_LETTERS, documents, enter, held_out, mix

#: Labelled rows that the lexicon is mined from at most: clean, toxic.
SAMPLE = (3000, 2000)
THRESHOLD = 0.7
#: A term's least families among toxic rows, in number and as a share of them, and least share of toxic ones; stem lengths.
SUPPORT, SHARE, PRECISION, STEMS = 5, 0.02, 0.92, (5, 8)
#: Rows of one label are a family if any of so many least hashes of their runs of WORDS words agree.
SKETCH, WORDS = 4, 4
#: Edits allowed from these lengths on (whole words only), and a match's worth by its edits.
EDITS, WORTH = ((9, 2), (5, 1)), (1.0, 0.85, 0.75)
#: A term with so many different near words in clean rows is matched without edits.
CROWDED = 3
#: Words on each side that make the context, and its factors.
WINDOW, QUOTED, ADDRESSED = 6, 0.4, 0.5
REPORTING = frozenset("said says quote quoted quotes called calls word words term terms wrote writes definition insult slur meaning means".split())
ADDRESS = frozenset("you your youre yourself u ur du dich tu te vous usted".split())
_PART = re.compile(r"[^\W\d_]+")
_LEET = str.maketrans("013457@$", "oieastas")
_OPEN, _CLOSE = "\"“«„'‘", "\"”»“'’"
#: Entries of a worker's caches before they start again.
_CACHE = 500_000


class Lexicon:
    """terms: {word or stem*: worth}; exceptions: words that are no match though near a term."""

    def __init__(self, terms: dict[str, float], exceptions: frozenset[str] = frozenset(), exact: frozenset[str] = frozenset()):
        self.terms, self.exceptions, self.exact = terms, exceptions, exact
        self.name: dict[int, str] = {}
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[tuple[float, int, bool] | None] = [None]
        self.most = [0]
        for term, worth in terms.items():
            stem, word = term.endswith("*"), term.rstrip("*")
            edits = 0 if stem or term in exact else next((k for n, k in EDITS if len(word) >= n), 0)
            at = 0
            self.most[0] = max(self.most[0], edits)
            for c in word:
                if c not in self.child[at]:
                    self.child[at][c] = len(self.child)
                    self.child.append({})
                    self.ends.append(None)
                    self.most.append(0)
                at = self.child[at][c]
                self.most[at] = max(self.most[at], edits)
            self.name[at] = term
            old = self.ends[at]
            self.ends[at] = (max(worth, old[0]), max(edits, old[1]), stem or old[2]) if old else (worth, edits, stem)
        self.letters = {c for x in self.child for c in x}
        self._reset()

    def _reset(self):
        self.start = self._closed({(0, 0, "")}, 0.0)
        self.moves: dict = {self.start: {}}
        self.seen: dict[str, float] = {}

    def _closed(self, states: set[tuple[int, int, str]], stem: float):
        """With what skipping a term's characters reaches; fewer edits at a node win. stem: the best worth of a finished stem.

        A state is (node, edits, awaited): awaited is the earlier of two swapped characters, still to come.
        """
        best: dict[tuple[int, str], int] = {}
        todo = list(states)
        while todo:
            node, e, awaited = todo.pop()
            if e > self.most[node] or best.get((node, awaited), 9) <= e:
                continue
            best[node, awaited] = e
            if not awaited:
                todo += [(x, e + 1, "") for x in self.child[node].values()]
        for (node, awaited), e in best.items():
            if e == 0 and not awaited and self.ends[node] and self.ends[node][2]:
                stem = max(stem, self.ends[node][0])
        return frozenset((node, e, awaited) for (node, awaited), e in best.items()), stem

    def _move(self, state, c: str):
        nodes, stem = state
        after = set()
        for node, e, awaited in nodes:
            if awaited:
                if c == awaited:
                    after.add((node, e, ""))
                continue
            after.add((node, e + 1, ""))
            for x, to in self.child[node].items():
                after.add((to, e if x == c else e + 1, ""))
                if c in self.child[to] and x != c:
                    after.add((self.child[to][c], e + 1, x))
        return self._closed(after, stem)

    def _run(self, word: str, near: set[str] | None = None) -> float:
        """Worth of a word; near: gets the terms that match with edits."""
        state, moves = self.start, self.moves
        for c in word:
            c = c if c in self.letters else ""
            there = moves[state].get(c)
            if there is None:
                there = moves[state][c] = self._move(state, c)
                if there not in moves:
                    moves[there] = {}
            state = there
            if not state[0]:
                break
        found = state[1]
        for node, e, awaited in state[0]:
            end = self.ends[node]
            if end and not awaited and e <= end[1]:
                found = max(found, end[0] * WORTH[e])
                if e and near is not None:
                    near.add(self.name[node])
        if len(moves) > _CACHE:
            self.moves = {self.start: {}}
        return found

    def worth(self, token: str) -> float:
        """Of a blank-separated token: the best of its parts, of its letters put together, and of digits read as letters."""
        low = token.lower()
        parts = _PART.findall(low)
        if not parts:
            return 0.0
        if len(low) > len(parts[0]) + 2 or len(parts) > 1:
            parts = {*parts, "".join(parts), *_PART.findall(low.translate(_LEET))}
        return max((self._run(p) for p in parts if p not in self.exceptions), default=0.0)

    def score(self, text: str) -> tuple[float, int]:
        """(score, matches) of a whole text: 1 - the product of what the matches leave."""
        words = text.split()
        worths = list(map(self.seen.get, words))
        if None in worths:
            if len(self.seen) > _CACHE:
                self.seen = {}
            for i, x in enumerate(worths):
                if x is None:
                    worths[i] = self.worth(words[i])
                    if len(words[i]) <= KEPT_LETTERS:
                        self.seen[words[i]] = worths[i]
        if not any(worths):
            return 0.01, 0
        left, n = 0.99, 0
        for i, x in enumerate(worths):
            if x:
                n += 1
                left *= 1 - min(0.99, self._in_context(words, i, x))
        return 1 - left, n

    @staticmethod
    def _in_context(words: list[str], i: int, worth: float) -> float:
        a, b = words[max(0, i - WINDOW) : i], words[i + 1 : i + 1 + WINDOW]
        near = {w.lower().strip(".,;:!?'’\"") for w in a + b}
        inside = (words[i][0] in _OPEN or any(w[0] in _OPEN and w[-1] not in _CLOSE for w in a)) and (words[i].rstrip(".,;:!?")[-1:] in tuple(_CLOSE) or any(w.rstrip(".,;:!?")[-1:] in tuple(_CLOSE) for w in b))
        if inside or near & REPORTING:
            return worth * QUOTED
        if near & ADDRESS:
            return 1 - (1 - worth) * ADDRESSED
        return worth


def _families(texts: list[str], labels: np.ndarray) -> tuple[list[str], np.ndarray]:
    """One text for each family of near copies of a label, and its label."""
    top, first, seen = list(range(len(texts))), {}, {}

    def find(i):
        while top[i] != i:
            top[i] = i = top[top[i]]
        return i

    for i, (text, y) in enumerate(zip(texts, labels)):
        words = text.lower().split()
        runs = {" ".join(words[k : k + WORDS]) for k in range(max(1, len(words) - WORDS + 1))}
        h = np.fromiter((zlib.crc32(x.encode()) for x in runs), np.uint64, len(runs))
        for k in range(SKETCH):
            least = int(mix(h + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)).min())
            j = first.setdefault((k, int(y), least), i)
            top[find(i)] = find(j)
    for i in range(len(texts)):
        seen.setdefault(find(i), set()).update(texts[i].lower().split())
    kept = sorted(seen)
    return [" ".join(sorted(seen[i])) for i in kept], np.array([labels[i] for i in kept])


def mine(texts: list[str], labels: np.ndarray) -> Lexicon:
    """Words and stems that mark toxic rows. Of a stem and a longer form with the same rows, the longer one stays.

    A family of near copies counts as one row, with all its words: what copies have
    in common besides a term is no term.
    """
    texts, labels = _families(texts, labels)
    low, high = STEMS

    def forms(text: str) -> set[str]:
        found = set()
        for w in set(_PART.findall(text.lower())):
            if len(w) >= 4:
                found.add(w)
                found.update(w[:k] + "*" for k in range(low, min(len(w), high + 1)))
        return found

    toxic: Counter[str] = Counter()
    for text, y in zip(texts, labels):
        if y:
            toxic.update(forms(text))
    least = max(SUPPORT, SHARE * float(np.sum(labels == 1)))
    toxic = Counter({w: n for w, n in toxic.items() if n >= least})
    seen = toxic.copy()
    for text, y in zip(texts, labels):
        if not y:
            seen.update(forms(text) & toxic.keys())
    share = len(texts) / max(1.0, 2 * float(np.sum(labels == 0)))
    good = {w: n for w, n in toxic.items() if n / seen[w] >= PRECISION}
    terms = {}
    for w, n in good.items():
        base = w.rstrip("*")
        if w.endswith("*") and (any(good.get(x, 0) >= n for x in good if x != w and x.rstrip("*").startswith(base))):
            continue
        terms[w] = min(0.99, (n + 1) / (seen[w] + 1 + share * 0.5))
    lexicon = Lexicon(terms)
    clean = {w for text, y in zip(texts, labels) if not y for w in _PART.findall(text.lower())} - terms.keys()
    crowd: Counter[str] = Counter()
    for w in clean:
        near: set[str] = set()
        lexicon._run(w, near)
        crowd.update(near)
    lexicon = Lexicon(terms, exact=frozenset(w for w, n in crowd.items() if n >= CROWDED))
    return Lexicon(terms, frozenset(w for w in clean if lexicon._run(w) > 0 and not any(w.startswith(x[:-1]) for x in terms if x.endswith("*"))), lexicon.exact)


def _score(terms: dict[str, float], exceptions: frozenset[str], exact: frozenset[str], threshold: float):
    def run(batches):
        enter("toxicity")
        lexicon = Lexicon(terms, exceptions, exact)
        for batch in batches:
            found = [lexicon.score(t) for t in batch.column(1).to_pylist()]
            p = np.array([x[0] for x in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array([x[1] for x in found], pa.int64())],
                names=["doc_id", "held_out", "score", "predicted", "n_matches"],
            )

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_matches) of every row of ``docs``.

    Null and empty texts score 0.01 as any text without a match; a very long text
    is scored in whole, its words in memory at once. The lexicon is mined from at
    most ``sample`` labelled rows (clean, toxic), its one bound; with no toxic row it
    is empty. Of terms that a word matches alike (a tie) the greatest worth counts;
    a score of just ``threshold`` is predicted 1. Repeated rows are scored alike,
    other columns are no inputs, an empty table gives no rows.
    """
    docs = documents(docs)
    lexicon = mine(*training_rows(docs, labels, "toxic", sample))
    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(_score(lexicon.terms, lexicon.exceptions, lexicon.exact, threshold), "doc_id long, held_out boolean, score double, predicted int, n_matches long")

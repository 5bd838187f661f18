"""Personal data by bootstrapped contextual extraction (operator 11).

1. Rules find the seed entities: e-mail and IP addresses, card and phone numbers.
   Long keys and hexadecimal strings are seeds of a fifth kind, secrets; these are
   only hints, and none is reported for its form alone.
2. Every seed, and every other token that holds a digit or an ``@``, is a filler of
   the lexical patterns around it: one, two or three words before it, and one word
   before together with one after. Patterns and fillers are a graph, its edges
   counted over all documents; a second pass counts how often each pattern of the
   graph holds an ordinary word.
3. Spark scores the graph in rounds: a pattern is worth the share of its
   occurrences whose fillers belong to a kind, a filler the best pattern that holds
   it. Patterns of SUPPORT different members and a share of CONFIDENT or more are
   accepted; what they hold joins the kind and supports patterns in the next round.
4. What accepted patterns hold in a text, and no rule had found, is added to its
   spans.

Words are cut at blanks and behind ``=`` and ``:``, so that ``password=`` is a word
before its value; they are compared by 64-bit hashes, A-Z lower-cased.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import documents, enter, join_dealt, materialize, mix, slices, table, text_bytes
from tessera.llm.shingles import word_hashes, word_spans

KINDS = ("email", "ip", "card", "phone", "secret")
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
#: Seeds of the fifth kind: access key ids, and hexadecimal digits with letters among them.
SECRET = re.compile(rb"(?:AKIA|ASIA)[0-9A-Z]{16}|(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{16,}")
#: Different members that a pattern is seen with at least, its least share of members, and rounds at most.
SUPPORT, CONFIDENT, ROUNDS = 4, 0.8, 5
#: Slots of the table that tells which patterns to count; so many bytes go to each worker, whatever the graph is.
SLOTS = 1 << 21
_MARK = re.compile(rb"[0-9@]")
_BLANK = frozenset(b" \t\n\x0b\x0c\r")
_OPEN, _CLOSE = b"\"'([{<`", b"\"')]}>`.,;:!?"
_BREAK = np.zeros(256, bool)
_BREAK[[ord("="), ord(":")]] = True
_MARKED = np.zeros(256, bool)
_MARKED[[ord("@"), *range(48, 58)]] = True
_SALTS = np.array([mix(np.array([i + 77], np.uint64))[0] | np.uint64(1) for i in range(4)], np.uint64)
#: Tokens that follow each other by one blank are one filler, up to so many.
GROUPED = 4


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = c - 48
        total += x if i % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(kind, start, end) in bytes of what the rules find, leftmost and without overlap within a kind, in order."""
    out, last, at = [], 0, text.find(b"@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            last = m.end()
        at = text.find(b"@", last if m else at + 1)
    for m in _IP.finditer(text):
        if all(len(x.lstrip(b"0")) <= 3 and int(x) <= 255 for x in m[0].split(b".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 16 <= len(m[0]) <= 38 and 16 <= len(digits := m[0].translate(None, b" -")) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if b"+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(48 <= c < 58 for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def fillers(text: bytes, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(kind or -1, start, end) of the seeds and of all other tokens with a digit or ``@``, in order; tokens that overlap a rule's span are left out.

    A token starts behind the last ``=`` or ``:`` before its first digit or ``@``,
    and has no quotes, brackets or full stops at its ends.
    """
    taken = sorted((a, b) for _, a, b in base)
    found: list[list[int]] = []
    k, at, size = 0, 0, len(text)
    m = _MARK.search(text)
    while m:
        a = m.start()
        while a > at and text[a - 1] not in _BLANK and not _BREAK[text[a - 1]]:
            a -= 1
        b = m.end()
        while b < size and text[b] not in _BLANK:
            b += 1
        while a < b and text[a] in _OPEN:
            a += 1
        end = b
        while end > a and text[end - 1] in _CLOSE:
            end -= 1
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if a < end and not (k < len(taken) and taken[k][0] < end):
            joins = found and found[-1][1] == a - 1 and text[a - 1] == 32 and found[-1][2] < GROUPED
            if joins:
                found[-1][1:] = [end, found[-1][2] + 1]
            else:
                found.append([a, end, 1])
        at = b
        m = _MARK.search(text, b)
    own = [(4 if SECRET.fullmatch(text, a, b) else -1, a, b) for a, b, _ in found]
    return sorted([*base, *own], key=lambda x: (x[1], x[2], x[0]))


def _words(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, rows, hashes, marked) of the words of all rows; marked: with a digit or ``@``."""
    starts, ends, row = word_spans(data, offsets, _BREAK)
    marks = np.concatenate([[0], np.cumsum(_MARKED[data])])
    return starts, ends, row, word_hashes(data, starts, ends), marks[ends] > marks[starts]


def _patterns(h: np.ndarray, row: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the four patterns around the words first..last, 0 where the row has no such words; one line each."""
    out = np.zeros((4, len(first)), np.uint64)
    here = row[first]
    before = np.zeros(len(first), np.uint64)
    for k in (1, 2, 3):
        has = first >= k
        has[has] = row[first[has] - k] == here[has]
        before[has] = mix(before[has] * np.uint64(31) + h[first[has] - k] * _SALTS[k - 1])
        out[k - 1, has] = before[has]
    has = (first >= 1) & (last + 1 < len(h))
    has[has] = (row[first[has] - 1] == here[has]) & (row[last[has] + 1] == here[has])
    out[3, has] = mix(h[first[has] - 1] * _SALTS[3] + mix(h[last[has] + 1]))
    return out


_FOUND_SQL = "row long, doc_id long, base array<struct<kind:int,start:int,end:int>>, fillers array<struct<kind:int,start:int,end:int,filler:long,patterns:array<long>>>"
_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_FILLER = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("filler", pa.int64()), ("patterns", pa.list_(pa.int64()))])


def _find(batches):
    """(doc_id, text) -> rule spans, and the fillers with their patterns; offsets in code points."""
    from pyspark import TaskContext

    enter("personal data")
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        bases, all_fillers = [], []
        for i, j in slices(offsets):
            part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            words = None
            for a, b in zip(at[:-1], at[1:]):
                text = part[a:b].tobytes()
                base = base_spans(text)
                found = fillers(text, base)
                if found:
                    words = words or _words(part, at)
                    point = np.concatenate([[0], np.cumsum((part[a:b] & 0xC0) != 0x80)])
                    place = np.array([(x, y) for _, x, y in found]) + a
                    first = np.searchsorted(words[0], place[:, 0], "right") - 1
                    last = np.searchsorted(words[0], place[:, 1] - 1, "right") - 1
                    around = _patterns(words[3], words[2], first, last).T.astype(np.int64)
                    name = word_hashes(part, place[:, 0], place[:, 1]).astype(np.int64)
                    point = point.tolist()
                    all_fillers.append([{"kind": k, "start": point[x], "end": point[y], "filler": f, "patterns": [p for p in ps if p]} for (k, x, y), f, ps in zip(found, name.tolist(), around.tolist())])
                    bases.append([{"kind": k, "start": point[x], "end": point[y]} for k, x, y in base])
                else:
                    all_fillers.append([])
                    bases.append([])
        n = len(bases)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + n)), batch.column(0), pa.array(bases, pa.list_(_SPAN)), pa.array(all_fillers, pa.list_(_FILLER))], names=["row", "doc_id", "base", "fillers"])
        row += n


def _count(slots: bytes):
    """(doc_id, text) -> (pattern, plain): occurrences around an ordinary word of patterns whose slot is taken, summed up by batch."""

    def run(batches):
        enter("personal data")
        wanted = np.frombuffer(slots, np.uint8)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in slices(offsets):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                _, _, row, h, marked = _words(part, at)
                plain = np.flatnonzero(~marked)
                found = _patterns(h, row, plain, plain).ravel()
                found, n = np.unique(found[(found != 0) & (wanted[(found % np.uint64(SLOTS)).astype(np.int64)] > 0)].astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["pattern", "plain"])

    return run


def score_graph(edges: DataFrame, plain: DataFrame, seeds: DataFrame, support: int = SUPPORT, confident: float = CONFIDENT, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, worth) of the accepted patterns.

    edges: (pattern, filler, n), one row for each pair; plain: (pattern, plain);
    seeds: (filler, kind), of which a filler has one. A share of just ``confident``
    is enough. A kind's members only grow, so the rounds end when none came.
    """
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("held"), F.count("*").alias("fillers")).where(F.col("fillers") >= support).join(plain, "pattern", "left")
    totals = materialize(totals.select("pattern", (F.col("held") + F.coalesce("plain", F.lit(0))).alias("total"), "fillers"), "totals")
    edges = materialize(join_dealt(edges, totals.select("pattern", "fillers"), ["pattern"], "fillers"), "edges")
    degree = materialize(edges.groupBy("filler").agg(F.count("*").alias("degree")), "degree")
    members = materialize(seeds.select("filler", "kind", F.lit(1.0).alias("worth"), F.lit(True).alias("seed")).join(degree, "filler"), "members")
    accepted, before = None, -1
    for _ in range(rounds):
        told = join_dealt(edges, members.select("filler", "kind", "worth", "degree"), ["filler"], "degree")
        found = told.groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("worth")).alias("good"), F.count("*").alias("members")).where(F.col("members") >= support)
        found = found.join(totals, "pattern").withColumn("worth", F.col("good") / F.col("total")).where(F.col("worth") >= confident)
        accepted = materialize(found.select("pattern", "kind", "worth", "fillers"), "accepted")
        now = accepted.count()
        if now == before:
            break
        before = now
        best = join_dealt(edges, accepted, ["pattern"], "fillers").groupBy("filler").agg(F.max(F.struct("worth", "kind")).alias("best"))
        new = best.join(members.where("seed").select("filler"), "filler", "left_anti").select("filler", "best.kind", "best.worth", F.lit(False).alias("seed")).join(degree, "filler")
        members = materialize(members.where("seed").select("filler", "kind", "worth", "seed", "degree").union(new), "members")
    return accepted.select("pattern", "kind", "worth")


def personal_data(docs: DataFrame, support: int = SUPPORT, confident: float = CONFIDENT, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, base, added): arrays of (kind, start, end) in code points of every row, by kind, then start; kind is a place in KINDS.

    base: what the rules find; added: what accepted patterns hold besides. Null and
    empty texts have neither; a very long text is held by one task, its words a
    slice of it at a time. A filler that several accepted patterns hold gets the
    kind of the best one, of equal ones (a tie) the later kind. Rows are told apart
    by place, so rows that share a doc_id keep their own spans, and repeated rows
    count as often as they stand. A row without a doc_id is none; other columns are
    no inputs; an empty table gives no rows.
    """
    docs = documents(docs)
    found = materialize(docs.mapInArrow(_find, _FOUND_SQL), "found")
    each = found.select("row", F.explode("fillers").alias("f")).select("row", "f.*")
    each = materialize(each.select("row", "kind", "start", "end", "filler", F.explode("patterns").alias("pattern")), "each")
    edges = materialize(each.groupBy("pattern", "filler").agg(F.count("*").alias("n"), F.max("kind").alias("kind")), "edges")
    seeds = edges.where("kind >= 0").groupBy("filler").agg(F.min("kind").alias("kind"))
    slots = bytearray(SLOTS)
    likely = edges.groupBy("pattern").agg(F.count("*").alias("fillers")).where(F.col("fillers") >= support)
    # at most SLOTS rows; unsigned remainder, as in the workers
    for (slot,) in likely.select(F.expr(f"cast(pattern & {SLOTS - 1} as int) as slot")).distinct().toLocalIterator():
        slots[slot] = 1
    shared = docs.sparkSession.sparkContext.broadcast(bytes(slots))

    def counted(batches):
        yield from _count(shared.value)(batches)

    plain = docs.mapInArrow(counted, "pattern long, plain long").groupBy("pattern").agg(F.sum("plain").alias("plain"))
    accepted = score_graph(edges.select("pattern", "filler", "n"), plain, seeds, support, confident, rounds)
    uses = each.where("kind < 0 or kind > 3").join(accepted.select("pattern"), "pattern", "left_semi").groupBy("pattern").agg(F.count("*").alias("uses"))
    held = join_dealt(each.where("kind < 0 or kind > 3").drop("kind"), materialize(accepted.join(uses, "pattern"), "uses"), ["pattern"], "uses")
    held = held.groupBy("row", "start", "end").agg(F.max(F.struct("worth", "kind")).alias("best"))
    added = held.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("best.kind", "start", "end"))).alias("added"))
    none = F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)")
    return found.select("row", "doc_id", F.sort_array("base").alias("base")).join(added, "row", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def op11_personal_data(spark, sf_dir: str) -> DataFrame:
    out = personal_data(table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, KINDS))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")
    counts = [F.size(F.expr(f"filter(base, s -> s.kind = {k})")).cast("long").alias(f"n_{KINDS[k]}") for k in range(4)]
    spans = text(F.sort_array(F.concat("base", "added")))
    return out.select("doc_id", *counts, F.sha2(text(F.col("base")), 256).alias("base_sha256"), spans.alias("spans"))

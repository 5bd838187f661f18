"""Substring dedup by hashed lines and sentences (operator 9).

A unit is a line, cut further after sentence ends and before capitalised words,
so that a passage set into another sentence still yields its own units. Scripts
without blanks are cut after their own full stops. Units are normalised (lower
case, single blanks) and hashed; one of fewer than SHORT words is hashed with
those after it, and once more with those before it, until WINDOW words. These
windows are grouped by a 128-bit digest over all documents, the earliest
occurrence (smallest doc_id, then place) being each group's source. A unit goes
only if it lies in a window that its source holds too, and only as part of a run
of MIN_WORDS such words or more. Every removed span has its offsets in the
original text and a source whose text contains the span's words; where the
sources of a run's windows differ, the run is several spans.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import OWN, enter, join_dealt, materialize, named

#: Words that a removed run has at least; words below which a unit is hashed with its neighbours, and how many they make together.
MIN_WORDS, SHORT, WINDOW = 30, 3, 6
_UNITS = r"split(text, '(?<=\\n)|(?<=[.!?][ \\t])(?=[^ \\t\\n])|(?<=[ \\t])(?=\\p{Lu})|(?<=[。！？])(?=[^ \\t\\n])')"
_NORMAL = r"lower(trim(regexp_replace(u, '[ \\t-\\r]+', ' ')))"
_SPANS = "array<struct<start:long,end:long,source:long>>"
#: Kana, Han, Thai, Lao, Khmer and Burmese are written without blanks; two of their characters count as a word.
_UNSPACED = "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)))
#: What a unit without a word consists of.
_BLANKS = " \t\n\x0b\x0c\r"
_WORD = rf"[{_UNSPACED}]{{1,2}}|[^ \t-\r{_UNSPACED}]+"


def windows(short: int = SHORT, window: int = WINDOW) -> str:
    """SQL array of (s, e, w): first and last unit and the words of each window of ``text``; units without a word are not counted.

    A unit of ``short`` words or more is a window of its own. A window backwards
    that is one forwards too is left out.
    """
    least = max(short, window)
    none = "named_struct('s', -1, 'e', -1, 'n', 0, 'k', 0, 'w', '')"
    onward = f"""aggregate(slice(v, p + 1, {least}), {none}, (a, y) -> if(a.n >= {least}, a,
      named_struct('s', x.i, 'e', y.i, 'n', a.n + y.n, 'k', x.n, 'w', concat(a.w, ' ', y.u))), a -> if(a.n < {least}, null, named_struct('s', a.s, 'e', a.e, 'w', substr(a.w, 2))))"""
    back = f"""aggregate(reverse(slice(v, greatest(p + 2 - {least}, 1), least(p + 1, {least}))), {none}, (a, y) -> if(a.n >= {least}, a,
      named_struct('s', y.i, 'e', x.i, 'n', a.n + y.n, 'k', y.n, 'w', concat(' ', y.u, a.w))),
      a -> if(a.n < {least} or (a.k < {short} and a.n - x.n < {least}), null, named_struct('s', a.s, 'e', a.e, 'w', substr(a.w, 2))))"""
    word = _WORD.replace("\\", "\\\\")
    count = f"if(u = '', 0, if(octet_length(u) = char_length(u), 1 + octet_length(u) - octet_length(replace(u, ' ', '')), cast(regexp_count(u, '{word}') as int)))"
    return f"""transform(array(transform(filter(transform(transform({_UNITS}, u -> {_NORMAL}), u -> named_struct('u', u, 'n', {count})), x -> x.n > 0), (x, i) -> named_struct('i', i, 'u', x.u, 'n', x.n))), v ->
      flatten(transform(v, (x, p) -> if(x.n >= {short}, array(named_struct('s', x.i, 'e', x.i, 'w', x.u)), filter(array({onward}, {back}), y -> y is not null)))))[0]"""


def removed_spans(units: list[str], marks: list[tuple], min_words: int = MIN_WORDS) -> list[tuple]:
    """(start, end, source) in code points of what goes.

    marks: first and last unit of a repeated window, the document of its earliest
    occurrence and the first unit there; units without a word are not counted.
    """
    # windows that lie alike in one source grow together: the source holds their units one after another
    alike: dict[tuple, list[list[int]]] = {}
    for s, e, source, there in sorted(marks):
        spans = alike.setdefault((source, there - s), [])
        if spans and s <= spans[-1][1] + 1:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    stretches = sorted((s, -e, source) for (source, _), spans in alike.items() for s, e in spans)
    at, begin, end = 0, [], []
    for u in units:
        if u.strip(_BLANKS):
            begin.append(at)
            end.append(at + len(u))
        at += len(u)
    text = "".join(units)
    out: list[tuple] = []
    run: list[tuple] = []

    def close():
        if run and len(re.findall(_WORD, text[begin[run[0][0]] : end[run[-1][1]]])) >= min_words:
            for k, (s, e, source) in enumerate(run):
                out.append((begin[s], begin[run[k + 1][0]] if k + 1 < len(run) else end[e], source))
        run.clear()

    k, upto = 0, 0
    best = None  # of the stretches that begin at ``upto`` or before, the one that reaches farthest
    while k < len(stretches) or best:
        while k < len(stretches) and stretches[k][0] <= upto:
            s, e, source = stretches[k][0], -stretches[k][1], stretches[k][2]
            if e >= upto and (best is None or e > best[0] or (e == best[0] and source < best[1])):
                best = e, source
            k += 1
        if best:
            run.append((upto, *best))
            upto, best = best[0] + 1, None
        elif k < len(stretches):
            close()
            upto = stretches[k][0]
    close()
    return out


def _remove(min_words: int):
    def run(batches):
        enter("substring")
        for batch in batches:
            ids, of_text, texts, spans = [], [], [], []
            for doc, t, units, marks in zip(*(c.to_pylist() for c in batch.columns)):
                gone = removed_spans(units, [(m["s"], m["e"], (m["source"], m["t"]), m["there"]) for m in marks], min_words)
                text, at, kept = "".join(units), 0, []
                for a, b, _ in gone:
                    kept.append(text[at:a])
                    at = b
                ids.append(doc)
                of_text.append(t)
                texts.append("".join([*kept, text[at:]]))
                spans.append([{"start": a, "end": b, "source": s[0]} for a, b, s in gone])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("source", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(of_text, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, kind)], names=[f"{OWN}of", f"{OWN}of_text", f"{OWN}kept", f"{OWN}spans"])

    return run


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS, short: int = SHORT, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated runs taken out of ``text``, and removed: array of (start, end, source).

    A null text stays null; empty and blank texts have no units and stay. A very
    long text is a row of units like any other; a task holds the units of a few
    such rows. Rows that share doc_id and text are one document; rows that share a
    doc_id only are documents of their own, told apart by a 64-bit hash of the
    text; a row without a doc_id keeps its text. Of occurrences in one document the
    first place is the earliest one (ties cannot be: a place is unique). All other
    columns pass through (but for one named removed); an empty table gives no rows.
    """
    held = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    units = held.select("doc_id", "t", F.explode(F.expr(windows(short, window))).alias("u"))
    units = materialize(units.select("doc_id", "t", "u.s", "u.e", F.xxhash64("u.w").alias("h1"), F.xxhash64(F.lit(1), "u.w").alias("h2")), "units")
    first = units.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "t", "s", "e")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = join_dealt(units, materialize(first, "first"), ["h1", "h2"], "n").where("doc_id <> first.doc_id or t <> first.t or s > first.e")
    mark = F.struct("s", "e", F.col("first.doc_id").alias("source"), F.col("first.t").alias("t"), F.col("first.s").alias("there"))
    marks = later.groupBy(F.col("doc_id").alias("d"), F.col("t").alias("dt")).agg(F.collect_set(mark).alias("marks"))
    cut = held.join(materialize(marks, "marks"), (F.col("doc_id") == F.col("d")) & (F.col("t") == F.col("dt"))).select("doc_id", "t", F.expr(_UNITS).alias("units"), "marks")
    of, of_text, kept, spans = f"{OWN}of", f"{OWN}of_text", f"{OWN}kept", f"{OWN}spans"
    cut = cut.mapInArrow(_remove(min_words), f"{of} long, {of_text} long, {kept} string, {spans} {_SPANS}").where(F.size(spans) > 0)
    out = docs.join(materialize(cut.dropDuplicates([of, of_text]), "kept"), (docs.doc_id == F.col(of)) & (F.xxhash64(docs.text) == F.col(of_text)), "left")
    return out.select(
        *named(docs, {"text": F.when(F.col(of).isNull(), docs["text"]).otherwise(F.col(kept))}, ("removed",)),
        F.coalesce(spans, F.expr(f"cast(array() as {_SPANS})")).alias("removed"),
    )

"""Line-first quality rules (operator 8, DataFrame functions only).

Each line is judged by itself (punctuation, navigation, boilerplate, shouting
or symbols); failing lines go, and a document that loses too much of its text
with them is rejected. Everything is one projection over a row: no shuffle, and
a document's size bounds what a task holds.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of a document's word characters that failing lines may hold.
MAX_LOST = 0.5
MIN_WORDS = 50
#: Limits of a line: bars and symbols for each word, capitals among its characters.
MAX_BARS, MAX_SYMBOLS, MAX_CAPITALS = 0.2, 0.3, 0.6
SYMBOLS = "#*$%&|<>"
#: What a sentence or list entry ends with; lines of LONG words pass without it.
ENDS, LONG = ".!?:;,…\"”»)]", 8
BOILERPLATE = (
    "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved", "licensed under", "copyright (c)",
    "enable javascript", "subscribe to our", "sign in", "log in", "click here", "read more", "share this", "skip to content", "lorem ipsum",
    "alle rechte vorbehalten", "hier klicken", "jetzt anmelden", "mehr lesen", "weiterlesen",
    "tous droits réservés", "cliquez ici", "lire la suite", "politique de confidentialité",
    "todos los derechos reservados", "haga clic aquí", "leer más", "política de privacidad",
)
#: Share of a line's words that boilerplate phrases may hold.
MAX_BOILERPLATE = 0.2
_BLANK = r"[ \t-\r]"
_WORD = r"[^ \t-\r]"


def _words(text: str) -> str:
    return rf"filter(split({text}, '{_BLANK}+', -1), w -> w <> '')"


def _repeated(words: str) -> str:
    """Words that lie in a 3-word window found twice or more: sort (hash, place), keep places with an equal neighbour, measure their union."""
    return f"""transform(array({words}), w -> if(size(w) < 4, 0, transform(array(
      sort_array(transform(sequence(0, size(w) - 3), i -> named_struct('h', xxhash64(get(w, i), get(w, i + 1), get(w, i + 2)), 'i', i)))), s ->
      transform(array(sort_array(array_distinct(flatten(filter(
        zip_with(slice(s, 1, size(s) - 1), slice(s, 2, size(s) - 1), (a, b) -> if(a.h = b.h, array(a.i, b.i), null)), x -> x is not null))))), p ->
        if(size(p) = 0, 0, aggregate(zip_with(p, concat(array(-3), slice(p, 1, size(p) - 1)), (a, b) -> least(3, a - b)), 0, (x, y) -> x + y)))[0])[0]))[0]"""


def _phrase_words(line: str) -> str:
    """Words of ``line`` (lower case) that lie in boilerplate phrases; a phrase starts and ends with the words around it."""
    spaced = rf"concat(' ', regexp_replace({line}, r'[^\p{{L}}\p{{N}}]+', '  '), ' ')"
    return rf"transform(array({spaced}), s -> {' + '.join(_count('s', x) for x in BOILERPLATE)})[0]"


def _spaced(phrase: str) -> str:
    """The phrase as it stands in a line whose words have two blanks between them."""
    return f" {'  '.join(re.findall(r'[^\W_]+', phrase))} "


def _count(text: str, phrase: str) -> str:
    """Words that a phrase covers: how often taking it out shortens the text by its length."""
    p = _spaced(phrase)
    return f"(length({text}) - length(replace({text}, '{p}', ''))) / {len(p)} * {len(p.split())}"


def line_verdict(line: str) -> str:
    """SQL boolean: a line that holds a word passes. Blanks at its end (a carriage return among them) do not count."""
    marks = " or ".join(f"contains(m, '{x}')" for x in BOILERPLATE)
    return rf"""transform(array(regexp_count({line}, '{_WORD}+')), n ->
      (n >= {LONG} or contains('{ENDS}', right(trim(TRAILING ' \t\n\u000b\f\r' FROM {line}), 1)))
      and regexp_count({line}, '[|>»]') <= {MAX_BARS} * n
      and regexp_count({line}, '[{SYMBOLS}]') <= {MAX_SYMBOLS} * n
      and (n < 5 or regexp_count({line}, r'\p{{Lu}}') <= {MAX_CAPITALS} * char_length({line}))
      and transform(array(lower({line})), m -> not ({marks}) or {_phrase_words('m')} <= {MAX_BOILERPLATE} * n)[0])[0]"""


def quality_rules(docs: DataFrame, max_lost: float = MAX_LOST) -> DataFrame:
    """One row for each row of ``docs``: base counts, failing lines, verdict and the cleaned text.

    A null text counts as empty: all counts 0, base_failed true. Lines that hold
    no word are neither judged nor duplicates. A very long text is one row whose
    words are an array. Ties (a share at its limit) pass, and repeated rows are
    judged alike, each row by itself; other columns of ``docs`` are ignored; an
    empty table gives no rows.
    """
    out = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    out = out.select(
        "doc_id",
        "t",
        F.expr(_words("t")).alias("words"),
        F.expr(f"filter(split(t, '\\n', -1), l -> l rlike '{_WORD}')").alias("lines"),
    )
    out = out.select(
        "doc_id",
        "t",
        F.size("words").cast("long").alias("n_words"),
        F.expr("aggregate(words, 0L, (x, w) -> x + char_length(w))").alias("word_chars"),
        F.expr(f"regexp_count(t, '[{SYMBOLS}]')").cast("long").alias("n_symbols"),
        F.expr("size(lines) - size(array_distinct(lines))").cast("long").alias("n_dup_lines"),
        F.expr(_repeated("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.expr(f"filter(lines, l -> {line_verdict('l')})").alias("good"),
    )
    out = out.withColumn("kept_chars", F.expr(f"aggregate(good, 0L, (x, l) -> x + char_length(l) - regexp_count(l, '{_BLANK}'))"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("kept_chars") >= (1 - max_lost) * F.col("word_chars"))).alias("kept"),
        F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("n_lines") - F.size("good")).cast("long").alias("n_failed_lines"),
        "kept_chars",
        F.array_join("good", "\n").alias("clean_text"),
    )


_COUNT_WORDS = " + ".join(_count("spaced", x) for x in BOILERPLATE)
_MARKS = " OR ".join(f"contains(lower(line), '{x}')" for x in BOILERPLATE)
ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols FROM d),
x AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM w),
n AS (
  SELECT *, lead(word, 1) OVER p AS word2, lead(word, 2) OVER p AS word3 FROM x WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
again AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, word, word2, word3) AS c FROM n WHERE word3 IS NOT NULL) WHERE c > 1),
r AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY doc_id),
l AS (
  SELECT * FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
m AS (
  SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n, regexp_replace(line, '[\x20\x09-\x0D]+$', '') AS body,
         ' ' || regexp_replace(lower(line), '[^\p{{L}}\p{{N}}]+', '  ', 'g') || ' ' AS spaced FROM l),
v AS (
  SELECT doc_id, line, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
         (n >= {LONG} OR contains('{ENDS}', right(body, 1)))
         AND length(line) - length(translate(line, '|>»', '')) <= {MAX_BARS} * n
         AND length(line) - length(translate(line, '{SYMBOLS}', '')) <= {MAX_SYMBOLS} * n
         AND (n < 5 OR len(regexp_extract_all(line, '\p{{Lu}}')) <= {MAX_CAPITALS} * length(line))
         AND (NOT ({_MARKS}) OR {_COUNT_WORDS} <= {MAX_BOILERPLATE} * n) AS good FROM m),
g AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (WHERE NOT good) AS n_failed_lines,
         coalesce(sum(chars) FILTER (WHERE good), 0) AS kept_chars FROM v GROUP BY doc_id),
f AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_failed_lines, 0) AS n_failed_lines, coalesce(kept_chars, 0) AS kept_chars
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id LEFT JOIN g ON w.doc_id = g.doc_id),
b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND kept_chars >= {1 - MAX_LOST} * word_chars AS kept,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(n_failed_lines AS BIGINT) AS n_failed_lines, CAST(kept_chars AS BIGINT) AS kept_chars FROM b
"""

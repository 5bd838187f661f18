"""Line dedup by content-defined chunks of lines (operator 1, DataFrame functions only).

Lines are hashed; a rolling hash of the last WINDOW line hashes marks a line as a
candidate boundary, so equal runs of lines get equal candidates wherever they
stand. Of candidates on neighbouring lines only the first ends a chunk, and the
last chunk takes a single line left over, so that a chunk has two lines or more
(but for a text of one). Chunks that occur twice or more are found by hash,
compared by their text, and removed everywhere but at their first place (smallest
doc_id, then line). Lines without a word belong to the chunk around them and do
not count as lines of it; a chunk of fewer than two worded lines stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import OWN, join_dealt, materialize, named

#: A line in so many is a candidate boundary.
ONE_IN = 2
#: Lines that the rolling hash spans; its base and modulus (2**31 - 1, so that low bits depend on all lines).
WINDOW, BASE, MODULUS = 3, 1103515245, 2147483647
#: Hash by which repeated bodies are found, and digest by which they are brought together before their bytes are compared.
BODY_HASH, DIGEST = "xxhash64({body})", "md5(body)"
_WORDED = "l -> l rlike '[^ \\t-\\r]'"


def chunks(one_in: int = ONE_IN) -> str:
    """SQL array of (s, e), first and last line of each chunk of the array ``lines``.

    Hashes and boundaries are those of the worded lines alone, so blank lines
    between do not move them; ``at`` gives their places among all lines.
    """
    rolled = f"((h[i] * {BASE} + if(i < 1, 0, h[greatest(i - 1, 0)])) % {MODULUS} * {BASE} + if(i < 2, 0, h[greatest(i - 2, 0)])) % {MODULUS}"
    ends = f"filter(sequence(0, size(h) - 1), i -> i = size(h) - 1 or (i > 0 and i < size(h) - 2 and c[i] and not (i > 1 and c[greatest(i - 1, 0)])))"
    return f"""if(size(at) = 0, array(), transform(array(transform(at, a -> cast(conv(substr(md5(cast(lines[a] as binary)), 1, 7), 16, 10) as bigint))), h ->
      transform(array(transform(sequence(0, size(h) - 1), i -> {rolled} % {one_in} = 0)), c ->
        transform(array({ends}), e ->
          zip_with(concat(array(-1), slice(e, 1, size(e) - 1)), e, (p, q) -> named_struct('s', at[p + 1], 'e', at[q], 'n', q - p)))[0])[0])[0])"""


def line_dedup(docs: DataFrame, one_in: int = ONE_IN) -> DataFrame:
    """``docs`` with removed chunks taken out of ``text``, and n_lines, n_removed_lines.

    A null text stays null, an empty one is a single line that is never removed.
    A very long text is an array of lines in its row; its chunks leave as rows of
    their own. Rows that share doc_id and text are one document and keep a chunk
    alike; rows that share a doc_id only are documents of their own, told apart by
    a 64-bit hash of the text. A row without a doc_id keeps its text. Ties cannot
    be: of equal chunks in a document the first line's is kept. All other columns
    pass through (but for those named like the two added); an empty table gives no
    rows.
    """
    text_id = F.xxhash64("text")
    held = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id"), text_id.alias("t"), F.split("text", "\n", -1).alias("lines"))
    at = F.expr(f"filter(sequence(0, size(lines) - 1), i -> lines[i] rlike '[^ \\t-\\r]')")
    found = held.withColumn("at", at).select("doc_id", "t", "lines", F.explode(F.expr(f"filter({chunks(one_in)}, c -> c.n > 1)")).alias("c"))
    body = f"filter(slice(lines, c.s + 1, c.e - c.s + 1), {_WORDED})"
    found = found.select("doc_id", "t", "c.s", "c.e", F.expr(BODY_HASH.format(body=body)).alias("k"))
    again = materialize(found.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    places = join_dealt(found, again, ["k"], "n").groupBy(F.col("doc_id").alias("d"), F.col("t").alias("dt")).agg(F.collect_set(F.struct("s", "e", "k")).alias("places"))
    # places and gone grow with the documents: a merge join at every size, never a broadcast of them
    bodies = held.join(places.hint("merge"), (F.col("doc_id") == F.col("d")) & (F.col("t") == F.col("dt"))).select("doc_id", "t", "lines", F.explode("places").alias("c"))
    bodies = bodies.select("doc_id", "t", "c.s", "c.e", "c.k", F.expr(f"array_join({body}, '\n')").alias("body"))
    bodies = materialize(bodies.withColumn("h", F.expr(DIGEST)), "bodies")
    place = F.struct("doc_id", "t", "s")
    # bytes are compared where a group's least and greatest body meet; only digests are dealt and broadcast
    groups = bodies.groupBy("k", "h").agg(F.min(place).alias("first"), F.count("*").alias("n"), (F.min("body") == F.max("body")).alias("same")).where("n > 1")
    groups = materialize(groups, "groups")
    later = join_dealt(bodies.drop("body"), groups.where("same").drop("same"), ["k", "h"], "n").where(place != F.col("first")).select("doc_id", "t", "s", "e")
    unlike = groups.where("not same").select("k", "h")
    if unlike.limit(1).count():  # different bodies of one digest: each is a group of its own
        some = bodies.join(unlike, ["k", "h"])
        first = some.groupBy("k", "h", "body").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        later = later.union(some.join(first.hint("merge"), ["k", "h", "body"]).where(place != F.col("first")).select("doc_id", "t", "s", "e"))
    of, of_text, spans = f"{OWN}of", f"{OWN}of_text", f"{OWN}gone"
    gone = later.groupBy(F.col("doc_id").alias(of), F.col("t").alias(of_text)).agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias(spans))
    out = docs.join(materialize(gone, "gone").hint("merge"), (docs.doc_id == F.col(of)) & (F.xxhash64(docs.text) == F.col(of_text)), "left")
    text = docs["text"]
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda line, i: ~F.exists(F.col(spans), lambda r: i.between(r.s, r.e))), "\n")
    return out.select(
        *named(docs, {"text": F.when(F.col(spans).isNull(), text).otherwise(kept)}, ("n_lines", "n_removed_lines")),
        F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.aggregate(spans, F.lit(0).cast("long"), lambda x, r: x + r.e - r.s + 1), F.lit(0)).alias("n_removed_lines"),
    )


ORACLE_SQL = f"""
WITH l AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
x AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i, len(lines) AS n_lines FROM l),
w AS (
  SELECT *, CAST(('0x' || substr(md5(line), 1, 7)) AS BIGINT) AS h,
         row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS j, count(*) OVER (PARTITION BY doc_id) AS n
  FROM x WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
c AS (
  SELECT *, ((h * {BASE} + coalesce(lag(h, 1) OVER p, 0)) % {MODULUS} * {BASE} + coalesce(lag(h, 2) OVER p, 0)) % {MODULUS} % {ONE_IN} = 0 AS candidate
  FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY j)),
b AS (
  SELECT *, CASE WHEN j = n - 1 OR (j > 0 AND j < n - 2 AND candidate AND NOT (j > 1 AND lag(candidate) OVER (PARTITION BY doc_id ORDER BY j))) THEN 1 ELSE 0 END AS ends FROM c),
g AS (
  SELECT *, coalesce(sum(ends) OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM b),
k AS (
  SELECT doc_id, min(i) AS s, max(i) AS e, count(*) AS full_lines, string_agg(line, chr(10) ORDER BY j) AS body FROM g GROUP BY doc_id, chunk),
r AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS place FROM k WHERE full_lines > 1),
t AS (
  SELECT x.doc_id, string_agg(x.line, chr(10) ORDER BY x.i) FILTER (WHERE r.s IS NULL) AS text, count(*) AS n_lines, count(r.s) AS n_removed_lines
  FROM x LEFT JOIN r ON r.place > 1 AND r.doc_id = x.doc_id AND x.i BETWEEN r.s AND r.e GROUP BY x.doc_id)
SELECT doc_id, coalesce(text, '') AS text, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed_lines AS BIGINT) AS n_removed_lines FROM t
"""

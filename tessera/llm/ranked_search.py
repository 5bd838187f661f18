"""Ranked lexical search of many items over all documents by a threshold-seeded join (operator 12).

1. Items are cut into terms; the slots of a fixed bit table that their hashes take
   tell the scan of the documents which terms can matter (a few others pass and
   are dropped by a join). Each document leaves as its number of terms and its
   counted terms; no text is kept.
2. A term stores its document frequency and its ``k`` greatest impacts with their
   documents. An item's seeds are the documents stored for its terms: their exact
   scores, and k times repeated the kth impact of a single term, bound the item's
   kth score from below.
3. An item's terms in ascending order of the most that they can add: those whose
   bounds together stay below that threshold cannot bring a document to it by
   themselves, so only postings of the other terms make candidates. A candidate
   whose partial score and the pruned terms' bounds stay below it goes, too.
4. What is left is scored exactly, over all terms of the item.

Every bound is safe: a document goes only where k others score higher, so results
are those of scoring all pairs, which never exist. Frequent terms are pruned first
by their nature; one that stays is joined through a checked broadcast or, beyond
its size, by a merge join whose skewed partitions Spark splits.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import enter, materialize, table, text_bytes

#: Documents returned for an item.
TOP = 10
#: Saturation and length share of the score, as the contract's 8 / 1000 and 75 of 100; the scale of a term's share.
LENGTH_SHARE, SATURATION, SCALE = 75, 8, 1_000_000_000
#: Slots of the table that tells which terms can matter: so many bytes go to each worker, whatever the items are.
SLOTS = 1 << 21
#: Rows, and bytes of texts, of a table that is broadcast; one with more is joined by a shuffle.
SMALL, SMALL_BYTES = 50_000, 8 << 20
#: A-Z become lower case, other letters and digits and all of beyond ASCII stay, the rest separates.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def _counted(slots: bytes | None):
    """(id, text) -> (row, id, n, terms, counts); with ``slots``, only terms whose slot is taken."""

    def run(batches):
        from pyspark import TaskContext

        enter("search")
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            raw = data.tobytes().translate(_TERMS)
            n, terms, counts = [], [], []
            for a, b in zip(at[:-1], at[1:]):
                words = raw[a:b].split()
                found = Counter(words)
                if slots is not None:
                    found = {t: c for t, c in found.items() if slots[zlib.crc32(t) % SLOTS]}
                n.append(len(words))
                terms.append(list(found))
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(n))), batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64()))],
                names=["row", "id", "n", "terms", "counts"],
            )
            row += len(n)

    return run


_COUNTED_SQL = "row long, id long, n long, terms array<string>, counts array<long>"


def _join_small(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join; ``small`` is broadcast only after its rows and bytes are counted, else both sides are shuffled, where Spark splits what is skewed."""
    texts = [F.octet_length(c) for c, kind in small.dtypes if kind == "string"]
    n, size = small.agg(F.count("*"), F.coalesce(F.sum(sum(texts, F.lit(0))), F.lit(0))).first()
    return rows.join(F.broadcast(small) if n <= SMALL and size <= SMALL_BYTES else small.hint("merge"), keys)


def _first(rows: DataFrame, by: str, order: list, k: int, place: str) -> DataFrame:
    """The first ``k`` rows of each key in an order; tasks keep as many of their own before rows meet."""
    return rows.withColumn(place, F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col(place) <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's ``k`` highest-scoring documents.

    Fewer than ``k`` documents above score 0 are all returned; equal scores come by
    ascending doc_id. A null or empty text has no terms: such an item finds nothing,
    such a document counts in no figure. A very long text is one row whose counted
    terms are held by a task. Each row is a document or an item, repeated ones and
    those that share an id too (their ranks then repeat); a row without an id is
    none. Other columns are no inputs; an empty table gives no rows.
    """
    spark = docs.sparkSession
    asked = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long"), "text").mapInArrow(_counted(None), _COUNTED_SQL)
    asked = materialize(asked.select("row", "id", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select(F.col("row").alias("item"), F.col("id").alias("item_id"), F.col("t.terms").alias("term"), F.col("t.counts").alias("c")), "asked")
    slots = bytearray(SLOTS)
    for (slot,) in asked.select((F.crc32(F.col("term").cast("binary")) % SLOTS).cast("int")).distinct().toLocalIterator():  # at most SLOTS rows
        slots[slot] = 1
    shared = spark.sparkContext.broadcast(bytes(slots))

    def counted(batches):
        yield from _counted(shared.value)(batches)

    held = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(counted, _COUNTED_SQL)
    held = materialize(held.where("n > 0"), "held")
    n_docs, length = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return asked.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")

    def postings(rows: DataFrame) -> DataFrame:
        """(…, term, q): what an occurrence weight is multiplied with, of each counted term."""
        m = f"({100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * {n_docs}) div {length})"
        out = rows.select(*[c for c in rows.columns if c not in ("terms", "counts")], F.explode(F.arrays_zip("terms", "counts")).alias("t"))
        return out.withColumn("term", F.col("t.terms")).withColumn("q", F.expr(f"({SCALE} * t.counts) div (1000 * t.counts + {SATURATION} * {m})")).drop("t", "n")

    terms = asked.select("term").distinct()
    stats = postings(held).groupBy("term").agg(F.count("*").alias("df"), F.max("q").alias("most")).join(terms, "term", "left_semi")
    w = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1))).cast("long")
    stats = materialize(stats.select("term", w.alias("w"), "most"), "stats")
    tops = materialize(_first(postings(held).select("term", "q", "row"), "term", [F.desc("q"), "row"], k, "place").join(terms, "term", "left_semi"), "tops")
    weighted = materialize(asked.join(stats, "term").select("item", "item_id", "term", (F.col("c") * F.col("w")).alias("w"), F.expr("c * w * most").alias("bound")).where("w > 0"), "weighted")

    def scored(pairs: DataFrame) -> DataFrame:
        """(item, row, id, score) of the pairs (item, row), over all terms."""
        mine = postings(_join_small(held, pairs, ["row"]))
        return _join_small(mine, weighted.select("item", "term", "w"), ["item", "term"]).groupBy("item", "row", "id").agg(F.sum(F.expr("w * q")).alias("score"))

    seeds = weighted.join(tops, "term")
    single = seeds.where(F.col("place") == k).groupBy("item").agg(F.max(F.expr("w * q")).alias("least"))
    exact = scored(materialize(seeds.select("item", "row").distinct(), "seeds"))
    kth = _first(exact, "item", [F.desc("score"), "row"], k, "place").where(F.col("place") == k).select("item", F.col("score").alias("least"))
    least = materialize(single.union(kth).groupBy("item").agg(F.max("least").alias("least")), "least")
    # ascending bounds: a term is pruned while all up to it stay below the threshold
    upto = F.sum("bound").over(Window.partitionBy("item").orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0))
    plan = weighted.withColumn("upto", upto).join(least, "item", "left").fillna(0, ["least"]).withColumn("pruned", F.col("upto") < F.col("least"))
    rest = F.coalesce(F.max(F.when(F.col("pruned"), F.col("upto"))).over(Window.partitionBy("item")), F.lit(0))
    plan = materialize(plan.withColumn("rest", rest).where("not pruned").select("item", "term", "w", "rest", "least"), "plan")
    partial = _join_small(postings(held).select("row", "term", "q"), plan, ["term"]).groupBy("item", "row").agg(F.sum(F.expr("w * q")).alias("part"), F.first("rest").alias("rest"), F.first("least").alias("least"))
    pairs = materialize(partial.where("part + rest >= least").select("item", "row"), "pairs")
    best = _first(scored(pairs).where("score > 0"), "item", [F.desc("score"), "id", "row"], k, "rank")
    return best.join(asked.select("item", "item_id").distinct(), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_TERMS} AS words FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
l AS (SELECT doc_id, words, len(words) AS n FROM d WHERE len(words) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS nl FROM l),
p AS (SELECT doc_id, n, unnest(words) AS term FROM l),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL),
i AS (SELECT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
c AS (SELECT item_id, term, count(*) AS c FROM i GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term),
x AS (SELECT item_id, doc_id, sum(c * w * (({SCALE} * tf) // (1000 * tf + {SATURATION} * ({100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * nd) // nl)))) AS score
  FROM c JOIN tf USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= {TOP}
"""

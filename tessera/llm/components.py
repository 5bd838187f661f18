"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import join_dealt, materialize

#: Rounds before giving up; each at least halves the depth of a tree, so this is far beyond any table's need.
MAX_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node in ``edges``, the component being its smallest node.

    Minima are pre-aggregated map-side and a hub's edges are dealt over all tasks, so they never meet in one; each
    round's edges are a table in the shared folder, so that a lost executor costs one
    round at most. Loops and repeated edges are allowed; an empty table gives none.
    """
    now = materialize(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v").distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n"))
        large = join_dealt(both, least, ["u"], "n").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_dealt(large, low, ["u"], "n").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        after = materialize(small, "edges")
        # a star forest is a fixed point: every node has one edge, to a node that has none
        tops = after.select(F.col("v").alias("u")).distinct()
        left = after.groupBy("u").agg(F.count("*").alias("n"))
        if not left.where("n > 1").limit(1).count() and not after.join(tops, "u", "left_semi").limit(1).count():
            now = after
            break
        now = after
    else:
        raise RuntimeError("components did not converge")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""Merkle manifest of a dataset, with a proof for every row (operator 13).

A row's leaf is the SHA-256 of its fields, each behind its length. Leaves are
range-sorted over partitions by (group, order); the counts of each partition's
groups, and their prefix sums, number every leaf within its group, so no group
meets in one task. A partition then builds what complete aligned subtrees of FAN
it holds; the nodes that are left at its ragged ends, a few a level, are shuffled
by (group, level, place) and grouped into the upper levels, a level at a time.
The groups' roots, in order of the groups, are the leaves of one more tree of the
same kind. Paths come back the other way: from the root to the ragged nodes, and
within each partition from those to its leaves.

Digests are hex text, and a node is the digest of its children's texts, one after
another. ``folded`` recomputes a root from a leaf and its proof as an expression.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, table

#: Children of a node.
FAN = 8
#: Leaves of a sorted partition, about.
PART_ROWS = 200_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODES = pa.schema([("g", pa.string()), ("part", pa.int64()), ("level", pa.int32()), ("i", pa.int64()), ("h", pa.string()), ("n", pa.int64())])
_NODES_SQL = "g string, part long, level int, i long, h string, n long"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields' texts, each as its UTF-8 length, ``:`` and itself; a null one is ``-``."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def folded(leaf: Column | str, proof: Column | str) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(proof, F.col(leaf) if isinstance(leaf, str) else leaf, lambda h, p: F.sha2(F.concat(p.left, h, p.right), 256))


def _digest(texts: list[str]) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def local_levels(h: list[str], at: int, n: int) -> list[tuple[int, list[str], int, int]]:
    """Levels of what consecutive nodes ``at``, ``at`` + 1... of n give by themselves: (first place, nodes, a, b), where nodes[a:b] have their parents in the next level."""
    out = []
    while True:
        end = at + len(h)
        a = min(-(-at // FAN) * FAN, end)
        b = end if end == n else end // FAN * FAN
        if n == 1 or b <= a:
            return [*out, (at, h, 0, 0)]
        out.append((at, h, a - at, b - at))
        h = [_digest(h[j - at : min(j + FAN, b) - at]) for j in range(a, b, FAN)]
        at, n = a // FAN, -(-n // FAN)


def _ragged(group: pa.Table) -> pa.Table:
    """A partition's leaves of one group -> the nodes whose parents lie elsewhere."""
    group = group.sort_by("i")
    g, part, first, n = (group.column(c)[0].as_py() for c in ("g", "part", "i", "n"))
    rows = []
    for level, (at, h, a, b) in enumerate(local_levels(group.column("leaf").to_pylist(), first, n)):
        rows += [(g, part, level, at + j, h[j], n) for j in (*range(a), *range(b, len(h)))]
        n = -(-n // FAN)
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _NODES.types)], schema=_NODES)


def _proofs(leaves: pa.Table, ends: pa.Table) -> pa.Table:
    """A partition's leaves of one group, and the paths of its ragged nodes -> each leaf with the roots and its siblings from its level to the root."""
    leaves = leaves.sort_by("i")
    level, place, left, right = (ends.column(c).to_pylist() for c in ("level", "i", "left", "right"))
    above = {(k, i): (x, y) for k, i, x, y in zip(level, place, left, right)}
    levels = local_levels(leaves.column("leaf").to_pylist(), leaves.column("i")[0].as_py(), leaves.column("n")[0].as_py())
    paths: list[tuple[list[str], list[str]]] = []
    for k in range(len(levels) - 1, -1, -1):
        at, h, a, b = levels[k]
        here = []
        for j in range(len(h)):
            if a <= j < b:
                lo = j - (at + j) % FAN
                left, right = paths[(j - a) // FAN]
                here.append((["".join(h[lo:j]), *left], ["".join(h[j + 1 : min(lo + FAN, b)]), *right]))
            else:
                here.append(above[k, at + j])
        paths = here
    out = leaves.drop_columns(["g", "part", "i", "n", "row"])
    for c in ("subroot", "root"):
        out = out.append_column(c, pa.array([ends.column(c)[0].as_py()] * len(leaves), pa.string()))
    for k, c in enumerate(("left", "right")):
        out = out.append_column(c, pa.array([p[k] for p in paths], pa.list_(pa.string())))
    return out


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with part, i and n: the sorted partition, the place within the group ``g``, and the group's size.

    Places are a partition's own row numbers plus the counts of the partitions
    before it, of which a group has one for each partition.
    """
    spark = leaves.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-leaves.count() // PART_ROWS))
    keys = [F.col(c).asc_nulls_first() for c in ("g", *order, "row")]
    dealt = leaves.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    dealt = materialize(dealt.withColumn("part", F.shiftright("at", 33)), "sorted")
    counts = dealt.groupBy("g", "part").agg(F.count("*").alias("c"), F.min("at").alias("first"))
    before = "sum(c) over (partition by g order by part rows between unbounded preceding and current row) - c"
    counts = materialize(counts.select("g", "part", "first", F.expr(before).alias("before"), F.expr("sum(c) over (partition by g)").alias("n")), "counts")
    return dealt.join(counts, ["g", "part"]).withColumn("i", F.expr("before + at - first")).drop("at", "first", "before")


def _upper(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(runs by level, (g, level, h) of each group's root) from nodes (g, level, i, h, n) whose runs they fill together; n: nodes of that level."""
    most = nodes.agg(F.max(F.col("n") * F.pow(F.lit(float(FAN)), "level"))).first()[0] or 0
    runs, tops, made, level = [], None, None, 0
    while True:
        here = nodes.where(F.col("level") == level).select("g", "i", "h", "n")
        here = here if made is None else here.union(made)
        top = here.where("n = 1").select("g", F.lit(level).alias("level"), "h")
        tops = top if tops is None else tops.union(top)
        if most <= 1:
            return runs, tops
        kids = F.sort_array(F.collect_list(F.struct("i", "h"))).alias("kids")
        runs.append(materialize(here.where("n > 1").groupBy("g", F.expr(f"i div {FAN}").alias("up"), "n").agg(kids), "runs"))
        made = runs[-1].select("g", F.col("up").alias("i"), F.sha2(F.array_join("kids.h", ""), 256).alias("h"), F.ceil(F.col("n") / F.lit(FAN)).alias("n"))
        level, most = level + 1, -(-most // FAN)


def _paths(runs: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(g, level, i, left, right) of every node below the roots ``tops`` (g, level, left, right), and of these: siblings level by level."""
    level, out = len(runs), None
    above = tops.where(F.col("level") == level).select("g", F.lit(0).cast("long").alias("i"), "left", "right")
    while True:
        found = above.select("g", F.lit(level).alias("level"), "i", "left", "right")
        out = found if out is None else out.union(found)
        if not level:
            return out
        level -= 1
        kids = runs[level].join(above.withColumnRenamed("i", "up"), ["g", "up"]).select("g", "left", "right", "kids", F.posexplode("kids").alias("j", "kid"))
        joined = lambda part: F.array(F.array_join(F.expr(part), ""))
        kids = kids.select("g", "kid.i", F.concat(joined("slice(kids.h, 1, j)"), "left").alias("left"), F.concat(joined("slice(kids.h, j + 2, size(kids))"), "right").alias("right"))
        start = tops.where(F.col("level") == level).select("g", F.lit(0).cast("long").alias("i"), "left", "right")
        above = materialize(kids.union(start), "paths")


def merkle_proofs(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id", carry: dict[str, Column] | None = None) -> DataFrame:
    """(``order``, leaf, subroot, root, proof) of every row, and the expressions of ``carry`` under their names.

    proof: array of (left, right), the siblings' digests before and after the path
    at each level, empty where there are none; a group of one row has an empty
    proof within it. Rows of a group ascend by ``order``, null first; of equal ones
    the smaller leaf comes first, and equal leaves are one and the same row
    repeated, each with a place of its own. A group's null is a group, the first.
    Empty and very long texts are leaves like any other, and only digests leave
    the scan. Columns outside ``fields`` are no part of a leaf; an empty table
    gives no rows.
    """
    carry = carry or {}
    g = F.when(F.col(group).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(group).cast("string")))
    leaves = docs.select(g.alias("g"), F.col(order).alias("key"), leaf_digest([F.col(c) for c in fields]).alias("leaf"), *[c.alias(f"own_{k}") for k, c in carry.items()])
    leaves = materialize(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    rows = _numbered(leaves, ["key", "leaf"])
    nodes = materialize(rows.select("g", "part", "i", "leaf", "n").groupBy("part", "g").applyInArrow(_ragged, _NODES_SQL), "nodes")
    runs, tops = _upper(nodes)
    tops = materialize(tops, "tops")
    # the groups' roots are the leaves of the last tree
    heads = _numbered(tops.select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("h").alias("leaf"), F.col("level").alias("top"), F.lit(0).alias("row")), ["key"])
    heads = materialize(heads, "heads")
    last, root = _upper(heads.select("g", F.lit(0).alias("level"), "i", F.col("leaf").alias("h"), "n"))
    none = F.expr("cast(array() as array<string>)")
    root = root.select("g", "level", F.col("h").alias("root"), none.alias("left"), none.alias("right"))
    whole = _paths(last, root).where("level = 0").drop("g", "level")
    groups = materialize(heads.join(whole, "i").crossJoin(root.select("root")).select(F.col("key").alias("g"), F.col("top").alias("level"), F.col("leaf").alias("subroot"), "root", "left", "right"), "groups")
    paths = nodes.select("g", "part", "level", "i").join(_paths(runs, groups), ["g", "level", "i"]).join(groups.select("g", "subroot", "root"), "g")
    own = rows.drop("g", "part", "i", "n", "row").schema
    kind = T.StructType([*own.fields, *[T.StructField(c, T.StringType()) for c in ("subroot", "root")], *[T.StructField(c, T.ArrayType(T.StringType())) for c in ("left", "right")]])
    found = rows.groupBy("part", "g").cogroup(paths.groupBy("part", "g")).applyInArrow(_proofs, kind)
    return found.select(F.col("key").alias(order), "leaf", "subroot", "root", F.arrays_zip("left", "right").alias("proof"), *[F.col(f"own_{k}").alias(k) for k in carry])


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Proofs of all documents; of those whose id has a crc32 that 3 divides, the proof is held against a lower-cased text."""
    docs = table(spark, sf_dir, "documents")
    lower = {"text": F.translate("text", _LETTERS, _LETTERS.lower())}
    claim = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf_digest([lower.get(c, F.col(c)) for c in FIELDS])).otherwise(leaf_digest([F.col(c) for c in FIELDS]))
    out = merkle_proofs(docs, carry={"claim": claim}).withColumn("folded_root", folded("claim", "proof"))
    digest = F.sha2(F.array_join(F.transform("proof", lambda p: F.concat(p.left, p.right)), ""), 256)
    return out.select("doc_id", "leaf", "subroot", "root", digest.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: Levels that the SQL unrolls: groups of at most 8 ** 8 rows, and as many groups.
_SQL_LEVELS = 8


def _sql_tree(name: str, leaves: str, levels: int) -> str:
    """CTEs ``name``0... of (g, i, h, m) by level and ``name``_top of (g, h); a group that has come to one node stays as it is."""
    out = [f"{name}0 AS ({leaves})"]
    for k in range(levels):
        out.append(
            f"{name}{k + 1} AS (SELECT g, i // {FAN} AS i, CASE WHEN any_value(m) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, (any_value(m) + {FAN - 1}) // {FAN} AS m FROM {name}{k} GROUP BY g, i // {FAN})"
        )
        out.append(f"{name}s{k} AS (SELECT a.g, a.i, string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i) AS l, string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i) AS r FROM {name}{k} a JOIN {name}{k} b ON a.g = b.g AND a.i // {FAN} = b.i // {FAN} GROUP BY a.g, a.i)")
    return ",\n".join(out)


def _sql() -> str:
    field = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END"
    leaf = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in FIELDS) + ")"
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    crc = f"xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda s, x: list_reduce([xor(s, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {bit}), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"
    lines = [
        f"x AS (SELECT doc_id, coalesce('1' || lang, '0') AS g, {leaf('text')} AS leaf, {leaf(f"translate(text, '{_LETTERS}', '{_LETTERS.lower()}')")} AS low, {crc} % 3 = 0 AS odd FROM documents)",
        "d AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS m FROM x)",
        _sql_tree("a", "SELECT g, i, leaf AS h, m FROM d", _SQL_LEVELS),
        f"t AS (SELECT '' AS g, g AS own, row_number() OVER (ORDER BY encode(g)) - 1 AS i, h, count(*) OVER () AS m FROM a{_SQL_LEVELS})",
        _sql_tree("b", "SELECT g, i, h, m FROM t", _SQL_LEVELS),
        f"p0 AS (SELECT d.doc_id, d.leaf, CASE WHEN d.odd THEN d.low ELSE d.leaf END AS f, '' AS proof, d.g, d.i, d.m, t.h AS subroot, t.i AS ti, t.m AS tm, b{_SQL_LEVELS}.h AS root FROM d JOIN t ON d.g = t.own CROSS JOIN b{_SQL_LEVELS})",
    ]
    for n in range(2 * _SQL_LEVELS):
        # up the tree of the row's group, then up that of the groups
        name, g, i, m, rest = ("a", f"p{n}.g", "i", "m", "ti, tm") if n < _SQL_LEVELS else ("b", "''", "ti", "tm", f"p{n}.i, p{n}.m")
        last = f"{m} = 1"
        lines.append(
            f"p{n + 1} AS (SELECT doc_id, leaf, subroot, root, p{n}.g, CASE WHEN {last} THEN f ELSE sha256(coalesce(l, '') || f || coalesce(r, '')) END AS f, "
            f"proof || CASE WHEN {last} THEN '' ELSE coalesce(l, '') || coalesce(r, '') END AS proof, p{n}.{i} // {FAN} AS {i}, (p{n}.{m} + {FAN - 1}) // {FAN} AS {m}, {rest} "
            f"FROM p{n} JOIN {name}s{n % _SQL_LEVELS} s ON s.g = {g} AND s.i = p{n}.{i})"
        )
    return "WITH " + ",\n".join(lines) + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM p{2 * _SQL_LEVELS}"


ORACLE_SQL = _sql()

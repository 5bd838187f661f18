"""N-gram Jaccard join with adaptive multi-match prefixes (operator 10).

Exact set-similarity join of documents on distinct 5-word shingles at a
similarity of 0.75 or more:

1. One pass over the texts hashes every shingle. Tokens are dealt by hash range
   in blocks of arrays, so that a task counts the documents of about a million
   tokens; it answers each block with those tokens only that two documents or
   more share. What only one document has can link nothing.
2. Equal sets collapse into one class. A class's prefix in rare-first order
   (unshared tokens first) must hold a token of each partner's prefix; classes
   whose unshared tokens fill the prefix drop out here, which is most of them.
3. Classes that meet in prefix tokens form families (connected components). Where
   a token is so frequent that its family is large, and lengthening costs less
   than the pairs it saves, the classes of that family lengthen their prefixes by
   one token and must share two: a frequent token meets nobody by itself, only
   together with another token of the longer prefix. What falls apart so is
   dealt as several families.
4. A family is joined in blocks of classes; within a pair of blocks each class
   picks how far to lengthen its prefix by estimated cost and verifies only
   partners with as many shared prefix tokens as that length asks for.
5. A block pair returns a spanning forest of its links and each class's number
   of links, never the pairs; components of the forests are the groups.

Nothing is capped, sampled or collected; blocks bound each task's memory. Tokens
are 64-bit hashes and are not compared below them: of s different shingles some
s * s / 2**65 pairs coincide (less than one at 30 GB of text), and one matters
only where it lifts a pair of documents over the threshold. A very long text is
one set, which a task holds while it is hashed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import OWN, documents, enter, join_dealt, materialize, mix, slices, text_bytes
from tessera.llm.components import components
from tessera.llm.shingles import shingle_sets

#: Similarity as a fraction: 100 * intersection >= 75 * union.
SIMILARITY = (75, 100)
#: Tokens (hash range) that one counting group holds, and tokens of one block of documents.
GROUP_TOKENS, BLOCK_TOKENS, BLOCK_DOCS = 1_000_000, 500_000, 60_000
#: A block of a family has so many classes; beyond MOST_BLOCKS of them blocks grow, up to LARGE classes or so many bytes of tokens.
FAMILY_BLOCK, MOST_BLOCKS, LARGE, FAMILY_BYTES = 256, 64, 4096, 32 << 20
#: Families above so many blocks of classes may ask for a second match of tokens that more classes than they hold share.
FREQUENT = 1
#: Lengths that a prefix may be extended to, and shared tokens then required.
MATCHES = (1, 2, 4, 8, 16, 32)
_REQUESTS = pa.schema([("part", pa.int64()), ("phase", pa.int32()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])
_REQUESTS_SQL = "part long, phase int, block long, a binary, b binary"
_ANSWERS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_ANSWERS_SQL = "block long, kind int, a binary, b binary, c binary"
_SETS_SQL = "doc_id long, text_id long, n long, d0 long, d1 long, tokens binary"


def _planes(x: np.ndarray) -> bytes:
    """Numbers as bytes, all lowest bytes first: planes of small numbers' high bytes are zeros, which shuffles compress."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _numbers(raw: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _steps(tokens: np.ndarray) -> bytes:
    """Ascending tokens as planes of their differences."""
    return _planes(np.diff(tokens, prepend=np.uint64(0)))


def _climbed(raw: bytes) -> np.ndarray:
    return np.cumsum(_numbers(raw, np.uint64), dtype=np.uint64)


def least_overlap(n: np.ndarray, similarity: tuple[int, int] = SIMILARITY) -> np.ndarray:
    """Tokens that a set of size n shares with any partner at least: ceil(t * n)."""
    return -(-np.asarray(n, np.int64) * similarity[0] // similarity[1])


def _ask(parts: int):
    """docs (doc_id, text, text_id) -> token requests by part, in blocks."""

    def run(batches):
        from pyspark import TaskContext

        enter("jaccard requests")
        task, serial = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        of_text: list[int] = []
        sets: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal ids, of_text, sets, held, serial
            block = task << 32 | serial
            serial += 1
            n = np.array([len(s) for s in sets], np.int64)
            digests = b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets)
            rows = [(block % parts, 2, block, np.array([ids, of_text, n], np.int64).tobytes(), digests)]
            tokens = np.concatenate(sets)
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], np.repeat(np.arange(len(sets), dtype=np.uint16), n)[order]
            if len(tokens):
                new = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
                count = np.diff(np.append(new, len(tokens))).astype(np.uint16)
                distinct = tokens[new]
                part = ((distinct >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
                ends = np.append(new, len(tokens))
                for a, b in zip(cuts[:-1], cuts[1:]):
                    p = int(part[a])
                    rows.append((p, 0, block, _steps(distinct[a:b]), _planes(count[a:b])))
                    rows.append((p, 1, block, _planes(owner[ends[a] : ends[b]]), b""))
            ids, of_text, sets, held = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _REQUESTS.types)], schema=_REQUESTS)

        for batch in batches:
            doc, text_id = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            data, offsets = text_bytes(batch.column(1))
            for i, j in slices(offsets):
                part = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                for k, s in zip(range(i, j), part):
                    ids.append(int(doc[k]))
                    of_text.append(int(text_id[k]))
                    sets.append(s)
                    held += len(s)
                    if held >= BLOCK_TOKENS or len(ids) >= BLOCK_DOCS:
                        yield flush()
        if ids:
            yield flush()

    return run


def _answer(batches):
    """Requests sorted by (part, phase, block) -> per block its postings of tokens that two documents share.

    Phase 0 counts: each token comes once a block, however many documents have it.
    Phase 1 streams the documents past the counts.
    """
    enter("jaccard answers")
    part, asked, shared = None, {}, None

    def closed():
        tokens = np.concatenate([t for t, _ in asked.values()])
        count = np.concatenate([c for _, c in asked.values()]).astype(np.int64)
        order = np.argsort(tokens, kind="stable")
        tokens, count = tokens[order], count[order]
        new = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        total = np.add.reduceat(count, new)  # clipped below: it only ranks tokens
        return tokens[new][total > 1], np.minimum(total[total > 1], 0xFFFFFFFF).astype(np.uint32)

    for batch in batches:
        rows = []
        for p, phase, block, a, b in zip(*(c.to_pylist() for c in batch.columns)):
            if p != part:
                part, asked, shared = p, {}, None
            if phase == 0:
                asked[block] = _climbed(a), _numbers(b, np.uint16)
            elif phase == 1:
                if shared is None:
                    shared = closed()
                tokens, count = asked.pop(block)
                if not len(shared[0]):
                    continue
                at = np.minimum(np.searchsorted(shared[0], tokens), len(shared[0]) - 1)
                hit = shared[0][at] == tokens
                if hit.any():
                    owners = _numbers(a, np.uint16)[np.repeat(hit, count)]
                    rows.append((block, 0, _planes(owners), _steps(np.repeat(tokens[hit], count[hit])), _planes(np.repeat(shared[1][at[hit]], count[hit]))))
            else:
                rows.append((block, 1, a, b, b""))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ANSWERS.types)], schema=_ANSWERS)


def _assemble(similarity: tuple[int, int]):
    """A block's answers -> a row for each document; tokens: its shared ones in rare-first order, where they reach into the prefix."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        enter("jaccard sets")
        info = group[group.kind == 1].iloc[0]
        ids, of_text, n = np.frombuffer(info.a, np.int64).reshape(3, -1)
        digests = np.frombuffer(info.b, np.int64).reshape(-1, 2)
        told = group[group.kind == 0]
        owner = np.concatenate([_numbers(x, np.uint16) for x in told.a] or [np.zeros(0, np.uint16)])
        token = np.concatenate([_climbed(x) for x in told.b] or [np.zeros(0, np.uint64)])
        df = np.concatenate([_numbers(x, np.uint32) for x in told.c] or [np.zeros(0, np.uint32)])
        order = np.lexsort((token, df, owner))
        token = token[order]
        cuts = np.searchsorted(owner[order], np.arange(len(ids) + 1))
        prefix = n - least_overlap(n, similarity) + 1
        reach = (n > 0) & (prefix > n - np.diff(cuts))
        blobs = [token[a:b].tobytes() if r else None for a, b, r in zip(cuts[:-1], cuts[1:], reach)]
        return pd.DataFrame({"doc_id": ids, "text_id": of_text, "n": n, "d0": digests[:, 0], "d1": digests[:, 1], "tokens": pd.Series(blobs, dtype=object)})

    return run


def text_id() -> Column:
    """What tells rows of one doc_id apart: a hash of the text."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def shingle_table(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """(doc_id, text_id, n, d0, d1, tokens) of each document: hash of the text, set size, digest of the set, and shared tokens if a partner is possible."""
    spark = docs.sparkSession
    docs = documents(docs).withColumn("text_id", text_id())
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    deal = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(deal, -(-size // (6 * GROUP_TOKENS)))
    asked = docs.mapInArrow(_ask(parts), _REQUESTS_SQL)
    answers = asked.repartition(deal, "part").sortWithinPartitions("part", "phase", "block").mapInArrow(_answer, _ANSWERS_SQL)
    return answers.groupBy("block").applyInPandas(_assemble(similarity), _SETS_SQL)


def _prefix(tokens: np.ndarray, n: int, similarity: tuple[int, int], matches: int = 1) -> np.ndarray:
    """Shared tokens in the prefix in which partners share at least so many tokens."""
    return tokens[: max(0, int(n - least_overlap(n, similarity) + matches - (n - len(tokens))))]


def _prefixes(similarity: tuple[int, int]):
    """Classes (rep, n, tokens) -> (token, rep) for the shared tokens of each class's prefix."""

    def run(batches):
        enter("jaccard prefixes")
        for batch in batches:
            reps = batch.column(0).to_numpy(zero_copy_only=False)
            kept = [_prefix(np.frombuffer(x, np.int64), n, similarity) for n, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*kept, np.zeros(0, np.int64)])), pa.array(np.repeat(reps, [len(k) for k in kept]))], names=["token", "rep"])

    return run


def _lengthened(similarity: tuple[int, int]):
    """Classes (rep, n, tokens, frequent) -> (token, rep): tokens of the prefix, but for a frequent one its pairs with each other token of the prefix that two matches ask for.

    A set of one token links with none but its copies and has no row.
    """

    def run(batches):
        for batch in batches:
            for rep, n, raw, frequent in zip(*(c.to_pylist() for c in batch.columns)):
                if n < 2:
                    continue
                tokens = np.frombuffer(raw, np.int64)
                mine, longer = _prefix(tokens, n, similarity), _prefix(tokens, n, similarity, 2).view(np.uint64)
                often = np.isin(mine, np.array(frequent or [], np.int64))
                out = [mine[~often]]
                for t in mine[often].view(np.uint64):
                    other = longer[longer != t]
                    out.append(mix(np.minimum(other, t) * np.uint64(0x9E3779B97F4A7C15) + mix(np.maximum(other, t))).view(np.int64))
                found = np.unique(np.concatenate(out))
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), rep, np.int64))], names=["token", "rep"])

    return run


def _families(posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((rep, component) of classes that meet in tokens, (token, head, df) of the tokens they meet in)."""
    heads = materialize(posts.groupBy("token").agg(F.min("rep").alias("head"), F.count("*").alias("df")).where("df > 1"), "heads")
    return materialize(components(join_dealt(posts, heads, ["token"], "df").select("head", "rep"), "head", "rep").withColumnRenamed("node", "rep"), "families"), heads


def _members(able: DataFrame, similarity: tuple[int, int], many: int) -> DataFrame:
    """(component, rep, n, tokens): classes by family; frequent tokens of large families ask for a second match where that costs less than the pairs."""
    posts = materialize(able.mapInArrow(_prefixes(similarity), "token long, rep long"), "posts")
    families, heads = _families(posts)
    members = materialize(able.join(families, "rep").select("component", "rep", "n", "tokens"), "members")
    large = materialize(members.groupBy("component").agg(F.count("*").alias("size")).where(F.col("size") > many).withColumn("large", F.lit(True)), "large")
    if not large.limit(1).count():
        return members
    split = join_dealt(members, large, ["component"], "size", "left")
    big = materialize(split.where("large").drop("large"), "big")
    own = big.select("rep", "n", "tokens").mapInArrow(_prefixes(similarity), "token long, rep long")
    frequent = join_dealt(own, heads.where(F.col("df") > many).select("token", "df"), ["token"], "df").groupBy("rep").agg(F.collect_set("token").alias("frequent"))
    told = materialize(big.join(frequent, "rep", "left"), "told")
    cost = F.coalesce(F.size("frequent"), F.lit(0)).cast("double") * F.octet_length("tokens") / 8
    gain = told.groupBy("component").agg(F.count("*").alias("size"), F.sum(cost).alias("cost"), F.max(F.size("frequent")).alias("most"))
    gain = gain.where("most > 0 and cost < size * size / 2").select("component", "size", F.lit(True).alias("longer"))
    told = materialize(join_dealt(told, materialize(gain, "gain"), ["component"], "size", "left"), "told")
    anew, _ = _families(materialize(told.where("longer").select("rep", "n", "tokens", "frequent").mapInArrow(_lengthened(similarity), "token long, rep long"), "posts"))
    out = [split.where("large is null"), told.where("longer is null"), told.where("longer").drop("component").join(anew, "rep")]
    first, *rest = [x.select("component", "rep", "n", "tokens") for x in out]
    for x in rest:
        first = first.union(x)
    return materialize(first, "members")


def adaptive_links(n_a, tokens_a, n_b=None, tokens_b=None, similarity: tuple[int, int] = SIMILARITY):
    """Links (i, j) between sets a and b, or within a (i < j): sizes, and shared tokens as int arrays.

    Tokens are ranked rare-first within the block pair. For a probing set the
    prefix length with the least cost, scanned postings plus expected
    verifications, is taken from MATCHES; partners must share as many tokens.
    """
    own = n_b is None
    if own:
        n_b, tokens_b = n_a, tokens_a
    n_a, n_b = np.asarray(n_a, np.int64), np.asarray(n_b, np.int64)
    size_a, size_b = (np.array([len(t) for t in x], np.int64) for x in (tokens_a, tokens_b))
    everything = np.concatenate([*tokens_b, *tokens_a, np.zeros(0, np.int64)])
    _, name, df = np.unique(everything, return_inverse=True, return_counts=True)
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(df, kind="stable")] = np.arange(len(df))
    name = rank[name]
    cut = int(size_b.sum())

    def ordered(flat, size):
        owner = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((flat, owner))
        start = np.concatenate([[0], np.cumsum(size)])
        return flat[order], owner, np.arange(len(flat)) - start[owner], start

    flat_b, owner_b, place_b, _ = ordered(name[:cut], size_b)
    flat_a, _, _, start_a = ordered(name[cut:], size_a)
    # the length from which a posting is in its set's prefix: 1 for the plain prefix
    since = np.maximum(1, place_b + 1 + (n_b - size_b)[owner_b] - (n_b - least_overlap(n_b, similarity))[owner_b])
    order = np.lexsort((since, flat_b))
    post_owner, post_since, post_token = owner_b[order], since[order], flat_b[order]
    post_at = np.searchsorted(post_token, np.arange(len(df) + 1))
    mean = max(1.0, float(size_a.mean())) if len(size_a) else 1.0
    out = []
    low, high = similarity
    for i in range(len(n_a)):
        mine = flat_a[start_a[i] : start_a[i + 1]]
        base = int(n_a[i] - least_overlap(n_a[i : i + 1], similarity)[0] - (n_a[i] - size_a[i]))
        length = post_at[mine + 1] - post_at[mine]
        scanned = np.concatenate([[0], np.cumsum(length)])
        best = None
        for k in MATCHES:
            if k > 1 and base + k > len(mine):
                break
            scan = int(scanned[max(0, min(len(mine), base + k))])
            cost = scan + mean * scan / k
            if best is None or cost < best[0]:
                best = cost, k
        k = best[1]
        prefix = mine[: max(0, base + k)]
        if not len(prefix):
            continue
        span = np.concatenate([np.arange(post_at[t], post_at[t + 1]) for t in prefix])
        span = span[post_since[span] <= k]
        shared = np.bincount(post_owner[span], minlength=len(n_b))
        found = np.flatnonzero(shared >= k)
        found = found[(found > i) if own else (found >= 0)]
        found = found[(n_b[found] * high >= low * n_a[i]) & (n_a[i] * high >= low * n_b[found])]
        if not len(found):
            continue
        span = np.concatenate([np.arange(post_at[t], post_at[t + 1]) for t in mine])
        overlap = np.bincount(post_owner[span], minlength=len(n_b))[found]
        linked = found[high * overlap >= low * (n_a[i] + n_b[found] - overlap)]
        out += [(i, int(j)) for j in linked]
    return out


def _join_blocks(similarity: tuple[int, int]):
    """One pair of a family's blocks -> links of its classes: forest edges (a, b) and numbers of links (a, null, links)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        enter("jaccard blocks")
        left, right = group[group.side == 0], group[group.side == 1]
        own = group.bi.iloc[0] == group.bj.iloc[0]
        if not len(left) or not (own or len(right)):
            return pd.DataFrame({"a": [], "b": [], "links": []}).astype("int64")
        load = lambda g: [np.frombuffer(x, np.int64) for x in g.tokens]
        ra = left.rep.to_numpy()
        rb = ra if own else right.rep.to_numpy()
        pairs = adaptive_links(left.n, load(left), *(() if own else (right.n, load(right))), similarity=similarity)
        up: dict[int, int] = {}
        links: dict[int, int] = {}
        rows = []

        def top(x):
            while up.get(x, x) != x:
                up[x] = x = up.get(up[x], up[x])
            return x

        for i, j in pairs:
            a, b = int(ra[i]), int(rb[j])
            links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
            x, y = top(a), top(b)
            if x != y:
                up[max(x, y)] = min(x, y)
                rows.append((a, b, 0))
        rows += [(a, a, n) for a, n in links.items()]
        return pd.DataFrame(rows, columns=["a", "b", "links"]).astype("int64")

    return run


def jaccard_members(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, block: int = FAMILY_BLOCK) -> DataFrame:
    """(doc_id, text_id, n_shingles, component, component_id, n_links) of every document; component: a number of its own for each group, null without words.

    component_id is the smallest doc_id that links reach, n_links the number of
    *different* sets that link to the document's. Documents without words (null,
    empty or blank text) have no shingles and link with nothing; a similarity of
    just the threshold is a link. Rows that share a doc_id are documents of their
    own: equal ones count as copies, others by their own sets. Any other column is
    ignored; an empty table gives no rows.
    """
    sets = materialize(shingle_table(docs, similarity), "sets")
    some = sets.where("n > 0")
    # a class, all documents of one set, has a number of its own, since its smallest doc_id may be another class's too
    classes = some.groupBy("d0", "d1").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    # of the documents with a possible partner, the one that stands for its class
    able = some.where("tokens is not null").select("doc_id", "d0", "d1", "n", "tokens").dropDuplicates(["doc_id", "d0", "d1"])
    able = materialize(able.join(classes.select(F.col("least").alias("doc_id"), "d0", "d1", "rep"), ["doc_id", "d0", "d1"]).select("rep", "n", "tokens"), "able")
    members = _members(able, similarity, FREQUENT * block)
    # blocks of a family by a hash of the class: each class's tokens are copied once a block, so few blocks while these are small
    sized = members.groupBy("component").agg(F.count("*").alias("size"), F.sum(F.octet_length("tokens")).alias("bytes"))
    blocks = F.greatest(F.least(F.ceil(F.col("size") / F.lit(block)), F.lit(MOST_BLOCKS)), F.ceil(F.col("size") / F.lit(LARGE)), F.ceil(F.col("bytes") / F.lit(FAMILY_BYTES))).cast("int")
    sized = materialize(sized.select("component", "size", blocks.alias("blocks")).where("blocks > 1"), "sized")
    dealt = join_dealt(members, sized, ["component"], "size", "left").fillna(1, "blocks").withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("component", "rep", "n", "tokens", F.least("mine", "other").alias("bi"), F.greatest("mine", "other").alias("bj"), F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side"))
    found = materialize(met.groupBy("component", "bi", "bj").applyInPandas(_join_blocks(similarity), "a long, b long, links long"), "links")
    groups = materialize(components(found.where("a <> b"), "a", "b").withColumnRenamed("node", "rep").join(classes.select("rep", "least"), "rep"), "groups")
    first = materialize(groups.groupBy("component").agg(F.min("least").alias("first"), F.count("*").alias("size")), "first")
    groups = join_dealt(groups.drop("least"), first, ["component"], "size").select("rep", "component", "first")
    degree = found.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("n_links"))
    named = classes.join(groups, "rep", "left").join(degree, "rep", "left")
    named = named.select("d0", "d1", "copies", F.coalesce("component", "rep").alias("component"), F.coalesce("first", "least").alias("component_id"), "n_links")
    out = join_dealt(sets, materialize(named, "named"), ["d0", "d1"], "copies", "left")
    return out.select("doc_id", "text_id", F.col("n").alias("n_shingles"), "component", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def jaccard_groups(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, block: int = FAMILY_BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every document, as ``jaccard_members`` says."""
    return jaccard_members(docs, similarity, block).select("doc_id", "n_shingles", "component_id", "n_links")


def keep_first(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id (of equal ones, text_id); a row repeated stays as often as it stands.

    Rows without a doc_id or without words stay, all columns as they are.
    """
    of, of_text = f"{OWN}of", f"{OWN}of_text"
    members = materialize(jaccard_members(docs, similarity).where("component is not null").select("doc_id", "text_id", "component"), "members")
    first = materialize(members.groupBy("component").agg(F.min(F.struct("doc_id", "text_id")).alias("first"), F.count("*").alias("size")), "first")
    others = join_dealt(members, first.where("size > 1"), ["component"], "size").where(F.struct("doc_id", "text_id") != F.col("first"))
    others = others.select(F.col("doc_id").alias(of), F.col("text_id").alias(of_text)).distinct()
    return docs.join(others, (docs.doc_id == F.col(of)) & (text_id() == F.col(of_text)), "left_anti")

"""Near-duplicate detection by a chosen-path similarity join over 2-word shingles.

1. Each text becomes its set of distinct shingles (64-bit hashes), an exact digest of the
   set, and a sketch: its 64 smallest hashes. Texts with equal sets form one class at once,
   however many there are; a class goes on as one row.
2. In each of ``TREES`` independent trees a class is branched to the nodes of its ``BRANCH``
   tokens that come first in the tree's order (minwise tokens). A node of more than ``NODE``
   classes is branched again by further tokens, up to ``LEVELS`` times; what stays large then
   is split into pairs of parts. Two sets of similarity s miss each other in a level only if
   the first tokens of their union are all unshared, with a probability below
   (1 - s)**BRANCH; ``trees_for`` gives the number of trees for a target recall.
3. Small nodes are compared exhaustively on sketches; a node returns stars, not pairs. Their
   connected components are loose groups that hold every link.
4. Within loose groups all sets are compared in full, split into pairs of parts where a
   group is large. Links are confirmed there on the full sets; a pair that is already joined
   through others is not tested again. Stars again, and connected components.

Defined cases: NULL and blank texts have the empty set, are linked with nothing and kept;
with fewer words than a shingle the whole sequence is the one shingle; repeated rows, also
with equal ids, belong to one class; NULL ids take part, come first in no order, and a
component of only NULL ids has a NULL id and keeps its rows; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import BLANK, cut_lineage, read, small_batches, use_package
from quarry.llm.components import components

WORDS = 2
SIMILARITY_PCT = 80
SKETCH = 64
BRANCH = 5
DEEP_BRANCH = 3
LEVELS = 3
NODE = 3000
#: Hashes of sets that one side of a block may hold (unless a single set has more): comparing takes
#: about ten times their bytes.
PART_TOKENS = 1 << 19
TARGET_RECALL = 0.999999
#: Ids, of a few bytes each, up to which they are broadcast.
BROADCAST_IDS = 500_000
#: Share of equal sketch values below which two sets of the threshold fall once in a million.
SKETCH_SHARE = 0.56

_U = np.uint64
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))


def trees_for(recall: float, similarity: float, branch: int, levels: int) -> int:
    """Independent trees so that a pair of that similarity shares a last node in one of them."""
    miss = min(0.5, levels * (1 - similarity) ** branch)
    return max(1, math.ceil(math.log(1 - recall) / math.log(miss)))


TREES = trees_for(TARGET_RECALL, SIMILARITY_PCT / 100, BRANCH, LEVELS)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the shingles of a text, A-Z lower-cased."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace").lower(), np.uint8)
    inside = ~_GAP[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    if not len(edge):
        return np.empty(0, np.uint64)
    length = edge[1::2] - edge[::2]
    first = np.cumsum(length) - length
    at = np.arange(length.sum()) - np.repeat(first, length)
    weight = _POWERS[at & 4095] * (2 * (at >> 12) + 1).astype(np.uint64)
    word = _mix(np.add.reduceat((raw[inside].astype(np.uint64) + _U(1)) * weight, first) + length.astype(np.uint64))
    size = min(size, len(word))
    out = np.zeros(len(word) - size + 1, np.uint64)
    for k in range(size):
        out = _mix(out * _U(0xD6E8FEB86659FD93) + word[k : len(word) - size + 1 + k] + _U(size))
    return np.unique(out)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _summaries(size: int):
    @F.arrow_udf("struct<n: long, sig: binary, sketch: binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n, sig, sketch = [], [], []
            for at in range(0, len(batch), 64):
                for text in batch.slice(at, 64).to_pylist():
                    s = shingles(text, size)
                    n.append(len(s))
                    sig.append(_digest(s) if len(s) else None)
                    sketch.append((s[:SKETCH] >> _U(32)).astype("<u4").tobytes() if len(s) else None)
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(sketch, pa.binary())], names=["n", "sig", "sketch"])

    return run


def _full_sets(size: int):
    @F.arrow_udf("struct<sig: binary, tokens: binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], kind)]
            for at in range(0, len(batch), 256):
                sets = [shingles(t, size) for t in batch.slice(at, 256).to_pylist()]
                parts.append(pa.StructArray.from_arrays([pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["sig", "tokens"]))
            yield pa.concat_arrays(parts)

    kind = pa.struct([("sig", pa.binary()), ("tokens", pa.binary())])
    return run


def _children(branch: int):
    """(path, used tokens, sketch) -> the paths and used tokens of the children of a class."""

    @F.arrow_udf("array<struct<path: long, used: array<long>>>")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for path, used, sketch in batches:
            out = []
            for p, u, s in zip(path.to_pylist(), used.to_pylist(), sketch.to_pylist()):
                token = np.frombuffer(s, "<u4").astype(np.uint64)
                token = token[~np.isin(token, np.array(u or [], np.uint64))] if u else token
                salt = _mix(np.array([p], np.int64).view(np.uint64))
                chosen = token[np.argsort(_mix(token ^ salt), kind="stable")[:branch]]
                ids = _mix(_mix(chosen + _U(1)) ^ salt).view(np.int64)
                out.append([{"path": i, "used": [*(u or []), t]} for i, t in zip(ids.tolist(), chosen.tolist())])
            yield pa.array(out, kind)

    kind = pa.list_(pa.struct([("path", pa.int64()), ("used", pa.list_(pa.int64()))]))
    return run


def stars(sizes: np.ndarray, tokens: list[np.ndarray], joined: Callable[[np.ndarray, int, np.ndarray], np.ndarray]) -> np.ndarray:
    """A component number for each set of a block, where ``joined(shared, size, sizes)`` links.

    One set after the other is compared with all, but those of the largest component so far
    are left out: two of them are joined already, and every pair with another set is met
    when that one's turn comes."""
    m = len(tokens)
    owner = np.repeat(np.arange(m), [len(t) for t in tokens])
    _, place, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    order = np.argsort(place, kind="stable")
    posting, begin = owner[order], np.concatenate([[0], np.cumsum(count)])
    bound = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
    label, todo, main = np.arange(m), np.ones(m, bool), -1
    while True:
        rest = np.flatnonzero(todo & (label != main))
        if not len(rest):
            return label
        a = rest[0]
        todo[a] = False
        own = place[bound[a] : bound[a + 1]]
        own = own[count[own] > 1]
        if not len(own):
            continue
        shared = np.bincount(np.concatenate([posting[begin[t] : begin[t + 1]] for t in own]), minlength=m)
        hit = (shared > 0) & joined(shared, int(sizes[a]), sizes)
        hit[a] = True
        old = np.unique(label[hit])
        if len(old) > 1:
            label[np.isin(label, old)] = old[0]
            main = np.bincount(label).argmax()


def sketches_close(shared, n, sizes):
    """True for every pair that can reach the threshold; sizes are those of the full sets."""
    near = 100 * np.minimum(n, sizes) >= SIMILARITY_PCT * np.maximum(n, sizes)
    return near & (shared >= np.floor(SKETCH_SHARE * np.minimum(SKETCH, np.minimum(n, sizes))))


def sets_close(shared, n, sizes):
    return 100 * shared >= SIMILARITY_PCT * (n + sizes - shared)


def _block_stars(kind: str, joined):
    """Rows (block, sig, n, tokens), sorted by block -> (a, b): each class with its component's first."""

    def close(rows):
        sigs, sizes, tokens = zip(*rows)
        label = stars(np.array(sizes, np.int64), [np.frombuffer(t, kind) for t in tokens], joined)
        first: dict[int, bytes] = {}
        for k, s in zip(label.tolist(), sigs):
            first[k] = min(first.get(k, s), s)
        return [(s, first[k]) for k, s in zip(label.tolist(), sigs) if s != first[k]]

    def out(links):
        a, b = zip(*links) if links else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    def run(batches):
        block, rows, links = None, [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for b, *row in zip(*[c.to_pylist() for c in part.columns]):
                    if b != block:
                        if len(rows) > 1:
                            links += close(rows)
                        block, rows = b, []
                    rows.append(row)
                if len(links) > 10_000:
                    yield out(links)
                    links = []
        if len(rows) > 1:
            links += close(rows)
        yield out(links)

    return run


def _deal(rows: DataFrame, limit: int) -> DataFrame:
    """rows (key, size and weight of the key, sig, n, tokens) -> (block, sig, n, tokens).

    A key of more than ``limit`` classes, or whose tokens, the weight, are more than
    ``PART_TOKENS``, is dealt into parts; every pair of parts is a block."""
    parts = F.ceil(F.greatest(F.col("size") / F.lit(limit), F.col("weight") / F.lit(PART_TOKENS), F.lit(1.0))).cast("int")
    part = F.pmod(F.xxhash64("sig", F.lit(7)), parts).cast("int")
    other = F.when(parts > 1, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("__part", part).withColumn("__other", F.explode(other))
    block = F.xxhash64("key", F.least("__part", "__other"), F.greatest("__part", "__other"))
    return rows.select(block.alias("block"), "sig", "n", "tokens")


def _compare(rows: DataFrame, kind: str, joined, limit: int) -> DataFrame:
    """Rows as for ``_deal`` -> stars (a, b) of each key's classes."""
    rows = _deal(rows, limit).repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(_block_stars(kind, joined), "a binary, b binary").distinct()


def _nodes(classes: DataFrame) -> DataFrame:
    """(key, size, sig) of the last node of every path, where at least two classes meet."""
    roots = F.array(*[F.lit(t).cast("long") for t in range(TREES)])
    rows = classes.select("sig", "sketch", F.explode(roots).alias("root"))
    rows = rows.select("sig", F.explode(_children(BRANCH)(F.col("root"), F.array().cast("array<long>"), F.col("sketch"))).alias("c")).select("sig", "c.path", "c.used")
    found = []
    for level in range(LEVELS):
        size = rows.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
        rows = cut_lineage(rows.join(size, "path"))
        last = level == LEVELS - 1
        found.append(rows.filter(F.lit(last) | (F.col("size") <= NODE)).select(F.col("path").alias("key"), "size", "sig"))
        large = rows.filter(F.col("size") > NODE)
        if last or large.isEmpty():
            break
        large = large.join(classes.select("sig", "sketch"), "sig")
        rows = large.select("sig", F.explode(_children(DEEP_BRANCH)(F.col("path"), F.col("used"), F.col("sketch"))).alias("c")).select("sig", "c.path", "c.used")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def classify(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """One slim row per row of docs (doc_id, text): doc_id, n_shingles, sig, component_id, kept.

    ``sig`` identifies the set of shingles; NULL for an empty one."""
    use_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", _summaries(size)(F.col("text")).alias("s")).select("doc_id", "s.*")
    rows = cut_lineage(rows)
    classes = rows.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = cut_lineage(classes)
    nodes = _nodes(classes).join(classes.select("sig", "n", F.col("sketch").alias("tokens")), "sig")
    nodes = nodes.withColumn("weight", F.col("size") * F.lit(SKETCH))
    loose = components(_compare(nodes, "<u4", sketches_close, NODE))
    members = cut_lineage(loose.select(F.col("node").alias("sig"), F.col("label").alias("key")).join(classes.select("sig", "rep", "n"), "sig"))
    groups = members.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("weight"))
    members = members.join(groups, "key")
    text = docs.select("doc_id", "text").join(members.select(F.col("rep").alias("__rep")).distinct(), F.col("doc_id").eqNullSafe(F.col("__rep")))
    sets = text.select(_full_sets(size)(F.col("text")).alias("s")).select("s.*").dropDuplicates(["sig"])
    links = _compare(members.join(sets, "sig"), "<u8", sets_close, NODE)
    exact = components(links)
    group = classes.select("sig", "rep").join(exact.withColumnRenamed("node", "sig"), "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    first = group.groupBy("label").agg(F.min("rep").alias("component_id"))
    group = group.join(first, "label").select("sig", "component_id")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "sig").join(group, "sig", "left")
    out = out.withColumn("component_id", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "sig", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def dedup(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """docs without the rows that a smaller id of their component stands for.

    The verdict is that of the row: of texts that share an id (or have none) each goes or stays by
    its own component. Rows equal in id and set of shingles become one; rows with an empty set stay.
    Near copies that all bear the smallest id of their component stay: none has a smaller one.

    Ids that stand in one kept row need no text. Up to ``BROADCAST_IDS`` other ids and classes are
    broadcast and no text is shuffled but those of repeated ids; beyond that, all texts are
    collapsed by (id, set) and meet the kept classes in a shuffled join."""
    found = cut_lineage(classify(docs, size).groupBy("doc_id", "sig").agg(F.max("kept").alias("kept"), F.count("*").alias("k")))
    ids = found.groupBy("doc_id").agg(F.max("kept").alias("some"), F.min("kept").alias("every"), F.sum("k").alias("k"))
    odd = cut_lineage(ids.filter("NOT every OR k > 1").select(F.struct("doc_id").alias("__id"), (F.col("some") & (F.col("k") > 1)).alias("several")))
    several = odd.filter("several").select("__id")
    kept = found.filter("kept AND sig IS NOT NULL").select(F.struct("doc_id", "sig").alias("__class"))
    keyed = docs.withColumn("__id", F.struct("doc_id"))
    blank = F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(BLANK)) == ""
    sig = _summaries(size)(F.col("text"))["sig"]
    some = cut_lineage(kept.join(several, F.col("__class")["doc_id"].eqNullSafe(F.col("__id")["doc_id"]), "left_semi")) if not several.isEmpty() else kept.limit(0)
    if odd.count() + some.count() <= BROADCAST_IDS:
        single = keyed.join(F.broadcast(odd.select("__id")), "__id", "left_anti")
        repeated = keyed.join(F.broadcast(several), "__id", "left_semi")
        classed = repeated.filter(~blank).withColumn("__class", F.struct("doc_id", sig.alias("sig")))
        classed = classed.join(F.broadcast(some), "__class", "left_semi").dropDuplicates(["__class"])
        out = single.unionByName(repeated.filter(blank)).unionByName(classed.drop("__class"))
    else:
        classed = keyed.filter(~blank).withColumn("__class", F.struct("doc_id", sig.alias("sig")))
        classed = classed.dropDuplicates(["__class"]).join(kept, "__class", "left_semi")
        out = keyed.filter(blank).unionByName(classed.drop("__class"))
    return out.drop("__id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies the document with the smallest id stays.

    The shingles are op4's, so that the stage drops what op4 does not keep."""
    return dedup(docs, size=WORDS).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs).select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN w
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM w),
n AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 80 * (nx.n + ny.n - k)),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.reach),
c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept FROM n JOIN c USING (doc_id)
"""

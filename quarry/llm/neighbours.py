"""Approximate nearest neighbours by inner product with a forest of hash prefixes.

Every vector gets, per tree, a long string of signs against random planes. Inner products
become angles by one added coordinate that brings all vectors to the largest norm. The nodes
of a tree are the prefixes of its strings, of any length. For a query, all trees ascend
together from the longest prefixes until the nodes of its prefixes hold at least ``m``
candidates in sum; all candidates of these nodes are scored exactly, in double precision.

``m`` is fitted, not fixed: the true neighbours of at most ``SAMPLE`` queries are found by
brute force over all vectors, and the smallest power of two is taken whose nodes hold
``RECALL`` of them.

Equal vectors are one entry of the forest with their smallest k + 1 ids, which is all that a
list of k neighbours can use. A node or a set of queries of more than ``PART`` entries is
split into parts that meet pair by pair, so no task holds a whole hot node.

Defined cases: vectors that are NULL, empty, all zero, or hold NULL or non-finite components
take no part, nor do rows with a NULL id; vectors of each dimension are searched among
themselves; repeated rows count once; with fewer candidates than k all are returned; ties go to the smaller id; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import cut_lineage, read, use_package

TREES = 32
BITS = 32
PART = 4000
SAMPLE = 64
RECALL = 0.96
K = 20

_LONGS = pa.list_(pa.int64())


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def planes(tree: int, dimension: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, tree]).normal(size=(dimension + 1, BITS))


def strings(x: np.ndarray, last: np.ndarray, seed: int) -> np.ndarray:
    """The sign strings (one number of ``BITS`` bits per tree) of vectors with an added coordinate."""
    full = np.concatenate([x, last[:, None]], axis=1)
    weight = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    return np.stack([(full @ planes(t, x.shape[1], seed) > 0) @ weight for t in range(TREES)], axis=1)


def _codes(largest: float, seed: int, of_queries: bool):
    @F.arrow_udf("array<long>")
    def run(column: pa.Array) -> pa.Array:
        x = _matrix(column)
        if not len(x):
            return pa.array([], _LONGS)
        norm = (x * x).sum(axis=1)
        last = np.zeros(len(x)) if of_queries else np.sqrt(np.maximum(largest - norm, 0))
        return pa.array(list(strings(x, last, seed)), _LONGS)

    return run


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part, of any dimension."""
    v = F.col("embedding").cast("array<double>")
    fine = F.col("vec_id").isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return rows.filter(F.coalesce(fine, F.lit(False))).distinct()


def _best(scores: np.ndarray, low_ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, and of all that tie with the last of them by rounding."""
    if len(scores) <= k:
        return np.arange(len(scores))
    edge = np.partition(scores, len(scores) - k)[len(scores) - k]
    at = np.flatnonzero(scores >= edge - 1e-9 * (1 + abs(edge)))
    return at


def _score_blocks(k: int):
    """Rows (block, is_data, key, ids, v) sorted by block and is_data -> (key, ids, score): the
    k best entries of each block for each of its queries."""

    def close(queries, data):
        if not queries or not data:
            return
        x = np.array([d[1] for d in data])
        low = np.array([d[0][0] for d in data])
        for at in range(0, len(queries), 256):
            part = queries[at : at + 256]
            q = np.array([p[1] for p in part])
            scores = q @ x.T
            for (key, _), one, row in zip(part, q, scores):
                top = _best(row, low, k)
                exact = (x[top] * one).sum(axis=1)  # the same sum in whatever block
                order = np.lexsort((low[top], -exact))[:k]
                for j in order:
                    yield key, data[top[j]][0], float(exact[j])

    def out(rows):
        a, b, c = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, _LONGS), pa.array(c, pa.float64())], names=["key", "ids", "score"])

    def run(batches):
        block, queries, data, found = None, [], [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                vectors = _matrix(part.column(4))
                for b, is_data, key, ids, v in zip(*[c.to_pylist() for c in part.columns[:4]], vectors):
                    if b != block:
                        found += close(queries, data)
                        block, queries, data = b, [], []
                    if is_data:
                        data.append((ids, v))
                    else:
                        queries.append((key, v))
                    if len(found) > 10_000:
                        yield out(found)
                        found = []
        found += close(queries, data)
        yield out(found)

    return run


def _exploded(codes: DataFrame, levels: Column, *keep: str) -> DataFrame:
    """One row per tree and level: tree, level, prefix."""
    rows = codes.select(*keep, F.posexplode("codes").alias("tree", "code")).withColumn("level", F.explode(levels))
    return rows.withColumn("prefix", F.expr(f"shiftright(code, {BITS} - level)")).drop("code")


def _fit_m(entries: DataFrame, asked: DataFrame, sums: DataFrame, k: int) -> int:
    """The smallest power of two m whose nodes hold ``RECALL`` of the true neighbours of a sample."""
    spark = entries.sparkSession
    # at most SAMPLE rows
    sample = asked.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("key", "codes", "v").collect()
    if not sample:
        return k
    shared = spark.sparkContext.broadcast((np.array([r.key for r in sample]), np.array([r.v for r in sample]), np.array([r.codes for r in sample])))

    def nearest(batches):
        keys, q, q_codes = shared.value
        for batch in batches:
            x, codes, key = _matrix(batch.column(1)), np.array(batch.column(2).to_pylist()), batch.column(0).to_numpy()
            if not len(x):
                continue
            scores = q @ x.T
            scores[key[None, :] == keys[:, None]] = -np.inf
            rows = []
            for i in range(len(keys)):
                for j in np.argsort(-scores[i], kind="stable")[:k]:
                    differ = q_codes[i] ^ codes[j]
                    length = BITS - 1 - np.floor(np.log2(np.maximum(differ, 1))).astype(int)
                    length[differ == 0] = BITS
                    rows.append((int(keys[i]), float(scores[i, j]), int(length.max())))
            a, b, c = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.float64()), pa.array(c, pa.int32())], names=["key", "score", "shared"])

    rows = entries.select("key", "v", "codes").mapInArrow(nearest, "key long, score double, shared int")
    top = rows.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score")))).filter((F.col("r") <= k) & (F.col("score") > -float("inf")))
    deepest: dict[int, list[int]] = {}
    for key, length in top.select("key", "shared").collect():  # at most SAMPLE * k rows
        deepest.setdefault(key, []).append(length)
    held: dict[int, list[tuple[int, int]]] = {}
    for key, level, n in sums.filter(F.col("key").isin(list(deepest))).select("key", "level", "n").collect():  # at most SAMPLE * BITS rows
        held.setdefault(key, []).append((level, n))
    m = k
    while True:
        found = total = 0
        for key, lengths in deepest.items():
            stop = max([level for level, n in held[key] if n >= m], default=0)
            found += sum(x >= stop for x in lengths)
            total += len(lengths)
        if not total or found >= RECALL * total:
            return m
        m *= 2


def search(vectors: DataFrame, is_query: Column, k: int = K, seed: int = 1) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found for the rows of ``is_query``.

    Vectors of each dimension are a space of their own, searched one after the other."""
    use_package(vectors.sparkSession)
    rows = cut_lineage(_usable(vectors))
    sizes = [r[0] for r in rows.select(F.size("v")).distinct().collect()]  # the dimensions there are
    found = [_search(rows.filter(F.size("v") == d), is_query, k, seed) for d in sorted(sizes)] or [_search(rows, is_query, k, seed)]
    return functools.reduce(DataFrame.unionByName, found)


def _search(rows: DataFrame, is_query: Column, k: int, seed: int) -> DataFrame:
    """``search`` among vectors of one dimension."""
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    entries = ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("key", F.col("ids")[0])
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    found = rows.agg(F.max(norm), F.count("*")).first()
    largest, n = float(found[0] or 0.0), int(found[1])
    depth = min(BITS, max(1, n.bit_length() + 4))
    entries = cut_lineage(entries.select("key", "ids", "v", _codes(largest, seed, False)(F.col("v")).alias("codes")))
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("__v")).join(entries.select("key", "v"), F.col("v") == F.col("__v")).select("query_id", "key")
    queries = cut_lineage(queries)
    asked = entries.join(queries.select(F.col("key").alias("__k")).distinct(), F.col("key") == F.col("__k")).select("key", "v", _codes(largest, seed, True)(F.col("v")).alias("codes"))
    asked = cut_lineage(asked)

    levels = F.sequence(F.lit(0), F.lit(depth))
    nodes = cut_lineage(_exploded(entries, levels).groupBy("tree", "level", "prefix").agg(F.count("*").alias("n")))
    sums = _exploded(asked, levels, "key").join(nodes, ["tree", "level", "prefix"]).groupBy("key", "level").agg(F.sum("n").alias("n"))
    sums = cut_lineage(sums)
    m = _fit_m(entries, asked, sums, k)
    stop = sums.filter((F.col("n") >= m) | (F.col("level") == 0)).groupBy("key").agg(F.max("level").alias("level"))
    stop = cut_lineage(stop)
    used = F.array(*[F.lit(r[0]) for r in stop.select("level").distinct().orderBy("level").collect()]).cast("array<int>")  # at most BITS + 1 rows

    at = asked.join(stop.withColumnRenamed("level", "__stop"), "key")
    want = _exploded(at, F.array("__stop"), "key", "v", "__stop").drop("__stop")
    many = want.groupBy("tree", "level", "prefix").agg(F.count("*").alias("q")).join(nodes, ["tree", "level", "prefix"])
    parts = lambda c: F.ceil(F.col(c) / F.lit(PART)).cast("int")
    many = cut_lineage(many.select("tree", "level", "prefix", parts("q").alias("qp"), parts("n").alias("dp")))
    block = F.xxhash64("tree", "level", "prefix", "a", "b").alias("block")
    deal = lambda p: F.pmod(F.xxhash64("key"), F.col(p)).cast("int")
    every = lambda p: F.explode(F.sequence(F.lit(0), F.col(p) - 1))
    left = want.join(many, ["tree", "level", "prefix"]).withColumn("a", deal("qp")).withColumn("b", every("dp"))
    left = left.select(block, F.lit(False).alias("is_data"), "key", F.array().cast("array<long>").alias("ids"), "v")
    right = _exploded(entries, used, "key", "ids", "v").join(many, ["tree", "level", "prefix"]).withColumn("b", deal("dp")).withColumn("a", every("qp"))
    right = right.select(block, F.lit(True).alias("is_data"), "key", "ids", "v")
    both = left.unionByName(right).repartition("block").sortWithinPartitions("block", "is_data")
    scored = both.mapInArrow(_score_blocks(k + 1), "key long, ids array<long>, score double")
    scored = scored.dropDuplicates(["key", "ids"])
    scored = scored.withColumn("vec_id", F.explode("ids")).drop("ids")
    scored = scored.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))).filter(F.col("r") <= k + 1)
    out = queries.join(scored.drop("r"), "key").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)

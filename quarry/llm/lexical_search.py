"""Ranked lexical search with limited accumulators, term at a time, rarest term first.

1. ``build_index`` reads every document once. A task counts the terms of its documents and packs
   blocks of up to ``DOCS`` documents and ``POSTINGS`` postings: inverted lists of the terms that may
   be asked for, the documents' sizes, and the block's share of the totals. Which terms may be asked
   for is a bitmap of ``BITS`` bits over hashes of the items' terms, of one size however many items
   there are; what it lets through by chance is indexed and never asked. Blocks stay where they are
   made: no posting is shuffled.
2. Totals and document frequencies are summed over blocks and give each item's terms their weights.
3. Items, in chunks of about ``QUERY_TERMS`` terms, are answered on every block: accumulators are
   added up term by term, rarest first. Once the bounds of the terms to come cannot reach the k-th
   partial score, no document without an accumulator can be among the first k, so none is made any
   more; those there are still get their exact sums. (k-th and bounds are the block's own; a document
   that ties goes on, for the order of ids.)
4. The first k of every block are merged to the first k of each item.

All arithmetic but the weights' logarithm is on integers. Two documents of one score rank by id.

Defined cases: NULL and empty texts have no terms and are never found; an item without terms, or with
terms that no document holds, has no rows; every row of items is an item of its own, also with an id
that is NULL or repeated; rows of documents with equal ids are ranked each, NULL ids last among
ties; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from quarry.llm.common import cut_lineage, read, use_package

K = 10
BITS = 20
DOCS = 1 << 14
POSTINGS = 1 << 21
QUERY_TERMS = 100_000
#: Entries of the dictionary of words that a task has met.
WORDS = 300_000

#: Separators become blanks, A-Z become a-z; digits, letters and bytes of characters beyond ASCII stay.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_TABLE).split() if text else []


def distinct_terms(text: Column) -> Column:
    """The distinct terms of a text, as an array."""

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([sorted(t.decode() for t in set(terms(x.as_py()))) for x in batch], pa.list_(pa.string()))

    return run(text.cast("binary"))


class _Block:
    """Postings of documents that follow each other."""

    def __init__(self):
        self.ids, self.sizes, self.lists, self.postings = [], [], {}, 0

    def row(self) -> dict:
        names = sorted(self.lists)
        lists = [np.array(self.lists[t], "<u4").reshape(-1, 2) for t in names]
        flat = np.concatenate(lists) if lists else np.empty((0, 2), "<u4")
        return {"ids": self.ids, "sizes": np.array(self.sizes, "<i8").tobytes(), "terms": [t.decode() for t in names], "dfs": list(map(len, lists)),
                "doc": flat[:, 0].tobytes(), "tf": flat[:, 1].tobytes(), "docs": sum(n > 0 for n in self.sizes), "words": sum(self.sizes)}


def _blocks(asked: np.ndarray, ids: pa.DataType, limit: tuple[int, int]):
    schema = pa.schema([("ids", pa.list_(ids)), ("sizes", pa.binary()), ("terms", pa.list_(pa.string())), ("dfs", pa.list_(pa.int32())),
                        ("doc", pa.binary()), ("tf", pa.binary()), ("docs", pa.int64()), ("words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, wanted, mask = _Block(), {}, len(asked) - 1
        for batch in batches:
            for key, text in zip(batch["doc_id"], batch["text"]):
                found, at = terms(text.as_py()), len(block.ids)
                block.ids.append(key.as_py())
                block.sizes.append(len(found))
                for t, n in Counter(found).items():
                    want = wanted.get(t)
                    if want is None:
                        if len(wanted) >= WORDS:
                            wanted.clear()
                        want = wanted[t] = bool(asked[zlib.crc32(t) & mask])
                    if want:
                        block.lists.setdefault(t, []).extend((at, n))
                        block.postings += 1
                if len(block.ids) >= limit[0] or block.postings >= limit[1]:
                    yield pa.RecordBatch.from_pylist([block.row()], schema)
                    block = _Block()
        if block.ids:
            yield pa.RecordBatch.from_pylist([block.row()], schema)

    return run


def build_index(docs: DataFrame, asked: np.ndarray) -> DataFrame:
    """docs (doc_id, text) -> one row per block; ``asked`` holds a power of two of booleans, by
    crc32 of the terms that may be searched."""
    use_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(
        _blocks(asked, to_arrow_type(kind), (DOCS, POSTINGS)),
        f"ids array<{kind.simpleString()}>, sizes binary, terms array<string>, dfs array<int>, doc binary, tf binary, docs long, words long")


def asked_terms(items: DataFrame, bits: int = BITS) -> np.ndarray:
    """The bitmap of the terms of items (terms): at most 2**bits numbers come to the driver."""
    place = F.crc32(F.col("t").cast("binary")).bitwiseAND(F.lit((1 << bits) - 1))
    places = items.select(F.explode("terms").alias("t")).select(place.alias("p")).distinct()
    out = np.zeros(1 << bits, bool)
    out[[r.p for r in places.collect()]] = True
    return out


def first(item: list[tuple[str, int]], lists: dict, sizes: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block that can be among the first k of an item, and their exact scores.

    ``item``: (term, weight), rarest first; ``lists``: term -> (documents, parts of the score before
    the weight, the largest of these)."""
    held = [(w, *lists[t]) for t, w in item if t in lists]
    bound = np.cumsum([w * top for w, _, _, top in held][::-1])[::-1]  # what the terms from here on can add
    score, made = np.zeros(sizes, np.int64), np.zeros(sizes, bool)
    survivors = None
    for j, (w, docs, part, _) in enumerate(held):
        if survivors is None:
            so_far = score[made]
            if len(so_far) >= k and bound[j] < np.partition(so_far, -k)[-k]:
                survivors = np.flatnonzero(made)
        if survivors is None:
            score[docs] += w * part
            made[docs] = True
        else:
            at = np.minimum(np.searchsorted(docs, survivors), len(docs) - 1)
            hit = docs[at] == survivors
            score[survivors[hit]] += w * part[at[hit]]
    best = np.flatnonzero(made & (score > 0))
    if len(best) > k:
        best = best[score[best] >= np.partition(score[best], -k)[-k]]
    return best, score[best]


def _search(chunk, docs: int, words: int, k: int, ids: pa.DataType):
    schema = pa.schema([("uid", pa.int64()), ("at", pa.int32()), ("doc_id", ids), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = chunk.value
        wanted = {t for _, item in items for t, _ in item}
        for batch in batches:
            for block in batch.to_pylist():
                sizes = np.frombuffer(block["sizes"], "<i8")
                m = np.array([10 + 90 * n * docs // words for n in sizes.tolist()], np.int64) if words else sizes
                doc, tf = (np.frombuffer(block[c], "<u4").astype(np.int64) for c in ("doc", "tf"))
                ends, lists = np.cumsum([0, *block["dfs"]]), {}
                for t, a, b in zip(block["terms"], ends, ends[1:]):
                    if t in wanted:
                        part = 1_000_000_000 * tf[a:b] // (1000 * tf[a:b] + 8 * m[doc[a:b]])
                        lists[t] = doc[a:b], part, int(part.max())
                out = []
                for uid, item in items:
                    best, score = first(item, lists, len(sizes), k)
                    # ties with the k-th are many at most where many texts are equal
                    order = sorted(((-s, (x := block["ids"][d]) is None, 0 if x is None else x, d) for d, s in zip(best.tolist(), score.tolist())))[:k]
                    out += [{"uid": uid, "at": d, "doc_id": block["ids"][d], "score": -s} for s, _, _, d in order]
                yield pa.RecordBatch.from_pylist(out, schema)

    return run


def weighted(items: DataFrame, index: DataFrame, docs: int) -> DataFrame:
    """uid, terms: of each of items (uid, terms) the terms that documents hold, with weights, rarest first."""
    df = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.dfs").alias("df"))
    rows = items.select("uid", F.explode("terms").alias("term")).join(df, "term")
    weight = F.floor(1000 * F.log(F.lit(2.0 * docs + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    rows = rows.withColumn("weight", weight)
    return rows.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("df", "term", "weight"))).alias("terms"))


def _chunks(rows, limit: int) -> Iterator[list]:
    """(uid, [(term, weight)]) in lists of up to ``limit`` terms, one item at least."""
    chunk, size = [], 0
    for r in rows:
        if chunk and size + len(r.terms) > limit:
            yield chunk
            chunk, size = [], 0
        chunk.append((r.uid, [(t.term, t.weight) for t in r.terms]))
        size += len(r.terms)
    if chunk:
        yield chunk


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """docs (doc_id, text), items (item_id, text) -> item_id, rank, doc_id, score."""
    use_package(docs.sparkSession)
    spark = docs.sparkSession
    items = items.select("item_id", distinct_terms(F.col("text")).alias("terms"))
    items = cut_lineage(items.withColumn("uid", F.monotonically_increasing_id()))
    index = cut_lineage(build_index(docs, asked_terms(items)))
    total = index.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    kind = docs.schema["doc_id"].dataType
    order = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    found = []
    for chunk in _chunks(cut_lineage(weighted(items, index, total.docs or 0)).toLocalIterator(), QUERY_TERMS):
        sent = spark.sparkContext.broadcast(chunk)
        rows = index.mapInArrow(_search(sent, total.docs, total.words, k, to_arrow_type(kind)), f"uid long, at int, doc_id {kind.simpleString()}, score long")
        found.append(cut_lineage(rows.withColumn("rank", order).filter(F.col("rank") <= k)))
        sent.unpersist()
    if not found:
        return items.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(None).cast(kind).alias("doc_id"), F.lit(0).cast("long").alias("score"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.join(items.select("uid", "item_id"), "uid").select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(w) > 0)::BIGINT AS docs, sum(len(w))::BIGINT AS words FROM d),
b AS (SELECT DISTINCT r, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
      FROM (SELECT row_number() OVER () AS r, * FROM benchmark)),
u AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d),
p AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, t, count(*) AS tf FROM u WHERE t IN (SELECT t FROM b) GROUP BY r, t),
k AS (SELECT t, floor(1000 * ln((2 * any_value(s.docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY t),
x AS (SELECT b.r AS item, b.item_id, p.r, p.doc_id, sum(k.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * p.n * s.docs) // s.words))))::BIGINT AS score
      FROM b JOIN p USING (t) JOIN k USING (t), s GROUP BY b.r, b.item_id, p.r, p.doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 10
"""

"""How the sources of a language differ in their words: an audit of every (language, source).

Terms are maximal runs of letters A-Z (lower-cased) and of characters beyond ASCII.

1. ``partial_counts``: Arrow kernels inside ``mapInArrow`` lower, split, encode and count the
   terms of each batch, slice by slice, and merge the slices' tables by hash, so that a task sends
   one row per (language, source, term) it met and not one per word.
2. ``kept_terms``: Spark adds the partial counts up by (language, source, term), so that a common
   term of a large source is spread like any other, and then brings the sources of a term
   together: one row per term that at least ``min_docs`` documents of the language hold.
3. ``divergences``: kept terms are dealt to shards of about ``CELLS`` (term, source) cells. A shard
   is a dense matrix of counts; it gets the totals of all groups of its language, and gives partial
   sums for each pair of sources and its own best terms of each source. Spark adds up and ranks.
   Where a language has many sources, a shard is done in blocks of ``BLOCK`` sources against all.

All arithmetic is exact (64-bit integers, long division), as long as a group holds under 9e15 terms.

Defined cases: NULL text, language and source are ''; a group without terms, or a language without
kept terms, still has its pairs (with sum 0 if no term is kept) and no terms; a language with one
source has no pairs; repeated rows count each time; NULL ids do not matter, ids are not read; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import cut_lineage, read, size_of_groups, use_package

#: Fixed value: what separates terms.
GAPS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
#: Bytes of text that are split at once, and rows of counts that a task merges before it sends them.
SLICE = 16 << 20
MERGE_ROWS = 1_000_000
CELLS = 1 << 19
BLOCK = 256

KEYS = ["lang", "source", "term"]
COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``SLICE`` bytes of text, at least one row each."""
    ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        begun = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, begun + SLICE, "right")))
        yield batch.slice(at, to - at)
        at = to


def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """(text, lang, source) -> (lang, source, term, n, docs): occurrences, and documents that hold the term."""
    parts = pc.split_pattern_regex(pc.ascii_lower(batch["text"]), pattern=GAPS)
    term, doc = pc.list_flatten(parts), pc.list_parent_indices(parts)
    some = pc.greater(pc.binary_length(term), 0)
    encoded = pc.dictionary_encode(term.filter(some))
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    wide = 1 << 32  # document and term as one number
    words = pa.table({"key": pc.add(pc.multiply(doc.filter(some), wide), encoded.indices.cast("int64"))})
    in_doc = words.group_by("key", use_threads=False).aggregate([([], "count_all")])
    key = in_doc["key"].to_numpy()
    langs, sources = (pc.dictionary_encode(batch[c]) for c in ("lang", "source"))
    group = pc.add(pc.multiply(langs.indices.cast("int64"), len(sources.dictionary)), sources.indices.cast("int64"))
    pairs = group.to_numpy()[key >> 32] * wide + (key & (wide - 1))
    found = pa.table({"key": pairs, "n": in_doc["count_all"]}).group_by("key", use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    key = found["key"].to_numpy()
    place = key >> 32
    width = max(1, len(sources.dictionary))
    columns = [langs.dictionary.take(pa.array(place // width)), sources.dictionary.take(pa.array(place % width)),
               encoded.dictionary.take(pa.array(key & (wide - 1))), found["n_sum"], found["count_all"]]
    return pa.table(columns, schema=COUNTS)


def _merged(tables: list[pa.Table]) -> pa.Table:
    if len(tables) == 1:
        return tables[0]
    out = pa.concat_tables(tables).group_by(KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(COUNTS.names).cast(COUNTS)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: list[pa.Table] = []
    for batch in batches:
        for part in _slices(batch):
            kept.append(count_terms(part))
            if sum(t.num_rows for t in kept) > MERGE_ROWS:
                kept = [_merged(kept)]
                if kept[0].num_rows > MERGE_ROWS // 2:  # merging gains little here
                    yield from kept.pop().to_batches(max_chunksize=65_536)
    if kept:
        yield from _merged(kept).to_batches(max_chunksize=65_536)


def partial_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs of each task's documents; a key may come several times."""
    use_package(docs.sparkSession)
    return docs.select("text", "lang", "source").mapInArrow(_partial, "lang string, source string, term string, n long, docs long")


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, counts (an array of source and n): the terms that enough documents hold."""
    total = counts.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # a term's array has one entry per source of the language
    terms = total.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("counts"))
    return terms.filter(F.col("docs") >= min_docs).drop("docs")


def shares(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * count / total), exactly, for 0 <= count <= total < 9e15."""
    out, rest = np.divmod(count, total)
    for _ in range(3):  # SCALE is 1000 ** 3
        digits, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digits
    return out + 1


def _shard(terms: pa.Table, groups: pa.Table) -> pa.Table:
    """Partial sums of the pairs, and the best terms, of the shard's own sources."""
    source, n_terms = groups["source"].combine_chunks(), terms.num_rows
    total, kept = groups["total"].to_numpy(), int(groups["kept"][0].as_py())
    own = np.flatnonzero(groups["own"].to_numpy(zero_copy_only=False))
    count = np.zeros((n_terms, len(source)), np.int64)
    rows = {"part": [], "source": [], "item": [], "value": []}

    def add(part, s, items, values):
        for name, x in zip(rows, (["pair" if part else "term"] * len(items), [source[int(s)].as_py()] * len(items), items, values)):
            rows[name] += x

    if n_terms:
        lists = terms["counts"].combine_chunks()
        flat = lists.flatten()
        place = pc.index_in(flat.field("source"), value_set=source).to_numpy(zero_copy_only=False)
        count[pc.list_parent_indices(lists).to_numpy(), place] = flat.field("n").to_numpy()
        p = shares(count + 2, total + 2 * kept)
        q = shares(count.sum(axis=1) + 2, int(total.sum()) + 2 * kept)
        names = terms["term"].combine_chunks()
    everyone = source.to_pylist()
    for s in own.tolist():
        if n_terms:
            a = p[:, s]
            sums = ((a[:, None] - p) ** 2 // (a[:, None] + p)).sum(axis=0)
            more = np.flatnonzero((count[:, s] > 0) & (a > q))
            value = (a[more] - q[more]) ** 2 // (a[more] + q[more])
            if len(more) > TOP:  # ties with the last stay, for the order of their names
                enough = value >= np.partition(value, -TOP)[-TOP]
                more, value = more[enough], value[enough]
            best = sorted(zip((-value).tolist(), names.take(pa.array(more)).cast(pa.binary()).to_pylist()))[:TOP]
            add(False, s, [t.decode() for _, t in best], [-v for v, _ in best])
        else:
            sums = np.zeros(len(source), np.int64)
        add(True, s, everyone[:s] + everyone[s + 1 :], np.delete(sums, s).tolist())
    lang = [groups["lang"][0].as_py()] * len(rows["part"])
    return pa.table({"lang": pa.array(lang, pa.string())} | {c: pa.array(rows[c], pa.int64() if c == "value" else pa.string()) for c in rows})


def divergences(terms: DataFrame, groups: DataFrame, cells: int = CELLS) -> DataFrame:
    """terms as of ``kept_terms`` and all groups (lang, source) -> lang, source, part, item, value, rank."""
    use_package(terms.sparkSession)
    totals = terms.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("total"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("kept"))
    every = groups.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
    every = cut_lineage(every.fillna(0, ["total", "kept"]))
    # one number each: how finely terms are dealt, and sources
    size = every.groupBy("lang").agg(F.max("kept").alias("kept"), F.count("*").alias("sources"))
    most = size.agg(F.max(F.col("kept") * F.col("sources")), F.max("sources")).first()
    shards, blocks = size_of_groups(most[0] or 0, cells), size_of_groups(most[1] or 0, BLOCK)
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    dealt = terms.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards))).withColumn("block", each)
    known = every.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).withColumn("block", each)
    known = known.withColumn("own", F.pmod(F.xxhash64("source"), F.lit(blocks)) == F.col("block"))
    key = ["lang", "shard", "block"]
    found = dealt.groupBy(*key).cogroup(known.groupBy(*key)).applyInArrow(_shard, "lang string, part string, source string, item string, value long")
    found = cut_lineage(found)
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    best = found.filter("part = 'term'").withColumn("rank", rank).filter(F.col("rank") <= TOP)
    return pairs.withColumn("rank", rank).select(*columns).unionByName(best.select(*columns))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs (text, lang, source) -> lang, source, part, item, value, rank."""
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    terms = cut_lineage(kept_terms(partial_counts(docs), min_docs))
    return divergences(terms, docs.select("lang", "source"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
n AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(n.n, 0) + 2 * v.v))::BIGINT AS p
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source)
        LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT lang, term, (1 + (1000000000::HUGEINT * (sum(n) + 2)) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v.v)))::BIGINT AS q
      FROM p JOIN v USING (lang) GROUP BY lang, term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
t AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM t)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM o WHERE part = 'pair' OR rank <= 10
"""

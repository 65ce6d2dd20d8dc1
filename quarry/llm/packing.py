"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Tokens come from a public tokenizer; a document longer than a sequence is cut. Pieces are
dealt to shards of about ``SHARD`` pieces. On each shard several islands, one row each, keep
a few packings. An epoch breeds children on every island in parallel: a child takes whole
well-filled bins of one parent, loses the other parent's bins that hold the same pieces, and
best-fits the displaced pieces. Between epochs each island gets its neighbour's elite. A
shard whose elite reaches the bound ceil(tokens / length) is done. The badly filled bins of
all shards are dissolved, dealt anew and packed again in a next level, until one shard is left or a
level saves no bin.

Defined cases: NULL text is empty (one piece: the end token alone); NULL and repeated ids are
packed row by row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import random
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm import bpe
from quarry.llm.common import cut_lineage, read, size_of_groups, small_batches, use_package

LENGTH = 4096
END = 1
SHARD = 4096
ISLANDS = 3
POPULATION = 4
EPOCHS = 2
CHILDREN = 12
#: Bins filled below this share are packed again in the next level.
WELL_FILLED = 0.98


# ---------------------------------------------------------------- tokens

@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


#: Characters that the tokenizer's normalizer only lower-cases, as Python does: letters in lower and
#: upper case, and characters beyond ASCII that are neither letter, digit nor white space.
LOWER, UPPER, OTHER = "a-zß-öø-ÿа-џ", "A-ZÀ-ÖØ-ÞЀ-Я", "¡-©«¬®-±´¶-¸»¿×÷‐-‧€"
#: Fixed value: the tokenizer's own pattern, as far as it matters for these and ASCII.
PRE_TOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LOWER}]+|[0-9]|[^\\s{LOWER}0-9]+")
SIMPLE = re.compile(f"[ -~\n\t\r{LOWER}{UPPER}{OTHER}]*")
#: Python splits at these, the tokenizer does not.
SEPARATORS = re.compile("[\x1c-\x1f]")


class Encoder:
    """Ids of texts, as little-endian unsigned 32-bit numbers.

    The pre-tokens of a text, each with the blank that ``bpe.core`` has for the end of a word, are
    one string whose words the BPE takes one by one. Texts of simple characters are cut by a
    pattern; of others, each run without white space that is not simple is cut by the library
    (which joins nothing across white space). Nothing is kept from text to text."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.model = bpe.core(path, r"[^ ]+ ")
        self.byte = bpe.alphabet()

    def _by_library(self, run: str) -> list[str]:
        shown = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(run))
        return [bytes(map(self.byte.__getitem__, x)).decode() for x, _ in shown]

    def _pre_tokens(self, text: str) -> list[str]:
        if SIMPLE.fullmatch(text):
            return PRE_TOKEN.findall(text.lower())
        if SEPARATORS.search(text):
            return self._by_library(text)
        found = []
        for run in text.split():
            found += PRE_TOKEN.findall(run.lower()) if SIMPLE.fullmatch(run) else self._by_library(run)
        return found

    def encode(self, text: str | None) -> bytes:
        found = self._pre_tokens(text) if text else []
        if not found:
            return b""
        return self.model.ids[self.model.core.encode_ordinary(" ".join(found) + " ")].tobytes()


@functools.cache
def encoder(path: str) -> Encoder:
    """The worker's encoder."""
    return Encoder(path)


def _pieces(path: str, length: int, end: int, with_ids: bool):
    kind = "array<struct<piece: int, start: long, length: long, ids_crc32: long" + (", ids: array<int>" if with_ids else "") + ">>"
    tail = np.array([end], "<u4").tobytes()

    @F.arrow_udf(kind)
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for at in range(0, len(batch), 64):
                for text in batch.slice(at, 64).to_pylist():
                    ids = encoder(path).encode(text) + tail
                    row = []
                    for k, i in enumerate(range(0, len(ids), 4 * length)):
                        part = ids[i : i + 4 * length]
                        x = {"piece": k, "start": i // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                        row.append(x | {"ids": np.frombuffer(part, "<u4").astype(np.int32)} if with_ids else x)
                    rows.append(row)
            yield pa.array(rows, cut_type)

    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    cut_type = pa.list_(pa.struct(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else [])))
    return cut


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each piece of each document."""
    use_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    found = docs.select("doc_id", F.explode(_pieces(path, length, end, with_ids)(F.col("text"))).alias("p"))
    return found.select("doc_id", "p.*")


# ---------------------------------------------------------------- genetic algorithm on one shard

def best_fit(items: list[int], sizes: np.ndarray, bins: np.ndarray, room: list[int], length: int) -> None:
    """Put each item into the fullest bin with room for it, or into a new one; changes bins and room."""
    open_ = sorted((r, b) for b, r in enumerate(room) if r)
    for i in items:
        s = int(sizes[i])
        k = bisect_left(open_, (s, -1))
        if k < len(open_):
            r, b = open_.pop(k)
        else:
            r, b = length, len(room)
            room.append(length)
        bins[i] = b
        room[b] = r - s
        if r > s:
            insort(open_, (r - s, b))


def fresh(sizes: np.ndarray, length: int, order: list[int]) -> np.ndarray:
    bins = np.full(len(sizes), -1, np.int32)
    best_fit(order, sizes, bins, [], length)
    return bins


def quality(bins: np.ndarray, sizes: np.ndarray, length: int) -> tuple[int, float]:
    """Fewer bins first, then Falkenauer's mean squared fill; smaller is better."""
    fill = np.bincount(bins, sizes) / length
    return len(fill), -float((fill**2).mean())


def cross(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, length: int, rng: random.Random) -> np.ndarray:
    """A child: well-filled bins of b, bins of a without their pieces, the rest best-fitted."""
    fill = np.bincount(b, sizes)
    good = np.argsort(-fill, kind="stable")[: max(1, len(fill) // 2)]
    inject = np.zeros(len(fill), bool)
    inject[good[np.array([rng.random() < 0.3 for _ in good])]] = True
    taken = inject[b]
    broken = np.zeros(a.max() + 1, bool)
    broken[a[taken]] = True
    worst = np.bincount(a, sizes)
    broken[np.argsort(worst, kind="stable")[: 1 + len(worst) // 50]] = True  # mutation: dissolve some
    loose = broken[a] & ~taken
    child = np.where(taken, b + len(broken), a)
    child[loose] = -1
    _, child[~loose] = np.unique(child[~loose], return_inverse=True)
    room = (length - np.bincount(child[~loose], sizes[~loose])).astype(np.int64).tolist()
    items = sorted(np.flatnonzero(loose).tolist(), key=lambda i: -int(sizes[i]) * (1 + 0.1 * rng.random()))
    best_fit(items, sizes, child, room, length)
    return child.astype(np.int32)


def evolve(sizes: np.ndarray, population: list[np.ndarray], length: int, children: int, seed: int) -> list[np.ndarray]:
    """The population after some generations, best first; a new one if it is empty."""
    rng = random.Random(seed)
    bound = -(-int(sizes.sum()) // length)
    if not population:
        order = sorted(range(len(sizes)), key=lambda i: -int(sizes[i]))
        population = [fresh(sizes, length, order)]
        if quality(population[0], sizes, length)[0] > bound:
            for _ in range(POPULATION - 1):
                population.append(fresh(sizes, length, sorted(order, key=lambda i: -int(sizes[i]) * (1 + 0.2 * rng.random()))))
    ranked = sorted(((quality(p, sizes, length), k, p) for k, p in enumerate(population)), key=lambda x: x[:2])[:POPULATION]
    for k in range(children):
        if ranked[0][0][0] <= bound:
            break
        a, b = rng.sample(ranked, 2) if len(ranked) > 1 else (ranked[0], ranked[0])
        child = cross(a[2], b[2], sizes, length, rng)
        ranked = sorted([*ranked, (quality(child, sizes, length), POPULATION + k, child)], key=lambda x: x[:2])[:POPULATION]
    return [p for _, _, p in ranked]


def _epoch(length: int, children: int, seed: int):
    """A column function: (sizes, population, migrant, salt) -> (population best first, bins, fill)."""

    @F.arrow_udf("struct<population: array<binary>, bins: int, fill: double>")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for sizes, population, migrant, salt in batches:
            rows = []
            for s, p, m, k in zip(*[x.to_pylist() for x in (sizes, population, migrant, salt)]):
                s = np.array(s, np.int32)
                found = [np.frombuffer(x, np.int32) for x in [*(p or []), *([m] if m is not None else [])]]
                found = evolve(s, found, length, children, seed + k)
                bins, fill = quality(found[0], s, length)
                rows.append({"population": [x.tobytes() for x in found], "bins": bins, "fill": -fill})
            yield pa.array(rows, pa.struct([("population", pa.list_(pa.binary())), ("bins", pa.int32()), ("fill", pa.float64())]))

    return run


def _numbers(column: Column) -> Column:
    @F.arrow_udf("array<int>")
    def read_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([np.frombuffer(x, np.int32) for x in batch.to_pylist()], pa.list_(pa.int32()))

    return read_all(column)


def _pack_level(items: DataFrame, shards: int, length: int, seed: int) -> DataFrame:
    """items (uid, length) with shard, bin and the bin's fill."""
    items = items.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(shards)).alias("shard"))
    # A shard holds about SHARD pieces: uids are distinct and dealt by hash.
    state = items.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("length", "uid")), asc=False).alias("x"))
    state = state.select("shard", F.col("x.uid").alias("uids"), F.col("x.length").alias("sizes"))
    islands = state.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    islands = islands.withColumns({"population": F.lit(None).cast("array<binary>"), "migrant": F.lit(None).cast("binary")})
    islands = islands.repartition(F.col("shard"), F.col("island"))
    ring = Window.partitionBy("shard").orderBy("island")
    for epoch in range(EPOCHS):
        step = _epoch(length, CHILDREN, seed * 1000 + epoch * 100)
        islands = islands.withColumn("r", step(F.col("sizes"), F.col("population"), F.col("migrant"), F.col("island")))
        islands = islands.withColumns({"population": F.col("r.population"), "bins": F.col("r.bins"), "fill": F.col("r.fill")}).drop("r")
        if epoch + 1 < EPOCHS:
            elite = F.col("population")[0]
            last = F.last(elite).over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            islands = islands.withColumn("migrant", F.coalesce(F.lag(elite).over(ring), last))
            islands = islands.repartition(F.col("shard"), F.col("island"))
    best = islands.groupBy("shard").agg(F.min_by(F.struct("uids", "sizes", F.col("population")[0].alias("p")), F.struct("bins", -F.col("fill"), "island")).alias("b"))
    rows = best.select("shard", F.explode(F.arrays_zip(F.col("b.uids").alias("uid"), F.col("b.sizes").alias("length"), _numbers(F.col("b.p")).alias("bin"))).alias("x")).select("shard", "x.*")
    filled = Window.partitionBy("shard", "bin")
    return rows.withColumn("fill", F.sum("length").over(filled))


def pack(found: DataFrame, length: int = LENGTH, seed: int = 1) -> DataFrame:
    """found (a ``length`` per row, at most the given one) with ``sequence_id`` and ``offset``."""
    use_package(found.sparkSession)
    found = cut_lineage(found.withColumn("uid", F.monotonically_increasing_id()))
    whole = found.filter(F.col("length") == length).select("uid", "length", (-F.col("uid") - 1).alias("sequence_id"))
    rest, placed, level = found.filter(F.col("length") < length).select("uid", "length"), [whole], 0
    before = None  # bins that the pieces to be packed took in the last level
    while True:
        shards = size_of_groups(rest.count(), SHARD)
        packed = _pack_level(rest, shards, length, seed + level)
        number = F.lit(level * 2**56) + F.col("shard") * 2**13 + F.col("bin")
        packed = cut_lineage(packed.withColumn("sequence_id", number.cast("long")))
        full = F.col("fill") >= WELL_FILLED * length
        bins = packed.groupBy("sequence_id").agg(F.max("fill").alias("fill")).agg(F.count("*").alias("n"), F.count_if(~full).alias("open")).first()
        level += 1
        if shards == 1 or level > 40 or (before is not None and bins.n >= before):
            placed.append(packed.select("uid", "length", "sequence_id"))
            break
        placed.append(packed.filter(full).select("uid", "length", "sequence_id"))
        rest, before = packed.filter(~full).select("uid", "length"), bins.open
    every = functools.reduce(DataFrame.unionByName, placed)
    before = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    every = every.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("length")
    return found.join(every, "uid").drop("uid")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece of ``docs``."""
    return pack(pieces(docs, path or tokenizer_path(), length, end), length)


def sequences(docs: DataFrame, packed: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves (at most ``length`` ids each)."""
    key = ["doc_id", "piece", "ids_crc32"]
    ids = pieces(docs, path or tokenizer_path(), length, end, with_ids=True).select(*key, "ids").dropDuplicates(key)
    on = functools.reduce(Column.__and__, [packed[k].eqNullSafe(ids[k]) for k in key])
    rows = packed.join(ids, on).select("sequence_id", "offset", "ids")
    rows = rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("x"))
    return rows.select("sequence_id", F.flatten(F.col("x.ids")).alias("ids"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the pieces of the documents with their places."""
    return pack_documents(docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))

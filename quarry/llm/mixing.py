"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Within a source, documents stand in the order (size class, md5 of the id, id). Every
document of a source has the same expected number of copies, target / source size (at most
``max_repeat``), so the prefix sum of expected copies up to the i-th document is
i * target / source size. With one random offset u per source the document is emitted once
per integer in (u + before, u + through]. Size classes an eighth of a power of two wide
make the taken words follow the taken documents.

The rank i is found without a window over a whole source: rows are numbered within
(source, size class, md5 prefix), whose prefix length grows with the table so that such a
group stays small, and the group's start comes from a window over group counts.

Defined cases: NULL text has size 0 and takes nothing; a NULL source is a source of its own,
last in order; NULL and repeated ids are ranked like others (identical rows are
interchangeable); sources of size 0 have target 0; an empty table gives an empty result;
columns named as those added are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import WORD, cut_lineage, read

WEIGHTS = (3.0, 1.0, 2.0)
#: Sources up to which the table of targets, one short row each, is broadcast.
BROADCAST_SOURCES = 10_000
#: Rows that a group numbered by one task holds, about.
GROUP_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """sources (source, source_size), one row each, with ``weight`` and ``target``.

    A target is min(cap, level * weight). Sorted by cap / weight, the level is that of the
    first source that the rest of the budget, shared by weight, does not fill."""
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy(F.col("__cap") / F.col("weight"), F.col("__rank"))
    every = Window.partitionBy()
    cap, w = F.col("__cap"), F.col("weight")
    out = sources.withColumn("__rank", F.row_number().over(rank) - 1)
    out = out.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("__rank") % len(weights) + 1).cast("int")))
    out = out.withColumn("__cap", F.lit(float(max_repeat)) * F.col("source_size"))
    out = out.withColumn("__before", F.sum(cap).over(fill.rowsBetween(Window.unboundedPreceding, -1)))
    out = out.withColumn("__open", F.sum(w).over(fill.rowsBetween(0, Window.unboundedFollowing)))
    out = out.withColumn("__total", F.lit(float(share)) * F.sum("source_size").over(every))
    out = out.withColumn("__level", (F.col("__total") - F.coalesce("__before", F.lit(0.0))) / F.col("__open"))
    level = F.min(F.when(F.col("__level") * w <= cap, F.struct(cap / w, F.col("__rank"), F.col("__level").alias("level")))).over(every)["level"]
    out = out.withColumn("__level", level)
    out = out.withColumn("target", F.coalesce(F.least(cap, F.col("__level") * w), cap))
    return out.select("source", "source_size", "weight", "target")


def offset(source: Column, seed: int) -> Column:
    """Uniform in [0, 1), a function of the source and the seed."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def plan(docs: DataFrame, seed: int = 1, weights=WEIGHTS, share: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """One slim row per document: doc_id, size, text_hash, source, source_size, target, copies, taken."""
    slim = cut_lineage(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("__md5")))
    sizes = cut_lineage(slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__n")))
    found = sizes.agg(F.coalesce(F.sum("__n"), F.lit(0)), F.count("*")).first()
    digits = 0
    while found[0] > GROUP_ROWS * 16**digits:
        digits += 1
    goals = targets(sizes.select("source", "source_size"), weights, share, max_repeat)
    if found[1] <= BROADCAST_SOURCES:
        goals = F.broadcast(goals)
    bits = F.bin("size")
    slim = slim.withColumn("__class", F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 1, 4)))
    slim = slim.withColumn("__part", F.substring("__md5", 1, digits))
    group = ["source", "__class", "__part"]
    counts = slim.groupBy(*group).agg(F.count("*").alias("__rows"))
    before = Window.partitionBy("source").orderBy("__class", "__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__start", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows")
    counts = counts.select(F.col("source").alias("__s"), F.col("__class").alias("__c"), F.col("__part").alias("__p"), "__start")
    numbered = slim.withColumn("__row", F.row_number().over(Window.partitionBy(*group).orderBy("__md5", "doc_id", "size", "text_hash")))
    ranked = numbered.join(counts, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__class") == F.col("__c")) & (F.col("__part") == F.col("__p")))
    goals = goals.withColumnRenamed("source", "__s2")
    out = ranked.join(goals, F.col("source").eqNullSafe(F.col("__s2")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    i, u = F.col("__start") + F.col("__row"), offset(F.col("source"), seed)
    copies = (F.floor(u + rate * i) - F.floor(u + rate * (i - 1))).cast("long")
    return out.select("doc_id", "size", "text_hash", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of docs as many times as the plan takes it, columns of docs.

    Rows that agree in id, source and text are one entry of the plan with their copies added."""
    key = F.struct("doc_id", "source", F.col("text_hash").alias("hash"))
    chosen = plan(docs, **options).filter("copies > 0").groupBy(key.alias("__k")).agg(F.sum("copies").alias("__copies"))
    # Rows that agree in the key share its copies: the first (copies mod rows) of them take one more.
    left = docs.withColumn("__key", F.struct("doc_id", "source", F.xxhash64("text").alias("hash")))
    joined = left.join(chosen, F.col("__key") == F.col("__k"))
    same = Window.partitionBy("__key")
    joined = joined.withColumn("__same", F.count("*").over(same)).withColumn("__nth", F.row_number().over(same.orderBy(F.lit(0))))
    each = F.floor(F.col("__copies") / F.col("__same")) + (F.col("__nth") <= F.col("__copies") % F.col("__same")).cast("long")
    return joined.withColumn("__each", F.explode(F.array_repeat(F.lit(1), each.cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents, repeated or left out as the mix says."""
    return mix(docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST)) - 1 AS rk FROM s),
c AS (SELECT *, ([3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE])[(rk % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS cap FROM r),
f AS (SELECT *, sum(cap) OVER (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
             sum(weight) OVER (ORDER BY cap / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
             1.5::DOUBLE * sum(source_size) OVER () AS total FROM c),
l AS (SELECT *, (total - coalesce(before, 0)) / open_weight AS level FROM f),
g AS (SELECT source, source_size, coalesce(least(cap, weight * (SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, rk LIMIT 1)), cap) AS target FROM l),
n AS (SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY lpad(length(bin(size))::VARCHAR, 2, '0') || substr(bin(size), 1, 4),
             md5(coalesce(doc_id::VARCHAR, '')), doc_id, size) AS i FROM d),
x AS (SELECT n.doc_id, n.size, g.source_size, g.target, n.i,
             CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
             ('0x' || substr(md5('1:' || coalesce('=' || n.source, '')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS u
      FROM n JOIN g ON n.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, ((floor(u + rate * i) - floor(u + rate * (i - 1))) * size)::BIGINT AS taken FROM x
"""

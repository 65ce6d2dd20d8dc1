"""Exact TF-IDF name similarity (J7), two-stage sparse shortlist + dense rerank
(J8), top-k neighbours (L4), cosine (F30).

Model (character n-gram TF-IDF as commonly configured for names): word-bounded
3-4-grams, raw term counts, smoothed idf = ln((1 + n) / (1 + df)) + 1 over the
union of both sides (every input row is a document, duplicates included), rows
L2-normalised, score = dot product.

Plan shape — no all-pairs product, and no pair is shuffled before its score is known:
  * work on distinct texts, carrying each text's row multiplicity for the idf;
  * the dictionary of grams (df, idf, an id) is a hash aggregate, checkpointed; the vectors of the texts
    are made from it whenever they are read. A small dictionary goes to every task, which makes vectors
    of the grams of a text without a row for each; a large one is joined by a shuffle;
  * the texts of both sides, a row with its vector each, are dealt to a grid: a cell has at most some
    ``LEFT_POSTINGS`` and ``RIGHT_POSTINGS`` and meets as one cogroup. What is shuffled are vectors,
    each as often as there are parts of the other side;
  * within a cell (``gram_search``) numpy adds up partial products along the postings of the right side,
    many left texts at a time, grams of few texts first, until no text that was not met can reach what
    is asked for; texts that what follows could still take there get their exact product;
  * where only the first k are asked for (J7: 1), the exact products of the best partial ones give a
    left text a threshold of its own, before the postings of common grams are read;
  * the rerank deals the dense vectors of both sides to a grid of their own, and to its cells the ids of
    the pairs: a vector is not sent once for each pair that it is in.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions.text import char_wb_ngrams
from quarry.operators.gram_search import EPS, cell_search
from quarry.session import cut_lineage


def dense_cosine(a, b) -> Column:
    """F30 (dense): cosine of two equal-length numeric arrays, in double precision,
    summed left to right; NULL when either norm is 0."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")),
                           F.lit(0.0), lambda acc, v: acc + v)

    na, nb = F.sqrt(dot(a, a)), F.sqrt(dot(b, b))
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb))


def _distinct_texts(df: DataFrame, text_col: str) -> DataFrame:
    return df.groupBy(F.col(text_col).alias("text")).agg(F.count(F.lit(1)).alias("mult"))


def tfidf_docs(left: DataFrame, right: DataFrame, left_text: str, right_text: str) -> DataFrame:
    """Distinct texts per side with row multiplicity and a compact numeric id
    (side, text, mult, tid). Checkpointed so the ids are fixed: every later join
    and shuffle moves 8-byte ids instead of the texts."""
    docs = (_distinct_texts(left, left_text).withColumn("side", F.lit("L"))
            .unionByName(_distinct_texts(right, right_text).withColumn("side", F.lit("R"))))
    return cut_lineage(docs.withColumn("tid", F.monotonically_increasing_id()))


#: Grams up to which the dictionary goes to every executor; a larger one is joined by a shuffle.
SMALL_DICTIONARY = 100_000
#: Characters of texts that one task cuts into grams.
TASK_CHARS = 1_000_000


def _text_parts(docs: DataFrame) -> int:
    return max(8, math.ceil((docs.agg(F.sum(F.length("text"))).first()[0] or 0) / TASK_CHARS))


def gram_dictionary(docs: DataFrame, n_min: int = 3, n_max: int = 4) -> DataFrame:
    """gram, gid, df, idf, nl, nr: rows of both sides with the gram, and distinct texts of each side.
    Checkpointed, so the ids are fixed."""
    n = docs.agg(F.sum("mult")).scalar()  # one value: a scalar subquery, not a join
    grams = docs.repartition(_text_parts(docs)).select("side", "mult", F.explode(F.array_distinct(char_wb_ngrams(F.col("text"), n_min, n_max))).alias("gram"))
    dfreq = grams.groupBy("gram").agg(F.sum("mult").alias("df"), F.count_if(F.col("side") == "L").alias("nl"), F.count_if(F.col("side") == "R").alias("nr"))
    return cut_lineage(dfreq.select("gram", F.monotonically_increasing_id().alias("gid"), "df", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"), "nl", "nr"))


def posting_counts(dictionary: DataFrame) -> tuple[int, int]:
    """Postings of either side, as ``tfidf_postings`` has them."""
    row = dictionary.where("nl > 0 and nr > 0").agg(F.sum("nl"), F.sum("nr")).first()
    return row[0] or 0, row[1] or 0


def _vectors(dictionary: pa.Table):
    """For ``mapInArrow``: text and its grams to the row of ``tfidf_postings``. Grams come by their place in the
    dictionary."""
    gid, idf, shared = (dictionary.column(c).to_numpy() for c in ("gid", "idf", "shared"))

    def vectors(batches):
        grams = dictionary.column("gram").combine_chunks()
        for batch in batches:
            sizes = batch.column("grams").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            place = pc.index_in(batch.column("grams").flatten(), value_set=grams).to_numpy()
            key = np.sort(np.repeat(np.arange(batch.num_rows) * len(grams), sizes) + place)
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
            row, place = np.divmod(key[first], len(grams))
            raw = np.diff(np.append(first, len(key))) * idf[place]
            norm = np.sqrt(np.bincount(row, raw * raw, batch.num_rows))
            row, place, raw = (x[shared[place]] for x in (row, place, raw))
            n = np.bincount(row, minlength=batch.num_rows)
            lists = lambda x: pa.ListArray.from_arrays(np.append(0, np.cumsum(n)).astype(np.int32), x)
            out = pa.RecordBatch.from_arrays([batch.column("text"), pa.array(norm), lists(gid[place]), lists(raw)], ["text", "norm", "ids", "ws"])
            yield out.filter(pa.array(n > 0))

    return vectors


def tfidf_postings(docs: DataFrame, n_min: int = 3, n_max: int = 4, dictionary: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Vectors of both sides: (text, norm, ids, ws) where ``text`` is the text id from ``tfidf_docs``,
    ``ids`` its grams and ``ws`` their weights before the division by ``norm``. The idf counts every input
    row of both sides, and the norm every gram of a text; but only grams that both sides have are in
    the vectors: no other is ever multiplied. Common grams come first, with weights that all texts share, so that
    most of a row is compressed away. Lazy, as they are much larger than texts and dictionary."""
    if dictionary is None:
        dictionary = gram_dictionary(docs, n_min, n_max)
    known = dictionary.select("gram", "gid", "df", "idf", ((F.col("nl") > 0) & (F.col("nr") > 0)).alias("shared"))
    small = known.limit(SMALL_DICTIONARY + 1).toArrow()
    parts = _text_parts(docs)
    kind = "text long, norm double, ids array<long>, ws array<double>"

    def side(name):
        texts = docs.where((F.col("side") == name) & F.col("text").isNotNull()).repartition(parts, "tid").select(F.col("tid").alias("text"), char_wb_ngrams(F.col("text"), n_min, n_max).alias("grams"))
        if small.num_rows <= SMALL_DICTIONARY:
            return texts.mapInArrow(_vectors(small.sort_by([("df", "descending"), ("gid", "ascending")])), kind)
        grams = texts.select("text", F.explode("grams").alias("gram")).groupBy("text", "gram").agg(F.count(F.lit(1)).alias("tf"))
        post = grams.join(known, "gram").withColumn("raw", F.col("tf") * F.col("idf"))
        kept = F.filter(F.sort_array(F.collect_list(F.struct((-F.col("df")).alias("f"), "gid", "raw", "shared"))), lambda x: x["shared"])
        rows = post.groupBy("text").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"), kept.alias("_v"))
        return rows.where(F.size("_v") > 0).select("text", "norm", F.col("_v.gid").alias("ids"), F.col("_v.raw").alias("ws"))

    return side("L"), side("R")


#: Postings of either side that a cell of the grid has, on average; a left part has fewer while the tasks are few.
LEFT_POSTINGS, RIGHT_POSTINGS = 3_000_000, 3_000_000
#: Postings that a left text reads before it finds its own threshold, and texts with the best partial
#: products, for each of the k, whose exact products give it.
HOT_GRAM = 512
SEEDS = 2


#: Steps of norms, for each factor of e; texts in a step are told apart by a hash.
NORM_STEPS = 100


def _part_by_norm(post: DataFrame, parts: int) -> Column:
    """The part of a text, of so many with as many postings each. Texts of about the same norm come together: the bounds
    of a cell are then close to what its texts can have, and cells of large norms are soon done."""
    step = F.floor(F.log("norm") * NORM_STEPS)
    cuts = []
    if parts > 1:
        sizes = sorted(tuple(row) for row in post.groupBy(step.alias("step")).agg(F.sum(F.size("ids"))).collect())
        total, before = sum(n for _, n in sizes), 0
        for at, n in sizes:
            while len(cuts) < parts - 1 and (want := total * (len(cuts) + 1) / parts) <= before + n:
                cuts.append(float(at + (want - before) / n))
            before += n
    place = step + F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / (1 << 20)
    return F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda cut: cut <= place))


def _search(lpost: DataFrame, rpost: DataFrame, least: float, k: int | None, counts: tuple[int, int] | None) -> DataFrame:
    """(ltext, rtext, score) of the grid's cells. ``counts``: postings of either side, if known."""
    nl, nr = counts or (p.agg(F.sum(F.size("ids"))).first()[0] or 0 for p in (lpost, rpost))
    tasks = 2 * lpost.sparkSession.sparkContext.defaultParallelism
    lparts = max(1, math.ceil(nl / LEFT_POSTINGS), min(tasks, nl * 16 // LEFT_POSTINGS))
    rparts = max(1, math.ceil(nr / RIGHT_POSTINGS))

    def side(post, mine, part, theirs, others):
        return post.select("*", part.cast("int").alias(mine), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(theirs))

    l = side(lpost, "_a", F.pmod(F.xxhash64("text"), F.lit(lparts)), "_b", rparts)
    r = side(rpost, "_b", _part_by_norm(rpost, rparts), "_a", lparts)
    return l.groupBy("_a", "_b").cogroup(r.groupBy("_a", "_b")).applyInArrow(cell_search(least, k, HOT_GRAM, SEEDS), "ltext long, rtext long, score double")


def threshold_pairs(lpost: DataFrame, rpost: DataFrame, t: float, tolerance: float = EPS, best_only: bool = False,
                    counts: tuple[int, int] | None = None) -> DataFrame:
    """All (ltext, rtext, score) with cosine >= t; of each left text at least its best ones if
    ``best_only``. Sums of squares are rounded, and by the order of summation: ``tolerance``
    below t still counts as reaching it."""
    return _search(lpost, rpost, t - tolerance, 1 if best_only else None, counts)


def tfidf_match(left: DataFrame, right: DataFrame, left_text: str, right_text: str,
                threshold: float = 0.40, score_col: str = "match_score",
                flag_col: str = "match_flag", tolerance: float = EPS) -> DataFrame:
    """For every left row, the best cosine against all right rows if it reaches
    ``threshold`` (else NULL) and a 0/1 flag (score >= threshold, inclusive; a score within
    ``tolerance`` of it, as rounding may leave an exact tie, reaches it)."""
    docs = tfidf_docs(left, right, left_text, right_text)
    dictionary = gram_dictionary(docs)
    lpost, rpost = tfidf_postings(docs, dictionary=dictionary)
    pairs = threshold_pairs(lpost, rpost, threshold, tolerance, best_only=True, counts=posting_counts(dictionary))
    best = pairs.groupBy("ltext").agg(F.max("score").alias(score_col))
    ldocs = docs.where(F.col("side") == "L").select(F.col("text").alias("_t"), F.col("tid").alias("ltext"))
    best = best.join(ldocs, "ltext").drop("ltext")
    out = left.join(best, left[left_text].eqNullSafe(best["_t"]), "left").drop("_t")
    return out.withColumn(flag_col, F.when(F.col(score_col) >= F.lit(threshold - tolerance), 1).otherwise(0))


def _least_scores(lpost: DataFrame, rpost: DataFrame, k: int, rmult: DataFrame) -> DataFrame:
    """text, least: the score that k right rows reach for each left text; no row for a left text that
    shares grams with fewer than k."""
    scored = top_k_texts(lpost, rpost, k).join(rmult.select(F.col("text").alias("rtext"), "mult"), "rtext")
    best = Window.partitionBy("ltext").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = scored.withColumn("_rows", F.sum(F.least(F.col("mult"), F.lit(k))).over(best))
    return rows.where(F.col("_rows") >= k).groupBy(F.col("ltext").alias("text")).agg(F.max("score").alias("least"))


def top_k_texts(lpost: DataFrame, rpost: DataFrame, k: int, counts: tuple[int, int] | None = None) -> DataFrame:
    """(ltext, rtext, score) of every left text: at least all right texts among its first ``k``, so all
    that its first k right rows have. A left text that shares grams with fewer than k has all of these."""
    return _search(lpost, rpost, 0.0, k, counts)


#: Numbers in the vectors of either side that a cell of the grid has, on average (a pair counts as
#: some), and pairs that are multiplied at once.
CELL_NUMBERS = 12_000_000
PAIR_NUMBERS = 6
PAIR_BLOCK = 8_192
#: Right rows up to which the ids of the rerank go to every executor; more are joined by a shuffle.
SMALL_SIDE = 100_000


def _cell_cosines(left: pa.Table, right: pa.Table) -> pa.Table:
    """(_lid, _d): F30 of the pairs that the rows with _rids name, where it is not NULL; the other left rows
    have the vectors. In double precision and summed left to right, as ``dense_cosine`` does."""

    def vectors(table):
        v = table.column("_v").combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = v.flatten()
        ends = np.cumsum(sizes)
        if flat.null_count:  # a missing number makes the cosine NULL
            gone = np.flatnonzero(pc.is_null(flat).to_numpy(zero_copy_only=False))
            sizes[np.searchsorted(ends, gone, side="right")] = 0
        if not pa.types.is_floating(flat.type):
            flat = flat.cast(pa.float64(), safe=False)
        return flat.to_numpy(zero_copy_only=False), np.concatenate(([0], ends))[:-1], sizes

    lids, scores = [], []
    if left.num_rows and right.num_rows:
        named = left.filter(pc.is_valid(left.column("_rids")))
        left = left.filter(pc.is_null(left.column("_rids")))
        ids = named.column("_rids").combine_chunks()
        asked = pa.table({"_rid": ids.flatten(), "n": np.repeat(np.arange(named.num_rows), ids.value_lengths().to_numpy(zero_copy_only=False))})
        number = lambda t, c, n: pa.table({c: t.column(c).combine_chunks(), n: np.arange(t.num_rows)})
        pairs = asked.join(number(right, "_rid", "j"), "_rid", join_type="inner", use_threads=False)
        owners = number(named, "_lid", "n").join(number(left, "_lid", "i"), "_lid", join_type="inner", use_threads=False)
        pairs = pairs.select(["n", "j"]).join(owners.select(["n", "i"]), "n", join_type="inner", use_threads=False)
        i, j = pairs.column("i").to_numpy(), pairs.column("j").to_numpy()
        (lflat, lat, lsize), (rflat, rat, rsize) = vectors(left), vectors(right)
        same = (lsize[i] == rsize[j]) & (lsize[i] > 0)
        i, j = i[same], j[same]

        def dot(a, b):  # cumsum adds one after the other, sum does not
            return np.cumsum(a * b, axis=1)[:, -1] + 0.0

        with np.errstate(all="ignore"):
            for n in np.unique(lsize[i]):
                of_n = np.flatnonzero(lsize[i] == n)
                block = max(1, PAIR_BLOCK * 64 // n)
                for at in range(0, len(of_n), block):
                    p, q = (x[of_n[at:at + block]] for x in (i, j))
                    a, b = (flat[start[x][:, None] + np.arange(n)].astype(np.float64) for flat, start, x in ((lflat, lat, p), (rflat, rat, q)))
                    na, nb = np.sqrt(dot(a, a)), np.sqrt(dot(b, b))
                    some = (na != 0) & (nb != 0)  # NaN is more than 0 to Spark
                    lids.append(p[some])
                    scores.append((dot(a, b) / (na * nb))[some])
    at = np.concatenate(lids) if lids else np.empty(0, np.int64)
    return pa.table({"_lid": left.column("_lid").take(pa.array(at)), "_d": pa.array(np.concatenate(scores) if scores else np.empty(0), pa.float64())})


def _dense_pairs(top: DataFrame, lv: DataFrame, rv: DataFrame, lrows: int, rrows: int, k: int) -> DataFrame:
    """(_lid, _d) of the pairs of ``top`` (_lid, at most k _rids). Vectors (_lid or _rid, _v) of both sides are dealt to
    a grid, each once for every part of the other side, and the pairs to the cells that have theirs."""
    length = (lv.agg(F.sum(F.greatest(F.size("_v"), F.lit(0)))).first()[0] or 0) / max(1, lrows)
    lparts, rparts = (max(1, math.ceil(n * max(length, PAIR_NUMBERS * ids) / CELL_NUMBERS)) for n, ids in ((lrows, k), (rrows, 1)))
    part = lambda x, parts: F.pmod(F.xxhash64(x), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    pairs = (top.withColumn("_b", F.explode(F.array_distinct(F.transform("_rids", lambda x: part(x, rparts)))))
             .select("_lid", "_b", F.filter("_rids", lambda x: part(x, rparts) == F.col("_b")).alias("_rids")))
    l = (lv.select("_lid", every(rparts).alias("_b"), F.lit(None).cast(pairs.schema["_rids"].dataType).alias("_rids"), "_v")
         .unionByName(pairs.withColumn("_v", F.lit(None).cast(lv.schema["_v"].dataType)))
         .where(F.col("_lid").isNotNull()).withColumn("_a", part(F.col("_lid"), lparts)))
    r = rv.where(F.col("_rid").isNotNull()).select("_rid", "_v", part(F.col("_rid"), rparts).alias("_b"), every(lparts).alias("_a"))
    kind = lv.schema["_lid"].dataType.simpleString()
    return l.groupBy("_a", "_b").cogroup(r.groupBy("_a", "_b")).applyInArrow(_cell_cosines, f"_lid {kind}, _d double")


def shortlist_rerank(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                     left_text: str, right_text: str, left_vec: str, right_vec: str,
                     k: int = 10, threshold: float = 0.82, score_digits: int = 9,
                     flag_col: str = "rerank_flag", score_col: str = "rerank_score") -> DataFrame:
    """Per left row, the k right rows with the highest sparse cosine (ties:
    smaller right id; right rows without any shared gram rank after all others,
    score 0), then the best dense cosine among them; flag = best >= threshold. Scores are
    ranked after rounding to ``score_digits`` digits, so that equal ones tie however summed.
    Output: left_id, rerank_score (best dense cosine), rerank_flag."""
    docs = tfidf_docs(left, right, left_text, right_text)
    dictionary = gram_dictionary(docs)
    lpost, rpost = tfidf_postings(docs, dictionary=dictionary)
    rdocs = docs.where(F.col("side") == "R")
    lrows, rrows = (docs.where(F.col("side") == s).agg(F.sum("mult")).first()[0] or 0 for s in ("L", "R"))
    text_pairs = top_k_texts(lpost, rpost, k, posting_counts(dictionary))
    # a right text can stand for many rows, of which only its k smallest ids can enter a top-k
    rk = (right.select(F.col(right_text).alias("_t"), F.col(right_id).alias("_rid"))
          .join(rdocs.select(F.col("text").alias("_t"), F.col("tid").alias("rtext")), "_t").drop("_t")
          .withColumn("_r", F.row_number().over(Window.partitionBy("rtext").orderBy("_rid")))
          .where(F.col("_r") <= k).groupBy("rtext").agg(F.collect_list(F.struct("_rid")).alias("_rows")))
    # texts that rows of strictly better texts leave room for, then the first k of their rows; from the
    # window on all is by ltext, so pairs are shuffled once for their rows and once for their order
    scored = (text_pairs.select("ltext", "rtext", F.round("score", score_digits).alias("_s"))
              .join(F.broadcast(rk) if rrows <= SMALL_SIDE else rk, "rtext").select("ltext", "_s", "_rows").withColumn("_m", F.size("_rows")))
    up_to = F.sum("_m").over(Window.partitionBy("ltext").orderBy(F.desc("_s")).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    equal = F.sum("_m").over(Window.partitionBy("ltext", "_s"))
    scored = scored.withColumn("_better", up_to - equal).where(F.col("_better") < k)
    found = (scored.select("ltext", "_s", F.explode("_rows").alias("_x")).select("ltext", F.col("_x._rid").alias("_rid"), "_s")
             .groupBy("ltext", "_rid").agg(F.max("_s").alias("_s")))
    top = (found.withColumn("_rn", F.row_number().over(Window.partitionBy("ltext").orderBy(F.desc("_s"), F.asc("_rid"))))
           .where(F.col("_rn") <= k)
           .groupBy("ltext").agg(F.collect_list(F.struct((F.lit(0.0) - F.col("_s")).alias("_b"), "_rid")).alias("_top")))
    # rows with no shared gram: the k smallest right ids overall (bounded, 2k rows)
    zero_ids = (right.select(F.col(right_id).alias("_rid")).orderBy("_rid").limit(2 * k)
                .agg(F.collect_list("_rid")).scalar())
    # all left rows of a text have its first k
    ldocs = docs.where(F.col("side") == "L").select(F.col("text").alias("_t"), F.col("tid").alias("ltext"))
    asked = (left.select(F.col(left_id).alias("_lid"), F.col(left_text).alias("_t"))
             .join(ldocs, "_t").drop("_t"))
    others = F.filter("_zero", lambda z: ~F.coalesce(F.array_contains("_top._rid", z), F.lit(False)))
    others = F.transform(others, lambda z: F.struct(F.lit(0.0).alias("_b"), z.alias("_rid")))
    top = (asked.join(top, "ltext", "left").withColumn("_zero", F.array_distinct(zero_ids))
           .withColumn("_all", F.when(F.col("_top").isNull(), F.transform("_zero", lambda z: F.struct(F.lit(0.0).alias("_b"), z.alias("_rid"))))
                       .otherwise(F.concat("_top", others)))
           .select("_lid", F.slice(F.sort_array("_all"), 1, k)["_rid"].alias("_rids")))
    lv = left.select(F.col(left_id).alias("_lid"), F.col(left_vec).alias("_v"))
    rv = right.select(F.col(right_id).alias("_rid"), F.col(right_vec).alias("_v"))
    best = _dense_pairs(top, lv, rv, lrows, rrows, k).groupBy("_lid").agg(F.max("_d").alias(score_col))
    out = left.select(F.col(left_id)).join(best, F.col(left_id) == F.col("_lid"), "left").drop("_lid")
    return out.withColumn(flag_col, F.when(F.col(score_col) >= F.lit(threshold), 1).otherwise(0))

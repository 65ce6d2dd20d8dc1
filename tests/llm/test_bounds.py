"""Samples that never become empty, and work that does not end early."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import language_id as L
from quarry.llm import neighbours as NB
from quarry.llm import packing as P
from quarry.llm.common import sampled


def test_sampled_shares(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), F.col("id").cast("string").alias("text"))
    n = lambda share: df.filter(sampled(share, "doc_id", "text")).count()
    assert n(1.0) == n(7.5) == 100_000
    assert abs(n(0.1) - 10_000) < 500 and abs(n(F.when(F.col("doc_id").isNull(), 0.3).otherwise(0.0)) - 10_000) < 500
    # a share of one in ten billion is a share, not none: of 10**15 hashes it keeps about 10**5
    assert (1 << 62) * 2000 / 4e10 > 2e11 and n(1e-12) <= 1


def test_rare_languages_are_learned(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(900)] + [(None, "x", "en"), (5000, "zzz qqq vvv", "xx"), (5001, "zzq qqv", "xx"), (1, None, "yy")]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_rows=20)
    assert model.languages == ["en", "xx"]
    assert model.log_prior.tolist() == [math.log(900 / 902), math.log(2 / 902)]
    assert L._score(model, ["zz qq", "dog cat"])[0] == ["xx", "en"]


def test_scores_are_those_of_plain_counts(spark):
    rows = [(i, t, x) for i, (t, x) in enumerate([("Ab cd", "a"), ("éa ab!", "a"), ("xyz xy", "b"), ("", "b"), ("b c 1 d", "c")])]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), bits=8, alpha=0.5)

    def grams(text):
        letters = "".join(c.lower() if c.isalpha() else " " for c in text)
        if not letters.strip():
            return []
        x = [ord(c) for c in " " + " ".join(letters.split()) + " "]
        m = 0xFFFFFFFF
        one = [c * 0x9E3779B1 & m for c in x]
        two = [((one[i] ^ (x[i + 1] + 0x7F4A7C15 & m)) * 0x85EBCA6B) & m for i in range(len(x) - 1)]
        three = [((two[i] ^ (x[i + 2] + 0x165667B1 & m)) * 0xC2B2AE35) & m for i in range(len(x) - 2)]
        return [v >> 24 for v in one[1:] + two + three]

    counts = {x: Counter() for x in "abc"}
    for _, text, lang in rows:
        counts[lang].update(grams(text))
    prior = {"a": 2 / 5, "b": 2 / 5, "c": 1 / 5}
    tried = ["ab", "xyz éa", "c d b", "1 2", ""]
    langs, scores = L._score(model, tried)
    for text, lang, score in zip(tried, langs, scores):
        g = grams(text)
        if not g:
            assert (lang, score) == (L.UNKNOWN, 0.0)
            continue
        sums = {x: math.log(prior[x]) + sum(math.log((c[v] + 0.5) / (sum(c.values()) + 128)) for v in g) for x, c in counts.items()}
        best = max(sums, key=sums.get)
        assert lang == best and math.isclose(score, 1 / sum(math.exp(s - sums[best]) for s in sums.values()), rel_tol=1e-9)


def test_each_dimension_is_searched(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3 if i >= 100 else 2).tolist()) for i in range(160)] + [(200, [1.0]), (201, [2.0])]
    found = NB.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=4).collect()
    assert {r.query_id for r in found} == {i for i, _ in rows if i % 20 == 0}
    size = {i: len(v) for i, v in rows}
    assert all(size[r.query_id] == size[r.vec_id] for r in found)
    assert [(r.vec_id, r.score) for r in found if r.query_id == 200] == [(201, 2.0)]


def test_repacking_goes_on_while_it_saves(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD", 20)
    # pieces a little over half a sequence fill no bin alone; what fills it lies in other shards
    lengths = [33] * 120 + [31] * 15 + [20] * 30
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    packed = P.pack(df, 64).collect()
    bins = Counter()
    for r in packed:
        bins[r.sequence_id] += r.length
    assert max(bins.values()) <= 64 and sum(bins.values()) == sum(lengths)
    assert len(bins) == 120


def test_batches_are_bounded_by_bytes(spark):
    import pyarrow as pa

    from quarry.llm.common import _BATCH_SETTING, small_batches

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    try:
        spark.conf.unset(_BATCH_SETTING)
        small_batches(spark)
        df = spark.range(6000).repartition(2).select(F.repeat(F.lit("x"), 10_000).alias("t"))
        assert 1 << 20 < df.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] < 9 << 20
        spark.conf.set(_BATCH_SETTING, "3m")  # what the session says stays
        small_batches(spark)
        assert spark.conf.get(_BATCH_SETTING) == "3m"
    finally:
        spark.conf.unset(_BATCH_SETTING)

"""Similarity joins where grams are hot, texts repeat and texts share common grams only."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import similarity as S


def _grams(t):
    out = []
    for word in t.split():
        w = f" {word} "
        for n in (3, 4):
            if len(w) <= n:
                out.append(w)
                break
            out += [w[i:i + n] for i in range(len(w) - n + 1)]
    return out


def _scores(left, right):
    docs = left + right
    df = Counter(g for d in docs for g in set(_grams(d)))

    def vector(t):
        w = {g: tf * (math.log((1 + len(docs)) / (1 + df[g])) + 1) for g, tf in Counter(_grams(t)).items()}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        return {g: x / norm for g, x in w.items()}

    rv = [vector(t) for t in right]
    return [[sum(x * b.get(g, 0.0) for g, x in a.items()) for b in rv] for a in map(vector, left)]


def _texts(kind):
    rng = random.Random(kind)
    if kind == "hot":  # one word in nearly every text, few others
        words = ["county"] * 6 + ["general", "mercy", "oak", "x", "saint luke", "north", "ümlaut"]
        make = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    elif kind == "common":  # nothing but grams that most texts have
        make = lambda: " ".join(["aaaa"] * rng.randint(1, 3) + ["aaab"] * rng.randint(0, 2))
    else:
        make = lambda: "".join(rng.choice("abc ") for _ in range(rng.randint(0, 12)))
    return [make() for _ in range(60)], [make() for _ in range(90)]


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(S, "HOT_GRAM", 5)
    monkeypatch.setattr(S, "SEEDS", 2)


@pytest.mark.parametrize("kind", ["hot", "common", "random"])
def test_threshold_pairs_are_all_pairs(spark, small, kind):
    left, right = _texts(kind)
    scores = _scores(left, right)
    ldf = spark.createDataFrame([(t,) for t in left], "text string")
    rdf = spark.createDataFrame([(t,) for t in right], "text string")
    docs = S.tfidf_docs(ldf, rdf, "text", "text")
    lpost, rpost = S.tfidf_postings(docs)
    name = {(r.side, r.tid): r.text for r in docs.collect()}
    for t in (0.3, 0.8):
        want = {(a, b): x for a, row in zip(left, scores) for b, x in zip(right, row) if x >= t - 1e-12}
        got = {(name["L", r.ltext], name["R", r.rtext]): r.score for r in S.threshold_pairs(lpost, rpost, t).collect()}
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)


@pytest.mark.parametrize("kind", ["hot", "common", "random"])
def test_match_is_the_best(spark, small, kind):
    left, right = _texts(kind)
    got = S.tfidf_match(spark.createDataFrame(list(enumerate(left)), "i int, text string"),
                        spark.createDataFrame([(t,) for t in right], "text string"), "text", "text", 0.5).collect()
    best = [max(row) for row in _scores(left, right)]
    assert len(got) == len(left)
    for r in got:
        assert r.match_flag == int(best[r.i] >= 0.5 - 1e-9)
        assert (r.match_score is None) if not r.match_flag else abs(r.match_score - best[r.i]) < 1e-9


@pytest.mark.parametrize("kind, k", [("hot", 3), ("common", 4), ("random", 10), ("common", 100)])
def test_rerank_takes_the_first_k(spark, small, kind, k):
    left, right = _texts(kind)
    rng = random.Random(1)
    lv, rv = ([[rng.random() for _ in range(3)] for _ in side] for side in (left, right))
    # repeated left rows and right texts of many rows
    left, lv = left + left[:7], lv + lv[:7]
    scores = _scores(left, right)
    ldf = spark.createDataFrame([(i, t, v) for i, (t, v) in enumerate(zip(left, lv))], "id long, text string, v array<double>")
    rdf = spark.createDataFrame([(500 - i, t, v) for i, (t, v) in enumerate(zip(right, rv))], "id long, text string, v array<double>")
    got = {r.id: r.rerank_score for r in S.shortlist_rerank(ldf, rdf, "id", "id", "text", "text", "v", "v", k=k, threshold=0.9).collect()}

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    assert len(got) == len(left)
    for i, row in enumerate(scores):
        first = sorted(range(len(right)), key=lambda j: (-round(row[j], 9), 500 - j))[:k]
        assert abs(got[i] - max(cos(lv[i], rv[j]) for j in first)) < 1e-9


def test_each_left_text_has_a_threshold(spark, small):
    left, right = _texts("hot")
    docs = S.tfidf_docs(spark.createDataFrame([(t,) for t in left], "text string"), spark.createDataFrame([(t,) for t in right], "text string"), "text", "text")
    lpost, rpost = S.tfidf_postings(docs)
    mult = docs.where("side = 'R'").select(docs.tid.alias("text"), "mult")
    name = {r.tid: r.text for r in docs.where("side = 'L'").collect()}
    for r in S._least_scores(lpost, rpost, 3, mult).collect():
        third = sorted(_scores(left, right)[left.index(name[r.text])])[-3]
        assert 0 < r.least <= third + 1e-9


@pytest.fixture()
def cells(small, monkeypatch):
    """A grid of many cells, and a dictionary that is joined by a shuffle."""
    monkeypatch.setattr(S, "LEFT_POSTINGS", 60)
    monkeypatch.setattr(S, "RIGHT_POSTINGS", 90)
    monkeypatch.setattr(S, "SMALL_DICTIONARY", 0)


def test_grid_of_cells_matches_the_best(spark, cells):
    test_match_is_the_best(spark, None, "hot")


def test_grid_of_cells_reranks_the_first_k(spark, cells):
    test_rerank_takes_the_first_k(spark, None, "random", 10)


def test_no_pair_is_shuffled_before_its_score_is_known(spark):
    left, right = _texts("hot")
    docs = S.tfidf_docs(spark.createDataFrame([(t,) for t in left], "text string"), spark.createDataFrame([(t,) for t in right], "text string"), "text", "text")
    posts = S.tfidf_postings(docs)
    for pairs in (S.threshold_pairs(*posts, 0.4, best_only=True), S.top_k_texts(*posts, 3)):
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(ltext" not in plan and "hashpartitioning(rtext" not in plan
        assert "Generate explode" in plan  # postings come from the texts, not from a checkpoint of their own


@pytest.mark.parametrize("numbers, side", [(12_000_000, 100_000), (40, 0)])
def test_rerank_of_odd_vectors_and_ids(spark, small, monkeypatch, numbers, side):
    """One cell and many: the rerank has the same bits as ``dense_cosine``, and NULL where that is NULL."""
    monkeypatch.setattr(S, "CELL_NUMBERS", numbers)
    monkeypatch.setattr(S, "SMALL_SIDE", side)
    rng = random.Random(7)
    vector = lambda n: [rng.uniform(-1, 1) for _ in range(n)]
    odd = [None, [], [0.0] * 5, [None, 1.0, 1.0, 1.0, 1.0], [float("nan")] + vector(4), [float("inf")] + vector(4), vector(4)]
    lrows = [(f"l{i}", "some name", vector(5)) for i in range(9)] + [(f"o{i}", "some name", v) for i, v in enumerate(odd)]
    lrows += [("l0", "other words", vector(5)), (None, "some name", vector(5)), ("t", None, vector(5))]
    rrows = [(i // 2, "some name" if i % 3 else "far", vector(5)) for i in range(8)] + [(20 + i, "a name", v) for i, v in enumerate(odd)]
    rrows += [(None, "some name", vector(5)), (40, None, vector(5))]
    ldf = spark.createDataFrame(lrows, "id string, text string, v array<float>")
    rdf = spark.createDataFrame(rrows, "rid long, text string, rv array<float>")
    got = S.shortlist_rerank(ldf, rdf, "id", "rid", "text", "text", "v", "rv", k=50, threshold=0.2)
    pairs = ldf.where("text IS NOT NULL").select("id").join(ldf.select("id", "v"), "id").crossJoin(rdf.where("rid IS NOT NULL"))
    best = pairs.groupBy("id").agg(F.max(S.dense_cosine("v", "rv")).alias("rerank_score"))
    want = ldf.select("id").join(best, "id", "left").withColumn("rerank_flag", F.when(F.col("rerank_score") >= 0.2, 1).otherwise(0))
    assert Counter(map(str, got.collect())) == Counter(map(str, want.select(got.columns).collect()))


def test_rerank_shuffles_no_vector_for_each_pair(spark):
    rng = random.Random(3)
    left, right, size = 300, 60, 512
    make = lambda n: spark.createDataFrame([(i, f"name {i % 20} of {i}", [rng.random() for _ in range(size)]) for i in range(n)], "id long, text string, v array<double>")
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {f.getName(): f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}

    ldf, rdf = make(left), make(right)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffled()
        out = S.shortlist_rerank(ldf, rdf, "id", "id", "text", "text", "v", "v", k=10)
        assert out.count() == out.where("rerank_score IS NOT NULL").count() == left
        out.write.format("noop").mode("overwrite").save()
        written = sum(n for name, n in shuffled().items() if name not in before)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert written < 5 * (left + right) * size * 8  # a vector for each of ten pairs took twice as much

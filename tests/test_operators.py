"""Unit fixtures and brute-force property checks for the operators (W1, W5, W6,
A2, J1, J5, J6, J7, J8, L2, A15, A18-A20)."""

import datetime as dt
import math
import random
from collections import Counter

from pyspark.sql import functions as F

from quarry.operators import agg as A
from quarry.operators import dedupe as D
from quarry.operators import identity as ID
from quarry.operators import interval as IV
from quarry.operators import merge as M
from quarry.operators import quality as Q
from quarry.operators import rank as R
from quarry.operators import similarity as S
from quarry.operators.ordering import global_row_number


def test_dedupe_longest(spark):
    d = dt.date
    rows = [(1, 2021, d(2021, 1, 1), d(2021, 6, 29), "a"), (1, 2021, d(2021, 1, 1), d(2021, 12, 31), "b"),
            (2, 2021, d(2021, 1, 1), d(2021, 3, 1), "c"), (2, 2021, d(2021, 2, 1), d(2021, 4, 1), "d"),
            (3, None, None, None, "e"), (3, None, d(2020, 1, 1), d(2020, 2, 1), "f")]
    df = spark.createDataFrame(rows, "id int, y int, b date, e date, tag string")
    got = sorted(r.tag for r in D.dedupe_longest(df, ["id", "y"], "b", "e", [F.asc("tag")]).collect())
    assert got == ["b", "d", "f"]


def test_pct_rank_avg_matches_pandas(spark):
    vals = [3, 1, 3, None, 2, 3, 1]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v int")
    got = {r.i: r.v_PCTL for r in R.pct_rank_avg(df, "v", partitions=3).collect()}
    exp = [83.3333, 25.0, 83.3333, None, 50.0, 83.3333, 25.0]
    for i, e in enumerate(exp):
        assert (got[i] is None and e is None) or abs(got[i] - e) < 1e-3


def test_pct_rank_random_vs_python(spark):
    random.seed(3)
    vals = [random.choice([None] + list(range(40))) for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v int")
    got = {r.i: r.p for r in R.pct_rank_avg(df, "v", "p", partitions=5).collect()}
    nn = [v for v in vals if v is not None]
    for i, v in enumerate(vals):
        if v is None:
            assert got[i] is None
        else:
            below = sum(1 for x in nn if x < v)
            eq = sum(1 for x in nn if x == v)
            assert abs(got[i] - (below + (eq + 1) / 2) / len(nn) * 100) < 1e-9


def test_last_non_null_snapshot(spark):
    rows = [(1, 2021, 1.0, 10.0), (1, 2022, None, 20.0), (1, None, None, 30.0)]
    df = spark.createDataFrame(rows, "k int, y int, v double, w double")
    r = D.last_non_null_snapshot(df, "k", ["v", "w"], "y").collect()[0]
    assert (r.v, r.w) == (1.0, 30.0)


def test_group_mode_ties_smallest(spark):
    rows = [(1, "b"), (1, "a"), (1, "b"), (1, "a"), (1, None), (2, None)]
    df = spark.createDataFrame(rows, "k int, v string")
    got = {r.k: r.v for r in A.group_mode(df, "k", "v").collect()}
    assert got == {1: "a"}


def test_nullsafe_full_outer(spark):
    left = spark.createDataFrame([(1, None, "L1"), (2, 2020, "L2")], "k int, y int, a string")
    right = spark.createDataFrame([(1, None, "R1"), (1, None, "R1b"), (3, 2020, "R3")], "k int, y int, b string")
    out = M.nullsafe_full_outer(left, right, ["k", "y"]).collect()
    got = sorted((r.k, r.y, r.a, r.b, r.source) for r in out)
    assert got == [(1, None, "L1", "R1", "both"), (1, None, "L1", "R1b", "both"),
                   (2, 2020, "L2", None, "left only"), (3, 2020, None, "R3", "right only")]


def test_rekey_last_writer_wins(spark):
    changes = spark.createDataFrame(
        [(10, None, "keep", 0), (20, 21, "moved", 1), (None, 31, "orphan", 2), (10, None, "keep2", 3)],
        "old long, new long, attr string, ord int")
    rows = spark.createDataFrame([(10,), (20,), (21,), (31,), (99,)], "k long")
    got = {r.k: (r.attr, r.is_rekeyed) for r in
           ID.apply_rekey(rows, "k", changes, "old", "new", ["attr"], "ord").collect()}
    assert got == {10: ("keep2", 1), 20: ("moved", 1), 21: ("moved", 1), 31: (None, 0), 99: (None, 0)}


def _overlap_ref(b, e, periods):
    for s, t in periods:
        if b is None or e is None or s is None:
            return 1
        if t is not None and t < b:
            continue
        if s > e:
            continue
        return 1
    return 0


def test_interval_overlap_fixture_and_random(spark):
    d = dt.date
    left = [("A", d(2021, 1, 1), d(2021, 12, 31))] * 1
    per = [("A", None, d(2021, 1, 1))]
    cases = [
        ([("A", d(2019, 1, 1), d(2021, 1, 1))], 1), ([("A", d(2019, 1, 1), d(2020, 12, 31))], 0),
        ([("A", d(2021, 12, 31), None)], 1), ([("A", d(2022, 1, 1), None)], 0),
        ([("A", None, d(2019, 1, 1))], 1), ([], 0),
    ]
    for periods, exp in cases:
        l = spark.createDataFrame(left, "k string, b date, e date")
        p = spark.createDataFrame(periods or [("Z", None, None)], "k string, s date, t date")
        got = IV.interval_overlap_flag(l, "k", "b", "e", p, "k", "s", "t").collect()[0].flag
        assert got == exp, periods
    l = spark.createDataFrame([("A", None, d(2021, 1, 1))], "k string, b date, e date")
    p = spark.createDataFrame(per, "k string, s date, t date")
    assert IV.interval_overlap_flag(l, "k", "b", "e", p, "k", "s", "t").collect()[0].flag == 1

    random.seed(11)
    base = dt.date(2015, 1, 1)

    def rd():
        return None if random.random() < 0.05 else base + dt.timedelta(days=random.randint(0, 2500))
    lrows = [(random.randint(0, 30), rd(), rd()) for _ in range(400)]
    prows = [(random.randint(0, 30), rd(), rd() if random.random() < 0.8 else None) for _ in range(300)]
    l = spark.createDataFrame([(i, *r) for i, r in enumerate(lrows)], "i int, k int, b date, e date")
    p = spark.createDataFrame(prows, "k int, s date, t date")
    got = {r.i: r.flag for r in IV.interval_overlap_flag(l, "k", "b", "e", p, "k", "s", "t").collect()}
    byk = {}
    for k, s, t in prows:
        byk.setdefault(k, []).append((s, t))
    assert got == {i: _overlap_ref(b, e, byk.get(k, [])) if k in byk else 0 for i, (k, b, e) in enumerate(lrows)}


def _grams(t):
    out = []
    for w in t.split():
        w = f" {w} "
        for n in (3, 4):
            if len(w) <= n:
                out.append(w)
                break
            out += [w[i:i + n] for i in range(len(w) - n + 1)]
    return out


def _tfidf_ref(left, right):
    docs = left + right
    n = len(docs)
    dfc = Counter(g for d in docs for g in set(_grams(d)))
    def vec(t):
        c = Counter(_grams(t))
        w = {g: tf * (math.log((1 + n) / (1 + dfc[g])) + 1) for g, tf in c.items()}
        nrm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        return {g: x / nrm for g, x in w.items()}
    lv, rv = [vec(t) for t in left], [vec(t) for t in right]
    return [[sum(a[g] * b.get(g, 0.0) for g in a) for b in rv] for a in lv]


def test_tfidf_match_vs_brute_force(spark):
    random.seed(5)
    words = ["alpha", "beta", "gamma", "delta", "saint", "mary", "north", "valley", "river", "oak", "pine"]
    left = [" ".join(random.sample(words, random.randint(1, 4))) for _ in range(40)]
    right = [" ".join(random.sample(words, random.randint(1, 4))) for _ in range(60)]
    sims = _tfidf_ref(left, right)
    ldf = spark.createDataFrame([(i, t) for i, t in enumerate(left)], "i int, text string")
    rdf = spark.createDataFrame([(t,) for t in right], "text string")
    for thr in (0.4, 0.7):
        got = {r.i: (r.match_flag, r.match_score) for r in S.tfidf_match(ldf, rdf, "text", "text", thr).collect()}
        for i in range(len(left)):
            best = max(sims[i])
            assert got[i][0] == (1 if best >= thr - 1e-9 else 0)
            if got[i][0]:
                assert abs(got[i][1] - best) < 1e-9


def test_shortlist_rerank_vs_brute_force(spark):
    random.seed(9)
    words = ["red", "blue", "green", "bolt", "nut", "ring", "gear"]
    lrows, rrows = [], []
    for i in range(12):
        lrows.append((i, " ".join(random.sample(words, 2)), [random.random() for _ in range(4)]))
    for j in range(100, 140):
        rrows.append((j, " ".join(random.sample(words, 2)), [random.random() for _ in range(4)]))
    ldf = spark.createDataFrame(lrows, "id long, text string, v array<double>")
    rdf = spark.createDataFrame(rrows, "id long, text string, v array<double>")
    got = {r.id: (r.rerank_flag, r.rerank_score) for r in
           S.shortlist_rerank(ldf, rdf, "id", "id", "text", "text", "v", "v", k=5, threshold=0.9).collect()}
    sims = _tfidf_ref([t for _, t, _ in lrows], [t for _, t, _ in rrows])

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    for li, (i, _, lv) in enumerate(lrows):
        order = sorted(range(len(rrows)), key=lambda j: (-round(sims[li][j], 9), rrows[j][0]))[:5]
        best = max(cos(lv, rrows[j][2]) for j in order)
        assert abs(got[i][1] - best) < 1e-9
        assert got[i][0] == (1 if best >= 0.9 else 0)


def test_top_bottom_overlap(spark):
    df = spark.createDataFrame([(f"s{i:02d}", float(i)) for i in range(20)], "k string, v double")
    out = A.top_bottom(df, "k", "v", n=15).collect()
    assert len(out) == 31
    keys = [r.k for r in sorted(out, key=lambda r: r.pos)]
    assert keys[0] == "s19" and keys[15] == "---" and keys[16] == "s00"
    assert len(set(keys[:15]) & set(keys[16:])) == 10


def test_pivot_counts_fill_zero(spark):
    df = spark.createDataFrame([(2020, "a"), (2020, "a"), (2021, "b")], "y int, c string")
    got = {r.y: (r.a, r.b) for r in A.pivot_counts(df, "y", "c", ["a", "b"]).collect()}
    assert got == {2020: (2, 0), 2021: (0, 1)}


def test_quality_ops(spark):
    df = spark.createDataFrame([(0,), (5,), (200,), (None,), (-3,)], "x int")
    b = Q.diff_buckets(F.col("x"), df, 180).collect()[0]
    assert (b.exact0, b.within180, b.beyond180, b.non_null) == (1, 2, 1, 4)
    m = {r.column: r.missing for r in Q.missingness(df).collect()}
    assert m == {"x": 1}
    bs = Q.box_stats(spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "x double"), "x").collect()[0]
    assert (bs.q1, bs.median, bs.q3, bs.whisker_high, bs.outliers) == (2.0, 3.0, 4.0, 4.0, 1)


def test_global_row_number(spark):
    random.seed(1)
    rows = [(i, random.randint(0, 50)) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, v int")
    got = {r.i: r.rn for r in global_row_number(df, [F.desc("v"), F.asc("i")], partitions=4).collect()}
    exp = {i: n + 1 for n, (i, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert got == exp


def test_key_coverage_and_dups(spark):
    l = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    r = spark.createDataFrame([(2,), (3,)], "k int")
    c = M.key_coverage(l, r, "k").collect()[0]
    assert (c.distinct_keys, c.matched_keys, c.coverage) == (2, 1, 0.5)
    assert D.duplicate_count(l, ["k"]).collect()[0].dups == 1

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quarry.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    found = [(d, Counter(split(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in found)
    words = sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in found:
            m = 10 + (90 * sum(c.values()) * n_docs // words if words else 0)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(split(text)) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def tables():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["The", "the", "ÉTÉ", "été", "a_b", "x-1", "日本", "\x00nul"]
    weight = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weight, k=rng.choice([0, 1, 5, 40, 200])))) for i in range(250)]
    docs += [(3, "w1 w2 w59"), (3, "w1 w2 w59"), (None, "w1 w2 w59"), (None, None), (1000, ""), (1001, "w5 " * 60_000)]
    docs += [(2000 + i, "w7 w58 copies of one text") for i in range(40)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 4, 30])))) for i in range(30)]
    return docs, items + [(None, "w3 w4"), (5, "w58 copies"), (5, "w58 copies"), (900, None), (901, "nowhere at all"), (902, "...")]


@pytest.mark.parametrize("docs_limit, postings, query_terms, bits", [(S.DOCS, S.POSTINGS, S.QUERY_TERMS, S.BITS), (7, 50, 20, 3), (100, 1 << 20, 1, 12)])
def test_search_against_brute_force(spark, monkeypatch, docs_limit, postings, query_terms, bits):
    for name, value in (("DOCS", docs_limit), ("POSTINGS", postings), ("QUERY_TERMS", query_terms)):
        monkeypatch.setattr(S, name, value)
    monkeypatch.setattr(S.asked_terms, "__defaults__", (bits,))
    docs, items = tables()
    if query_terms == 1:
        items = items[:4]
    d = spark.createDataFrame([(i, t, 1, "z") for i, t in docs], "doc_id long, text string, score long, terms string").repartition(3)
    q = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, uid int")
    got = sorted((tuple(r) for r in S.search(d, q).select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert got == brute(docs, items)


def test_text_ids_and_other_k(spark):
    docs, items = tables()
    docs = [(None if i is None else f"d{i:05}", t) for i, t in docs if i != 3]
    empty = S.search(spark.createDataFrame([("", "a"), ("b", "a"), (None, "a"), ("c", "x")], "doc_id string, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string"))
    assert [r.doc_id for r in empty.orderBy("rank").collect()] == ["", "b", None]
    got = S.search(spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame(items, "item_id long, text string"), k=3).collect()
    want = {}
    for item, rank, doc, score in brute([(i and int(i[1:]), t) for i, t in docs], items, 3):
        want.setdefault(item, set()).add((rank, score))
    assert {(r.item_id, r["rank"], r.score) for r in got} == {(i, *x) for i, own in want.items() for x in own}


def test_accumulators_are_limited_and_results_exact():
    rng = np.random.default_rng(2)
    n = 5000
    lists = {}
    for t, df in [("rare", 15), ("mid", 200), ("wide", 2000), ("all", 4900)]:
        docs = np.sort(rng.choice(n, df, replace=False))
        part = rng.integers(1, 1000, df)
        lists[t] = docs, part, int(part.max())
    item = [("rare", 9000), ("mid", 900), ("wide", 90), ("all", 1), ("gone", 5)]
    exact = np.zeros(n, np.int64)
    for t, w in item[:-1]:
        exact[lists[t][0]] += w * lists[t][1]
    docs, score = S.first(item, lists, n, 10)
    assert score.tolist() == exact[docs].tolist()
    assert sorted(score.tolist(), reverse=True)[:10] == np.sort(exact)[::-1][:10].tolist()


def test_empty_tables(spark):
    docs, items = "doc_id long, text string", "item_id long, text string"
    some = spark.createDataFrame([(1, "a")], docs)
    assert S.search(some, spark.createDataFrame([], items)).count() == 0
    assert S.search(spark.createDataFrame([], docs), spark.createDataFrame([(1, "a")], items)).count() == 0
    assert S.search(spark.createDataFrame([(1, None)], docs), spark.createDataFrame([(1, "a")], items)).count() == 0
    one = S.search(some, spark.createDataFrame([(1, "A")], items))
    assert one.columns == ["item_id", "rank", "doc_id", "score"] and one.count() == 1

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = TERM.findall((text or "").translate(lower))
        count[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        mine = [s for x, s in groups if x == lang]

        def p(counts):
            total = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // total for t in kept}

        own, whole = p(count[lang, source]), p(sum((count[lang, s] for s in mine), Counter()))
        pairs = []
        for s in mine:
            if s != source:
                q = p(count[lang, s])
                pairs.append((-sum((own[t] - q[t]) ** 2 // (own[t] + q[t]) for t in kept), s.encode()))
        terms = [(-((own[t] - whole[t]) ** 2 // (own[t] + whole[t])), t.encode()) for t in kept if count[lang, source][t] > 0 and own[t] > whole[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(found)]
    return sorted(out)


def documents():
    rng = np.random.default_rng(5)
    words = ["alpha", "Beta", "gamma", "ÉTÉ", "été", "x", "日本", "o'clock", "a1b", "ñandú", "Zulu", "zz"]
    rows = []
    for k in range(300):
        lang = [None, "", "en", "fr", "solo"][k % 5]
        source = "only" if lang == "solo" else ["a", "b", "B", "é", None][int(rng.integers(5)) if k % 3 else 0]
        rows.append((" ".join(rng.choice(words, int(rng.integers(0, 40)), p=np.arange(1, 13) / 78)) + "\x00.\n", lang, source))
    rows += [(None, "en", "a"), ("", "de", "q"), ("rare words", "de", "r"), (" 1 2 3 ", "de", None), ("the " * 70_000, "en", "b")]
    return rows + rows[:20]


@pytest.mark.parametrize("cells, block, min_docs, slices", [(D.CELLS, D.BLOCK, 10, D.SLICE), (4, 2, 3, 100), (1, 1, 10_000, 1)])
def test_audit_against_brute_force(spark, monkeypatch, cells, block, min_docs, slices):
    monkeypatch.setattr(D, "BLOCK", block)
    rows = documents()
    df = spark.createDataFrame([(t, x, s, 1, "k") for t, x, s in rows], "text string, lang string, source string, n long, term string").repartition(3)
    monkeypatch.setattr(D, "CELLS", cells)
    docs = df.na.fill("", ["text", "lang", "source"])
    terms = D.kept_terms(D.partial_counts(docs), min_docs)
    found = D.divergences(terms, docs.select("lang", "source"), cells)
    assert sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in found.collect()) == brute(rows, min_docs)


def test_slices_and_merging_change_nothing(monkeypatch):
    rows = [(t or "", x or "", s or "") for t, x, s in documents()]
    batch = pa.RecordBatch.from_pydict({c: pa.array([r[k] for r in rows], pa.string()) for k, c in enumerate(["text", "lang", "source"])})
    total = {}
    for slices, merge in ((1 << 24, 1 << 20), (50, 7), (1, 1)):
        monkeypatch.setattr(D, "SLICE", slices)
        monkeypatch.setattr(D, "MERGE_ROWS", merge)
        got = Counter()
        for b in D._partial(iter([batch, batch.slice(0, 0)])):
            for r in b.to_pylist():
                got[r["lang"], r["source"], r["term"], "n"] += r["n"]
                got[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        total[slices] = got
    assert len(set(map(str, map(sorted, (x.items() for x in total.values()))))) == 1


def test_shares_are_exact():
    rng = np.random.default_rng(1)
    b = rng.integers(1, 9 * 10**15, 2000)
    a = np.minimum(rng.integers(0, 9 * 10**15, 2000), b)
    assert D.shares(a, b).tolist() == [1 + 10**9 * int(x) // int(y) for x, y in zip(a, b)]


def test_empty_table(spark):
    assert D.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0
    one = D.audit(spark.createDataFrame([(None, None, None), (None, None, "s")], "text string, lang string, source string"))
    assert sorted(map(tuple, one.collect())) == [("", "", "pair", "s", 0, 1), ("", "s", "pair", "", 0, 1)]

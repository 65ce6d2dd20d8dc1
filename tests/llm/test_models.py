"""Language ID, licence scan, token counts, neighbours."""
import math
import random

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import language_id as L
from quarry.llm import license_scan as S
from quarry.llm import neighbours as N
from quarry.llm import token_counts as C

DIR = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "lang")
    got = L.query(spark, DIR).join(docs, "doc_id").filter("held_out").collect()
    assert len(got) > 20 and all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)


def test_language_cases(spark):
    rows = [(1, "le la les été", "fr"), (2, "the of and", "en"), (3, "the water of", "en"), (4, "la mer est", "fr"), (5, None, "en"), (None, "the and", "en"), (7, "x", None)]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["en", "fr"]
    ask = [(1, None), (2, ""), (3, "12 %% \n"), (4, "the of"), (4, "the of"), (None, "LA MER"), (9, "the " * 300_000)]
    df = spark.createDataFrame([(i, t, 1, "q") for i, t in ask], "doc_id long, text string, score int, lang_pred string")
    got = [(r.doc_id, r.lang_pred, r.score > 0) for r in L.identify(df, model).collect()]
    assert got == [(1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (4, "en", True), (None, "fr", True), (9, "en", True)]
    none = L.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert [r.lang_pred for r in L.identify(df, none).collect()] == ["und"] * len(ask)


def test_features_do_not_depend_on_chunks(monkeypatch):
    text = "Il était  une fois, 12 petits—cochons. " * 50
    whole = np.sort(np.concatenate(list(L.features(text))))
    monkeypatch.setattr(L, "CHUNK", 7)
    assert (np.sort(np.concatenate(list(L.features(text)))) == whole).all()


def test_license_scan(spark):
    prose = ["the of and water river in the house", "old men have license to walk", "this version of the story is free"]
    docs = [(i, "\n".join(random.Random(i).sample(prose, 2)) + f" {i}") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = S.fit(df)
    assert 0.5 <= model.threshold <= 0.99
    ask = [(1, "a b\nReleased under the MIT License.\nc"), (2, None), (3, " \n "), (4, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0"), (4, "He has a license to drive."),
           (None, "This work is licensed under the GNU General Public License, version 3."), (6, "word " * 50_000), (7, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.")]
    out = S.scan(spark.createDataFrame([(i, t, 0) for i, t in ask], "doc_id long, text string, licenses int"), model).collect()
    got = [[x.family for x in r.licenses] for r in out]
    assert got == [["MIT"], [], [], ["Apache-2.0"], [], ["GPL-3.0"], [], ["CC-BY-NC-4.0"] * 2]
    assert out[0].licenses[0].paragraph == "Released under the MIT License."
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.scan(empty, S.fit(empty)).count() == 0


SIBLINGS = {
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
                "This work is licensed under the GNU General Public License, version 2."],
    "LGPL-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0."],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
         "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/",
         "This work is licensed under a Creative Commons Attribution 3.0 Unported License.", "Licensed under the Apache License, Version 1.1.",
         "the Free Software Foundation, either version 3 of the License, or",
         "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
}


def test_sibling_licences_are_their_own_or_unknown(spark):
    model = S.fit(spark.createDataFrame([(i, f"the river and the old house {i}") for i in range(40)], "doc_id long, text string"))
    own = {f: [t + "." for t in ts] for f, ts in S.TEMPLATES.items()}
    for of, least in ((SIBLINGS, 1), (own, 25)):
        rows = [(f, t) for f, ts in of.items() for t in ts]
        got = [(r.id, r.text, [x.family for x in r.licenses]) for r in S.scan(spark.createDataFrame(rows, "id string, text string"), model).collect()]
        assert [x for x in got if x[2] not in ([], [x[0]])] == []
        assert sum(x[2] == [x[0]] for x in got) >= least, got


def best(word, pieces, fallback):
    score = [(0.0, 0)] + [None] * len(word)
    for e in range(1, len(word) + 1):
        size = len(word[e - 1].encode())
        score[e] = (score[e - 1][0] + size * fallback, score[e - 1][1] - size)
        for b in range(e):
            if word[b:e] in pieces:
                score[e] = max(score[e], (score[b][0] + pieces[word[b:e]], score[b][1] - 1))
    return -score[-1][1]


def test_token_counts_equal_plain_programming(spark, monkeypatch):
    path = C.vocabulary_path()
    pieces = C.vocabulary(path)
    fallback = min(pieces.values()) - 1
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeé😀tionr") for _ in range(rng.randint(1, 12))) for _ in range(300)]
    trie = C.Trie(pieces)
    monkeypatch.setattr(C, "NODES", 100)
    assert all(trie.insert(w) == best(w, pieces, fallback) for w in words)
    assert len(trie.nodes) <= 200
    texts = [None, "", " \n", " ".join(words), "x" * 500, "a\xa0b c"]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)] + [(None, "a", 5)], "doc_id long, text string, n_tokens int")
    for r in C.count_tokens(df, path).collect():
        found = C.pre_tokens(r.text)
        assert (r.n_words, r.n_tokens) == (len(found), sum(best(C.MARK + w, pieces, fallback) for w in found))
    assert C.count_tokens(df.limit(0), path).count() == 0


def brute(rows, k):
    out = {}
    for q, x in rows:
        if q % 20 == 0:
            found = sorted([(-float(np.dot(np.float64(x), np.float64(y))), i) for i, y in rows if i != q])[:k]
            out[q] = [i for _, i in found]
    return out


def vectors(n=600, d=8, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[100:400] = x[100]  # a hot vector
    x[5] *= 30
    return [(i, x[i].tolist()) for i in range(n)]


def test_neighbours(spark, monkeypatch):
    rows = vectors()
    bad = [(1000, None), (1020, []), (1040, [0.0] * 8), (1060, [math.nan] * 8), (1080, [1.0, None] * 4), (1100, [math.inf] * 8), (None, rows[0][1]), (1120, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "z") for i, v in rows + rows[:30] + bad], "vec_id long, embedding array<float>, rank int, key string")
    for part in (4000, 7):
        monkeypatch.setattr(N, "PART", part)
        got = {}
        for r in N.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r)
        want = brute(rows, 20)
        assert got.keys() == want.keys()
        vector = dict(rows)
        hit = 0
        for q, own in got.items():
            assert [r.rank for r in own] == list(range(1, 21))
            assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
            assert all(math.isclose(r.score, float(np.dot(np.float64(vector[q]), np.float64(vector[r.vec_id]))), rel_tol=1e-12, abs_tol=1e-12) for r in own)
            hit += len({r.vec_id for r in own} & set(want[q]))
        assert hit >= 0.9 * 20 * len(want)


def test_few_or_no_neighbours(spark):
    schema = "vec_id long, embedding array<float>"
    got = N.search(spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 0.0])], schema), F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2)]
    assert N.search(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    assert N.search(spark.createDataFrame([(20, [1.0])], schema), F.col("vec_id") % 20 == 0).count() == 0

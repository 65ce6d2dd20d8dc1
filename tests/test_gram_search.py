"""The search within a cell: right on odd vectors, and it reads little of what it could."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quarry.operators import gram_search as G
from quarry.operators import similarity as S


def _table(vectors, start=0):
    """vectors: {gram: raw weight}; some grams are not shared, so the norm is larger than that of the vector."""
    norm = [1.1 * sum(x * x for x in v.values()) ** 0.5 for v in vectors]
    return pa.table({"text": pa.array(range(start, start + len(vectors)), pa.int64()), "norm": norm,
                     "ids": pa.array([list(v) for v in vectors], pa.list_(pa.int64())), "ws": pa.array([list(v.values()) for v in vectors], pa.list_(pa.float64()))})


def _products(left, right):
    full = lambda t: [dict(zip(i, (x / n for x in w))) for i, w, n in zip(*(t.column(c).to_pylist() for c in ("ids", "ws", "norm")))]
    return np.array([[sum(x * b.get(g, 0.0) for g, x in a.items()) for b in full(right)] for a in full(left)])


NUMBERS = {}


def _names(n, rng, places=12, digits=3):
    """Numbers and places: few texts share a number's grams, many those of a place."""
    out = []
    for _ in range(n):
        number = "".join(rng.choice("0123456789") for _ in range(digits * 2))
        grams = Counter(number[i:i + digits] for i in range(digits + 1)) + Counter({f"place {rng.randrange(places)}": 2, "all": rng.randint(1, 4)})
        out.append({NUMBERS.setdefault(g, len(NUMBERS)): c * (1.0 if g == "all" else 2.5 if g[0] == "p" else 6.0) for g, c in grams.items()})
    return out


def _odd(kind, rng):
    if kind == "repeats":  # one text repeats its grams very often
        return [{rng.randrange(9): rng.choice([1.0, 2.0, 40.0]) for _ in range(4)} for _ in range(50)]
    if kind == "equal":
        return [{1: 2.0, 2: 3.0} for _ in range(50)]
    if kind == "single":
        return [{rng.randrange(1000): 1.5} for _ in range(50)]
    return _names(50, rng)


@pytest.mark.parametrize("kind", ["repeats", "equal", "single", "names"])
@pytest.mark.parametrize("least, k", [(0.3, None), (0.4, 1), (0.0, 3), (0.0, 200)])
@pytest.mark.parametrize("hot, sums", [(2, 120), (512, 8_000_000)])
def test_cell_search_finds_all(monkeypatch, kind, least, k, hot, sums):
    monkeypatch.setattr(G, "SUMS", sums)
    monkeypatch.setattr(G, "CHUNK_POSTINGS", 60 if sums < 1000 else 200_000)
    rng = random.Random(5)
    left, right = _table(_odd(kind, rng)), _table(_odd(kind, rng) + _names(5, rng), 500)
    found = G.cell_search(least, k, hot, 2)(left, right).to_pydict()
    got = {(a, b - 500): s for a, b, s in zip(found["ltext"], found["rtext"], found["score"])}
    assert len(got) == len(found["score"])
    for i, row in enumerate(_products(left, right)):
        bound = max(least, sorted(row)[-k] if k and k <= len(row) else 0.0)
        want = {j for j, x in enumerate(row) if x > 0 and x >= bound}
        mine = {j for a, j in got if a == i}
        assert want <= mine and all(row[j] >= bound - 1e-8 for j in mine)
        assert all(abs(got[i, j] - row[j]) < 1e-12 for j in mine)


def test_few_postings_are_read_and_many_texts_at_once(monkeypatch):
    rng = random.Random(8)
    left, right = _table(_names(2_000, rng)), _table(_names(2_000, rng))
    read, batches, add, search = [], [], G._Batch.add, G._Batch.search
    monkeypatch.setattr(G._Batch, "add", lambda self, *a: read.append(add(self, *a)) or read[-1])
    monkeypatch.setattr(G._Batch, "search", lambda self: batches.append(1) or search(self))
    found = G.cell_search(0.4, 1, S.HOT_GRAM, S.SEEDS)(left, right)
    sizes = Counter(g for v in right.column("ids").to_pylist() for g in v)
    every = sum(sizes[g] for v in left.column("ids").to_pylist() for g in v)
    assert found.num_rows > 300 and len(batches) < 2_000 / 50
    assert sum(map(len, read)) < every / 10


def test_vectors_are_made_without_a_row_for_each_gram(spark):
    """The dictionary goes to every task; texts become vectors there, and the same ones as by a join."""
    texts = [("the north oak",), ("oak oak oak",), ("",), (None,), ("zzz",), ("\U0001f333 oak",)]
    left, right = spark.createDataFrame(texts, "text string"), spark.createDataFrame([("oak hill",), ("north \U0001f333",), ("oak",)], "text string")
    docs = S.tfidf_docs(left, right, "text", "text")
    dictionary = S.gram_dictionary(docs)
    plan = S.tfidf_postings(docs, dictionary=dictionary)[0]._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "explode" not in plan and "Window" not in plan
    small, S.SMALL_DICTIONARY = S.SMALL_DICTIONARY, 0
    try:
        joined = S.tfidf_postings(docs, dictionary=dictionary)
    finally:
        S.SMALL_DICTIONARY = small
    for a, b in zip(S.tfidf_postings(docs, dictionary=dictionary), joined):
        a, b = ({r.text: (round(r.norm, 12), {i: round(w, 12) for i, w in zip(r.ids, r.ws)}) for r in x.collect()} for x in (a, b))
        assert a == b and a


@pytest.mark.parametrize("norms", [[1.0], [1.0, 5.0, 5.001, 30.0], [0.5 + i / 7 for i in range(400)]])
def test_parts_have_texts_of_like_norm_and_as_many_postings(spark, norms):
    rows = [(i, norms[i % len(norms)], [1] * (1 + i % 3)) for i in range(4_000)]
    post = spark.createDataFrame(rows, "text long, norm double, ids array<long>")
    got = post.select("norm", "ids", S._part_by_norm(post, 5).alias("part")).collect()
    sizes, ends = Counter(), {}
    for r in got:
        sizes[r.part] += len(r.ids)
        ends.setdefault(r.part, []).append(r.norm)
    assert sorted(sizes) == [0, 1, 2, 3, 4] and max(sizes.values()) < 1.15 * min(sizes.values())
    for a in range(4):
        assert max(ends[a]) <= min(ends[a + 1]) * 1.011
    assert {r[0] for r in post.select(S._part_by_norm(post, 1)).collect()} == {0}

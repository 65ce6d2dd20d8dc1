import random
import re

import pytest

from quarry.llm import near_dedup as N
from quarry.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else []))
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            k = len(sets[a] & sets[b])
            if sets[a] and 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    first = {}
    for x, (i, _) in zip(label, rows):
        if i is not None:
            first[x] = min(first.get(x, i), i)
    return sorted([(i is None, i or 0, len(s), (first.get(x) if s else i)) for (i, _), s, x in zip(rows, sets, label)], key=str)


def corpus(seed, groups=12, big=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["the", "of"] * 60
    rows, n = [], 0
    for g in range(groups):
        base = [rng.choice(vocab) for _ in range(rng.choice([2, 5, 12, 60, 150]))]
        for _ in range(big if g == 0 else rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 9))):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((n, (" " if rng.random() < 0.5 else "\n\t").join(copy)))
            n += 1
    odd = [None, "", " \t", "Single", "single", "SINGLE ", "É é", "É é", "x" * 9000 + " y", "x" * 9000 + " Y"]
    return rows + [(n + k, t) for k, t in enumerate(odd)] + [(None, "Single"), (None, rows[0][1]), (3, rows[3][1]), (n + 99, "common " * 20_000)]


@pytest.mark.parametrize("node,seed", [(3000, 1), (12, 2)])
def test_components_equal_brute_force(spark, monkeypatch, node, seed):
    monkeypatch.setattr(N, "NODE", node)
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, sig string")
    got = N.classify(df).collect()
    assert sorted([(r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got], key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("ids", [500_000, 0])
def test_dedup_keeps_one_of_each_group(spark, monkeypatch, ids):
    monkeypatch.setattr(N, "BROADCAST_IDS", ids)
    rows = [(5, "a b c d e f"), (2, "A b c d e f"), (9, "q r s"), (9, "q r s"), (11, None), (12, ""), (None, "u v w")]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, kept string")
    out = N.dedup(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == [11, 12, 2, 9, None]


@pytest.mark.parametrize("ids", [500_000, 0])
def test_dedup_decides_by_row_where_ids_clash(spark, monkeypatch, ids):
    monkeypatch.setattr(N, "BROADCAST_IDS", ids)
    near = [f"w{i}" for i in range(40)]
    first, copy = " ".join(near), " ".join([*near[:-1], "other"])
    stay = [(None, "a b c"), (None, "d e f"), (None, None), (None, ""), (2, first), (9, "y one two"), (7, "p q"), (7, "r s"), (8, None), (8, " "), (8, "t u")]
    go = [(9, copy), (None, copy), (12, copy), (12, "y one two"), (7, "r  S"), (None, "A b c")]
    df = spark.createDataFrame([(i, t, "z") for i, t in stay + go], "doc_id long, text string, sig string")
    got = [(r.doc_id, (r.text or "").lower().split()) for r in N.dedup(df).collect()]
    assert sorted(got, key=str) == sorted([(i, (t or "").split()) for i, t in stay], key=str)


def test_empty_table(spark):
    assert N.classify(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_trees_reach_the_target():
    assert N.trees_for(0.999, 0.8, 5, 3) >= 1
    assert (3 * 0.2**5) ** N.trees_for(0.999999, 0.8, 5, 3) <= 1e-6


def test_long_chains_and_hubs(spark):
    rng = random.Random(1)
    name = {i: f"{rng.getrandbits(64):016x}" for i in range(400)}
    links = [(name[i], name[i + 1]) for i in range(199)] + [(name[200], name[i]) for i in range(201, 400)] + [(name[5], name[5])]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert len(got) == 400
    assert len({got[name[i]] for i in range(200)}) == 1
    assert len({got[name[i]] for i in range(200, 400)}) == 1
    assert got[name[0]] != got[name[200]]
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_blocks_are_bounded_by_tokens(spark, monkeypatch):
    monkeypatch.setattr(N, "PART_TOKENS", 50)
    rows = corpus(4)
    got = N.classify(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([(r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got], key=str) == brute(rows)
    # 40 sets of 30 tokens: 1,200 in 24 parts, so no pair of parts holds all
    sets = [(bytes([k]), 30, bytes(240)) for k in range(40)]
    df = spark.createDataFrame([(1, 40, 1200, *x) for x in sets], "key long, size long, weight long, sig binary, n long, tokens binary")
    blocks = N._deal(df, 3000).groupBy("block").sum("n").collect()
    assert len(blocks) > 24 and max(r[1] for r in blocks) < 600

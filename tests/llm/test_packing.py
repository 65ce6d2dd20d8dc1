import random
import zlib

import numpy as np
import pytest

from quarry.llm import packing as P

ALPHABET = "aàÉß ń'sS'Re 12٣,.!<|endoftext|>\x1c\x1f\x85\xa0　\n\tİΣςKÅẖ😀\x00\x7f​_́"


def ids(text):
    return P._tokenizer(P.tokenizer_path()).encode(text or "", add_special_tokens=False).ids


def test_encoder_is_the_tokenizer():
    rng = random.Random(1)
    e = P.encoder(P.tokenizer_path())
    some = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 50))) for _ in range(2000)]
    for t in some + [None, "", "I've we'll <|startoftext|>x", "x" * 5000, "é ́ ÉCLAIR"]:
        assert e.encode(t) == np.array(ids(t), "<u4").tobytes(), t


def test_simple_characters_are_those_of_the_tokenizer():
    e = P.encoder(P.tokenizer_path())
    rng = random.Random(6)
    simple = [chr(i) for i in range(0x10FFFF) if P.SIMPLE.fullmatch(chr(i))]
    for _ in range(3000):
        t = "".join(rng.choice(simple) if rng.random() < 0.7 else rng.choice("ab '.9\n") for _ in range(30))
        assert e.encode(t) == np.array(ids(t), "<u4").tobytes(), t
    for c in simple:
        assert e.encode(f"a{c}b{c} {c}") == np.array(ids(f"a{c}b{c} {c}"), "<u4").tobytes(), c


def check(docs_rows, packed, length):
    pieces = {}
    for r in packed:
        pieces.setdefault(r.sequence_id, []).append(r)
    for own in pieces.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    want = []
    for i, t in docs_rows:
        x = [*ids(t), 1]
        for k, s in enumerate(range(0, len(x), length)):
            part = x[s:s + length]
            want.append((i, k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda x: (x[0] is None, x)
    got = sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed], key=lambda x: (x[0] is None, x[0] or 0, x[1:]))
    assert got == sorted(want, key=lambda x: (x[0] is None, x[0] or 0, x[1:])), key
    return len(pieces), sum(r.length for r in packed)


def rows(n=400, seed=2):
    rng = random.Random(seed)
    out = [(i, " ".join(rng.choice(["a", "bb", "the", "zq"]) for _ in range(rng.choice([0, 3, 20, 63, 64, 90, 300])))) for i in range(n)]
    return out + [(None, None), (0, "again"), (0, "again"), (7, ""), (n, "word " * 5000)]


@pytest.mark.parametrize("shard", [4096, 40])
def test_packing_is_whole_gapless_and_tight(spark, monkeypatch, shard):
    monkeypatch.setattr(P, "SHARD", shard)
    docs = rows()
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, length int, sequence_id int")
    packed = P.pack_documents(df, length=64).collect()
    n, total = check(docs, packed, 64)
    assert n <= 1.01 * total / 64 + 2


def test_sequences_hold_the_tokens(spark):
    docs = rows(60)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    packed = P.pack_documents(df, length=64)
    packed = packed.cache()
    made = {r.sequence_id: r.ids for r in P.sequences(df, packed, length=64).collect()}
    for r in packed.collect():
        part = made[r.sequence_id][r.offset:r.offset + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
    assert sum(map(len, made.values())) == sum(r.length for r in packed.collect())


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_crossover_gives_whole_packings():
    rng, size = random.Random(4), np.random.default_rng(4).integers(1, 60, 300)
    a = P.fresh(size, 100, list(range(300)))
    b = P.fresh(size, 100, sorted(range(300), key=lambda i: -size[i]))
    for _ in range(20):
        child = P.cross(a, b, size, 100, rng)
        fill = np.bincount(child, size)
        assert fill.max() <= 100 and fill.min() > 0 and len(child) == 300


def test_evolution_beats_best_fit():
    # triples that fill a bin exactly, where best fit decreasing is known to be off the bound
    rng = np.random.default_rng(0)
    cut = np.sort(rng.integers(250, 500, (40, 2)), axis=1)
    size = np.concatenate([cut[:, 0], 1000 - cut.sum(axis=1) + 0 * cut[:, 1], cut[:, 1]])
    first = P.evolve(size, [], 1000, 0, 1)
    last = P.evolve(size, first, 1000, 300, 2)
    assert P.quality(last[0], size, 1000) < P.quality(first[0], size, 1000)
    assert P.quality(last[0], size, 1000)[0] >= 40

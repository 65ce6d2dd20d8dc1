import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from quarry.llm import binary_packing as B

ALPHABET = "aàÉß ń'sS'Re 12٣,.!<|endoftext|>\x1c\x1f\x85\xa0　\n\tİΣςKÅẖ😀\x00\x7f᠎﻿​_́  \n\n "


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(B.tokenizer_path())
    t.encode_special_tokens = True
    return t


def ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, B.END]


def test_encode_is_the_tokenizer(tokenizer):
    rng = random.Random(3)
    some = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    for t in some + [None, "", " ", "  ", "\n \n", "I've we'll <|endoftext|>x", "x" * 5000, " " * 3000 + "a", "a\r\n\r\n b"]:
        assert [*B.encode(B.tokenizer_path(), t).tolist(), B.END] == ids(tokenizer, t), repr(t)


@pytest.mark.parametrize("n", [1, 2, 7, 63, 64, 65, 1000])
def test_decompose(n):
    found = B.decompose(n, 64).tolist()
    assert sum(found) == n and sorted(found, reverse=True) == found
    assert all(k & (k - 1) == 0 and k <= 64 for k in found)
    assert len(found) == n // 64 + bin(n % 64).count("1")  # the fewest such pieces


def docs():
    rng = random.Random(2)
    out = [(i, " ".join(rng.choice(["a", "bb", "the", "zq"]) for _ in range(rng.choice([0, 3, 20, 63, 64, 90, 300])))) for i in range(150)]
    return out + [(None, None), (0, "again"), (0, "again"), (7, ""), (900, "word " * 5000)]


def test_pieces_against_the_tokenizer(spark, tokenizer):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs()], "doc_id long, text string, length int, sequence_id int").repartition(5)
    got = B.sequences(df, length=64).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    assert all(r.offset == 0 and r.length == 1 << r.bucket == len(r.ids) and r.length <= 64 for r in got)
    want = []
    for i, t in docs():
        x, at = ids(tokenizer, t), 0
        for k in B.decompose(len(x), 64).tolist():
            want.append((i, at, k, zlib.crc32(np.array(x[at:at + k], "<u4").tobytes()), len(x), x[at:at + k]))
            at += k
        assert at == len(x)
    assert sorted(([r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.ids] for r in got), key=str) == sorted(map(list, want), key=str)


def test_batches_hold_equal_lengths(spark):
    df = spark.createDataFrame(docs(), "doc_id long, text string").repartition(7)
    found = spark.createDataFrame(B.sequences(df, length=64, with_ids=False).collect())
    rows = B.batches(found, tokens=256).join(found.select("sequence_id", "length"), "sequence_id").collect()
    assert sorted(r.sequence_id for r in rows) == sorted(r.sequence_id for r in found.collect())
    for bucket in {r.bucket for r in rows}:
        own = sorted((r.batch, r.slot) for r in rows if r.bucket == bucket)
        per = 256 >> bucket
        assert own == [divmod(k, per) for k in range(len(own))]


def test_write_makes_a_folder_per_bucket(spark, tmpdir_path):
    df = spark.createDataFrame(docs(), "doc_id long, text string")
    B.write(df, f"{tmpdir_path}/out", length=64)
    back = spark.read.parquet(f"{tmpdir_path}/out").where("bucket = 3").collect()
    assert back and all(len(r.ids) == 8 for r in back)


def test_empty_table_and_bad_length(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert B.sequences(empty).count() == 0
    assert B.batches(B.sequences(empty, with_ids=False)).count() == 0
    with pytest.raises(ValueError):
        B.sequences(empty, length=1000)

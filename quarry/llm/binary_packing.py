"""Packing without padding: documents decomposed into pieces of power-of-two length.

A tokenised document of n tokens is cut, from its start, into as many pieces of ``length`` (a
power of two) as fit, and the rest by the binary digits of its size, longest first. Every
piece is a sequence of its own, so that no sequence crosses documents, and its length is a power
of two, so that none is padded. Pieces of equal length form a bucket (its number is the binary
logarithm); ``batches`` deals the sequences of each bucket to batches of equal size in tokens,
and ``write`` stores the sequences, one folder per bucket.

Cutting needs no shuffle: a document is cut where it is read, one row of pieces per document.

Defined cases: NULL text is empty (one piece: the end token alone); NULL and repeated ids are
cut row by row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm import bpe
from quarry.llm.common import cut_lineage, read, use_package

LENGTH = 1024
END = 0
TOKENIZER = "byte_bpe_50k.json"
#: Tokens of a batch of equal-length sequences.
BATCH_TOKENS = 1 << 20

#: The tokenizer's own pattern without its look-ahead (``_cuts`` stands for that), and its white space.
PATTERN = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
SPACES = re.compile("[\t-\r \x85\xa0  -     　]{2,}")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def encode(path: str, text: str | None) -> np.ndarray:
    """The ids of a text.

    The tokenizer leaves the last of several white-space characters to what follows. Cut there,
    each part is encoded alone, without the look-ahead that its pattern would need."""
    if not text:
        return np.empty(0, "<u4")
    model, at, ranks = bpe.core(path, PATTERN), 0, []
    for m in SPACES.finditer(text):
        if m.end() < len(text):
            ranks += model.core.encode_ordinary(text[at : m.end() - 1])
            at = m.end() - 1
    ranks += model.core.encode_ordinary(text[at:])
    return model.ids[ranks]


def decompose(n: int, length: int) -> np.ndarray:
    """The lengths of the pieces of a document of n tokens, in order."""
    rest = n % length
    return np.array([length] * (n // length) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1], np.int64)


@functools.cache
def _kind(with_ids: bool) -> pa.DataType:
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    return pa.list_(pa.struct(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else [])))


def _pieces(path: str, length: int, end: int, with_ids: bool):
    @F.arrow_udf("array<struct<start: long, length: long, ids_crc32: long, doc_tokens: long" + (", ids: array<int>>>" if with_ids else ">>"))
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for text in batch:
                ids = np.append(encode(path, text.as_py()), np.uint32(end)).astype("<u4")
                row, at = [], 0
                for k in decompose(len(ids), length).tolist():
                    part = ids[at : at + k]
                    x = {"start": at, "length": k, "ids_crc32": zlib.crc32(part), "doc_tokens": len(ids)}
                    row.append(x | {"ids": part.astype(np.int32)} if with_ids else x)
                    at += k
                rows.append(row)
            yield pa.array(rows, _kind(with_ids))

    return cut


def sequences(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, with_ids: bool = True) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids), sequence_id, offset, bucket of each
    piece of each document. ``sequence_id`` numbers the pieces as they are read."""
    if length < 1 or length & (length - 1):
        raise ValueError("the longest length has to be a power of two")
    use_package(docs.sparkSession)
    cut = _pieces(path or tokenizer_path(), length, end, with_ids)
    rows = docs.select("doc_id", F.explode(cut(F.col("text"))).alias("p")).select("doc_id", "p.*")
    bucket = F.length(F.bin("length")) - 1
    return rows.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "bucket": bucket})


def batches(found: DataFrame, tokens: int = BATCH_TOKENS) -> DataFrame:
    """sequence_id, bucket, batch, slot: each bucket's sequences dealt to batches of ``tokens`` tokens.

    ``found`` has sequence_id, length and bucket. Sequences are numbered within (part, bucket),
    and the totals of the parts shift the numbers, so that a bucket with most of the sequences is
    not one task's work. Batches of a bucket are full but for its last."""
    part = F.shiftright("sequence_id", 33)  # the task that read the document
    rows = cut_lineage(found.select("sequence_id", "bucket", "length", part.alias("part")))
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("bucket", "part").agg(F.count("*").alias("n"))  # at most one row per task and bucket
    totals = totals.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = F.row_number().over(Window.partitionBy("bucket", "part").orderBy("sequence_id")) - 1
    number = F.col("own") + F.col("shift")
    per = F.greatest(F.lit(1), F.expr(f"{int(tokens)} div length"))
    out = rows.withColumn("own", own).join(totals, ["bucket", "part"])
    return out.select("sequence_id", "bucket", F.floor(number / per).alias("batch"), F.pmod(number, per).alias("slot"))


def write(docs: DataFrame, folder: str, path: str | None = None, length: int = LENGTH, end: int = END) -> None:
    """The sequences with their ids as Parquet, a folder per bucket."""
    sequences(docs, path, length, end).write.partitionBy("bucket").parquet(folder)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sequences(docs, with_ids=False)

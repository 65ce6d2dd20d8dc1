"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed 1- to 3-grams of letters per language in the executors and sums them
in Spark; the matrix of log-probabilities (2**bits rows, one column per language) is
broadcast, and every text is scored whole, in batches, by sparse sums in numpy.

Parameters that bound the fit: at most about ``max_rows`` labelled rows, shared among the languages
and chosen by a hash of id and text, and at most ``MAX_LANGUAGES`` languages (an error beyond that). So the broadcast is
at most 2**bits * MAX_LANGUAGES numbers.

Defined cases: a text that is NULL or has no letters gives ``und`` with score 0; rows without
a language or text teach nothing; rows with a NULL id are scored but teach nothing; repeated
rows are each scored; without any labelled row every text is ``und``; ties go to the language
that sorts first; columns named as those added are replaced.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import cut_lineage, read, sampled, small_batches, use_package

BITS = 15
MAX_ROWS = 50_000
MAX_LANGUAGES = 256
UNKNOWN = "und"
#: Characters of a text that are turned into features at once.
CHUNK = 1 << 20
#: Features scored at once.
BATCH = 1 << 20


class Model(NamedTuple):
    languages: list[str]
    log_prior: np.ndarray  # (languages,)
    log_prob: np.ndarray  # (languages, 2**bits)
    bits: int


@functools.cache
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a blank."""
    out = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if unicodedata.category(c)[0] == "L":
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def features(text: str, bits: int = BITS) -> Iterator[np.ndarray]:
    """The hashed n-grams of a text, one number per occurrence; nothing without letters.

    Runs of other characters count as one blank, with one before and after the text."""
    last = np.array([32], np.uint32)
    for at in range(0, len(text), CHUNK):
        points = np.frombuffer(text[at : at + CHUNK].encode("utf-32-le", "replace"), np.uint32)
        end = np.array([32] if at + CHUNK >= len(text) else [], np.uint32)
        x = np.concatenate([last, _letters()[points], end])
        x = x[np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])]
        seen = len(last)  # the last two of the chunk before, whose own n-grams are out
        if len(x) > seen:
            one = x * np.uint32(0x9E3779B1)
            two = (one[:-1] ^ (x[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
            three = (two[:-1] ^ (x[2:] + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35)
            yield np.concatenate([one[seen:], two[seen - 1 :], three[max(seen - 2, 0) :]]) >> np.uint32(32 - bits)
        last = x[-2:]


def _count(batches, bits: int):
    """Per task: the number of each feature and, as feature -1, of rows of each language."""
    totals: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1)):
            name = lang.as_py()
            if name not in totals:
                if len(totals) >= MAX_LANGUAGES:
                    raise ValueError(f"more than {MAX_LANGUAGES} languages")
                totals[name], rows[name] = np.zeros(1 << bits, np.int64), 0
            rows[name] += 1
            for x in features(text.as_py(), bits):
                totals[name] += np.bincount(x, minlength=1 << bits)
    for name, n in totals.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * (len(at) + 1)), pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(n[at], rows[name]), pa.int64())],
            names=["lang", "feature", "n"])


def fit(labelled: DataFrame, bits: int = BITS, max_rows: int = MAX_ROWS, alpha: float = 0.5) -> Model:
    """Train on the rows (doc_id, text, lang) whose three columns are all set."""
    use_package(labelled.sparkSession)
    small_batches(labelled.sparkSession)
    rows = labelled.select("doc_id", "text", "lang").dropna()
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names, n = sorted(sizes), sum(sizes.values())
    if n > max_rows:
        # languages share the bound, so that a rare one is learned too; what one leaves over, others take
        quota, rest = {}, max_rows
        for k, name in enumerate(sorted(names, key=sizes.get)):
            quota[name] = min(sizes[name], rest / (len(names) - k))
            rest -= quota[name]
        share = F.create_map(*[F.lit(x) for name in names for x in (name, quota[name] / sizes[name])])
        rows = rows.filter(sampled(F.element_at(share, F.col("lang")), "doc_id", "text"))
    counts = rows.select("text", "lang").mapInArrow(lambda b: _count(b, bits), "lang string, feature int, n long")
    counts = cut_lineage(counts.groupBy("lang", "feature").agg(F.sum("n").alias("n")))
    matrix, prior = np.zeros((len(names), 1 << bits)), np.zeros(len(names))
    # at most languages * (2**bits + 1) rows
    for lang, feature, k in counts.filter("feature >= 0").select("lang", "feature", "n").toPandas().itertuples(index=False):
        matrix[names.index(lang), feature] = k
    prior[:] = [sizes[name] for name in names]
    matrix += alpha
    return Model(names, np.log(np.maximum(prior, 1) / max(prior.sum(), 1)), np.log(matrix / matrix.sum(axis=1, keepdims=True)), bits)


def _score(model: Model, texts: list) -> tuple[list[str], list[float]]:
    """Languages and posterior probabilities of a batch of texts."""
    sums = np.zeros((len(texts), len(model.languages)))
    seen = np.zeros(len(texts), bool)
    parts, owner, size = [], [], 0

    def flush():
        if not parts:
            return
        x, starts = np.concatenate(parts), np.cumsum([0, *map(len, parts)])[:-1]
        for k, column in enumerate(model.log_prob):
            np.add.at(sums[:, k], owner, np.add.reduceat(column[x], starts))
        parts.clear()
        owner.clear()

    for i, text in enumerate(texts):
        for x in features(text, model.bits) if text and model.languages else ():
            seen[i] = True
            parts.append(x)
            owner.append(i)
            size += len(x)
            if size > BATCH:
                flush()
                size = 0
    flush()
    if not model.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    sums += model.log_prior
    best = sums.argmax(axis=1)
    score = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    return [model.languages[b] if s else UNKNOWN for b, s in zip(best, seen)], np.where(seen, score, 0.0).tolist()


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with ``lang_pred`` and ``score`` (the posterior probability of that language)."""
    use_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            langs, scores = [], []
            for at in range(0, len(batch), 64):
                a, b = _score(shared.value, batch.slice(at, 64).to_pylist())
                langs += a
                scores += b
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    out = docs.withColumn("__p", predict(F.col(text)))
    return out.withColumns({"lang_pred": F.col("__p.lang"), "score": F.col("__p.score")}).drop("__p")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, min_score: float = 0.5) -> DataFrame:
    """Pipeline stage: documents without letters, or without a likely language, go."""
    model = fit(docs.filter(~held_out()))
    kept = identify(docs, model).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

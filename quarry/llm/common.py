"""Helpers shared by the training-data operators.

Words are maximal runs of characters outside ``\\x20`` and ``\\x09-\\x0D`` everywhere.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import cut_lineage, table

__all__ = ["WORD", "GAP", "BLANK", "cut_lineage", "let", "read", "sampled", "size_of_groups", "small_batches", "use_package", "words"]

#: A word, a gap between words, and the characters of a gap.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
BLANK = " \t\n\x0b\x0c\r"

BATCH_BYTES = "8m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def use_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it, whatever folder
    the driver was started in. Executors on other machines need it installed or sent along
    (``--py-files``), as any package."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python workers in batches of at most ``BATCH_BYTES``, unless the session says how
    large they may be. A batch is held several times over: by Spark, by the worker, and as objects."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once however often body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text as an array; empty for NULL and for a text without words."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK))
    return let(inner, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, GAP)))


def size_of_groups(rows: int, per_group: int) -> int:
    """How many groups hold about ``per_group`` rows each."""
    return max(1, -(-rows // per_group))


def sampled(share: Column | float, *columns: str) -> Column:
    """True for about ``share`` of all distinct values of the columns, the same ones every time:
    62 bits of their hash are compared with the share, so that no share is too small to be one."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns), 2)
    share = F.lit(float(share)) if isinstance(share, (int, float)) else share
    return bits < F.greatest(F.least(share, F.lit(1.0)) * F.lit(float(1 << 62)), F.lit(1.0)).cast("long")

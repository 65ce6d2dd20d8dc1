"""Keep-best / latest / first per key, last-non-null snapshots, duplicate counts
(W1-W4, W6, W7).

Keep-one-row-per-key uses ``row_number() = 1``: Spark plans a partial
WindowGroupLimit before the shuffle, so each map task forwards only its best row
per key and a hot key does not drag all its rows through the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators.agg import last_non_null


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def keep_first(df: DataFrame, keys, order: Sequence[Column]) -> DataFrame:
    """Generic: one row per key, the first by ``order`` (W1-W4 building block).
    NULL keys form their own group (pandas drop_duplicates semantics)."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedupe_longest(df: DataFrame, keys, begin: str, end: str, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Per (id, year) keep the longest [begin, end] span, then the latest begin;
    a NULL span or begin loses. ``tiebreak`` makes the choice total (T3)."""
    span = F.datediff(F.col(end).cast("date"), F.col(begin).cast("date"))
    order = [span.desc_nulls_last(), F.col(begin).cast("date").desc_nulls_last(), *tiebreak]
    return keep_first(df, keys, order)


def latest_per_key(df: DataFrame, keys, date: str, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Newest row per key (NULL dates last), deterministic tie-break."""
    return keep_first(df, keys, [F.col(date).desc_nulls_last(), *tiebreak])


def first_per_key(df: DataFrame, keys, order: Sequence[Column]) -> DataFrame:
    """First row per key in a canonical order."""
    return keep_first(df, keys, order)


def last_non_null_snapshot(df: DataFrame, keys, cols: Sequence[str], date: str,
                           tiebreak: Sequence[str] = ()) -> DataFrame:
    """Per key and per column, the last non-NULL value by date (pandas
    ``groupby().last()``): the snapshot can mix rows (T4). One hash aggregate with
    a ``max_by`` per column — no sort, partial aggregation on each task."""
    return df.groupBy(*_keys(keys)).agg(
        *[last_non_null(c, date, *tiebreak).alias(c) for c in cols])


def duplicate_count(df: DataFrame, keys) -> DataFrame:
    """Rows beyond the first per key (NULL keys compare equal). One-row frame."""
    per_key = df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("dups"))

"""Percentile rank with average ties (W5): pandas ``rank(pct=True) * 100``.

pctl(v) = (rows below v + (rows equal to v + 1) / 2) / non-NULL rows * 100.

Plan shape: a histogram of distinct values (hash aggregate with map-side combine),
cut into ranges by value once (checkpointed, so that both readers of the ranges agree
on them); each range partition computes its own running count
and a tiny table of partition totals (one row per partition — bounded by the
partition count, so it is safe to broadcast) supplies the offset. No window ever
runs over all rows in one task. The histogram is joined back on the value; a hot
value is one histogram row, and AQE splits the skewed side of that join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions.coerce import nan_to_null
from quarry.operators.ordering import ranged
from quarry.operators.quantiles import ranked_counts


def value_percentiles(df: DataFrame, col: str, partitions: int | None = None) -> DataFrame:
    """Histogram of ``col`` with the average-tie percentile per distinct value:
    (value, n_equal, pctl)."""
    v = nan_to_null(col) if dict(df.dtypes)[col] in ("double", "float") else F.col(col)
    hist = (df.select(v.alias("_v")).where(F.col("_v").isNotNull())
            .groupBy("_v").agg(F.count(F.lit(1)).alias("_n")))
    hist = ranged(hist, [F.col("_v")], partitions)
    local = hist.withColumn("_cum", F.sum("_n").over(
        Window.partitionBy("_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    totals = hist.groupBy("_pid").agg(F.sum("_n").alias("_pn"))
    offsets = totals.select(
        "_pid",
        F.coalesce(F.sum("_pn").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_pn").over(Window.partitionBy(F.lit(1))).alias("_total"))
    ranked = local.join(F.broadcast(offsets), "_pid")
    below = F.col("_off") + F.col("_cum") - F.col("_n")
    pct = (below + (F.col("_n") + 1) / 2.0) / F.col("_total") * 100.0
    return ranked.select(F.col("_v").alias(col), F.col("_n").alias("n_equal"), pct.alias("pctl"))


def pct_rank_avg(df: DataFrame, col: str, out: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add ``out`` (default ``<col>_PCTL``) to every row; NULL/NaN values get NULL."""
    out = out or f"{col}_PCTL"
    pc = value_percentiles(df, col, partitions).select(F.col(col).alias("_pv"), F.col("pctl").alias(out))
    return df.join(pc, df[col] == pc["_pv"], "left").drop("_pv")


def pct_rank_columns(df: DataFrame, key: str, cols: Sequence[str], suffix: str = "_PCTL") -> DataFrame:
    """W5 for several measures of a frame with one row per ``key``: the measures are unpivoted
    once, ranked in one histogram keyed by (measure, value), and joined back by one join."""
    pairs = F.array(*[F.struct(F.lit(c).alias("m"), nan_to_null(c).alias("v")) for c in cols])
    long = df.select(key, F.explode(pairs).alias("_x")).select(key, F.struct("_x.m").alias("_g"), F.col("_x.v").alias("_v"))
    ranks = ranked_counts(long.select("_g", "_v"))
    pct = (F.col("_lo") + (F.col("_hi") - F.col("_lo") + 1) / 2.0) / F.col("_total") * 100.0
    ranks = ranks.select(F.col("_g").alias("_rg"), F.col("_v").alias("_rv"), pct.alias("_pct"))
    found = long.join(ranks, (F.col("_g") == F.col("_rg")) & (F.col("_v") == F.col("_rv")))
    found = found.groupBy(F.col(key).alias("_key")).agg(*[F.max(F.when(F.col("_g.m") == c, F.col("_pct"))).alias(f"{c}{suffix}") for c in cols])
    return df.join(found, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")

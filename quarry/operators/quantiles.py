"""Exact quantiles of groups without gathering a group in one task.

Equal values of a group are counted first (hash aggregate with map-side combine). The
counts are cut into ranges by (group, value); running counts within a range and offsets
from the range totals of the group give every value its ranks, and the values at the two
ranks around a quantile are interpolated. A group may spread over any number of ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions.coerce import nan_to_null
from quarry.operators.ordering import BEFORE, THROUGH, ranged


def ranked_counts(long: DataFrame) -> DataFrame:
    """long (_g, _v) -> one row per group and value: how many of the group are below it
    (``_lo``), through it (``_hi``) and in all (``_total``). NULL values are left out."""
    counted = long.where(F.col("_v").isNotNull()).groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_n"))
    counted = ranged(counted, [F.col("_g"), F.col("_v")])
    run = Window.partitionBy("_pid", "_g").orderBy("_v").rowsBetween(*THROUGH)
    counted = counted.withColumn("_cum", F.sum("_n").over(run))
    # one row per group and range it lies in
    totals = counted.groupBy("_g", "_pid").agg(F.sum("_n").alias("_pn"))
    totals = totals.select(F.col("_g").alias("_tg"), F.col("_pid").alias("_tp"),
                           F.coalesce(F.sum("_pn").over(Window.partitionBy("_g").orderBy("_pid").rowsBetween(*BEFORE)), F.lit(0)).alias("_off"),
                           F.sum("_pn").over(Window.partitionBy("_g")).alias("_total"))
    ranks = counted.join(totals, (F.col("_pid") == F.col("_tp")) & (F.col("_g") == F.col("_tg")))
    through = F.col("_off") + F.col("_cum")
    return ranks.select("_g", "_v", (through - F.col("_n")).alias("_lo"), through.alias("_hi"), "_total")


def group_quantiles(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column | str],
                    probabilities: Sequence[float]) -> DataFrame:
    """(keys, measure, p, value): the interpolated quantiles (pandas / numpy default) of each
    measure in each group. Groups with a NULL key count; a measure without values has no row."""
    values = [F.struct(F.lit(m).alias("measure"), nan_to_null(c).alias("value")) for m, c in measures.items()]
    long = df.select(*keys, F.explode(F.array(*values)).alias("_x")).select(F.struct(*keys, "_x.measure").alias("_g"), F.col("_x.value").alias("_v"))
    at = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    asked = ranked_counts(long).withColumn("p", at).withColumn("_at", F.col("p") * (F.col("_total") - 1))
    inside = lambda r: F.when((F.col("_lo") <= r) & (r < F.col("_hi")), F.col("_v"))
    asked = asked.withColumns({"_a": inside(F.floor("_at")), "_b": inside(F.ceil("_at"))}).where("_a IS NOT NULL OR _b IS NOT NULL")
    out = asked.groupBy("_g", "p").agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"), F.max(F.col("_at") - F.floor("_at")).alias("_w"))
    return out.select(*[F.col("_g")[k].alias(k) for k in keys], F.col("_g")["measure"].alias("measure"), "p",
                      (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_w")).alias("value"))


def group_medians(df: DataFrame, keys: Sequence[str] | str, measures: Mapping[str, Column | str]) -> DataFrame:
    """One row per group that has a value, one median per measure (NULL without values)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    found = group_quantiles(df, keys, measures, [0.5])
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("measure") == m, F.col("value"))).alias(m) for m in measures])


def with_medians(groups: DataFrame, df: DataFrame, keys: Sequence[str] | str, measures: Mapping[str, Column | str]) -> DataFrame:
    """``groups`` (one row per group of ``df``) with the medians of its measures."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    med = group_medians(df, keys, measures).withColumnsRenamed({k: f"_m_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & groups[k].eqNullSafe(med[f"_m_{k}"])
    return groups.join(med, on, "left").drop(*[f"_m_{k}" for k in keys])

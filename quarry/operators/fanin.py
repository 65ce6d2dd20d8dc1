"""Attributes of many columns brought to one row per key (J9) by one two-level aggregate:
modes, first and last values, and the group's size (A2-A4, A11)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fan_in(df: DataFrame, key: str, modes: Mapping[str, Column | str] = {}, firsts: Mapping[str, Column | str] = {},
           lasts: Mapping[str, Column | str] = {}, first_order: Column | None = None,
           last_order: Column | None = None, size: str | None = None) -> DataFrame:
    """One row per key (NULL is a key too) with, for each output name, the most common value of a
    column (ties: the smallest), its first by ``first_order`` or its last by ``last_order``, each
    among the rows where it is not NULL; ``size``: the number of rows.

    Rows are unpivoted to (key, column, value) and counted; the count, the earliest and the latest
    row of each value are all that the second level needs. So however many columns there are,
    ``df`` is read once and shuffled twice, and a hot key is spread over its columns and values in
    the first shuffle and down to one row per value and task in the second."""
    wanted = [("mode", o, c) for o, c in modes.items()] + [("first", o, c) for o, c in firsts.items()] + [("last", o, c) for o, c in lasts.items()]
    if (firsts and first_order is None) or (lasts and last_order is None):
        raise ValueError("first and last values need an order")
    values = [F.col(c) if isinstance(c, str) else c for _, _, c in wanted]
    kinds = [f.dataType for f in df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).schema]
    nothing = F.lit(None).cast("int")
    cells = [F.struct(F.lit(i).alias("c"), v.cast("string").alias("v")) for i, v in enumerate(values)]
    cells.append(F.struct(F.lit(-1).alias("c"), F.lit("").alias("v")))  # a row for every row
    long = df.select(F.col(key).alias("_k"), (nothing if first_order is None else first_order).alias("_lo"),
                     (nothing if last_order is None else last_order).alias("_hi"), F.explode(F.array(*cells)).alias("x"))
    counts = (long.where("x.v IS NOT NULL").groupBy("_k", F.col("x.c").alias("c"), F.col("x.v").alias("v"))
              .agg(F.count(F.lit(1)).alias("n"), F.min("_lo").alias("lo"), F.max("_hi").alias("hi")))
    picks = [F.sum(F.when(F.col("c") == -1, F.col("n"))).alias(size)] if size else []
    for i, ((how, out, _), kind) in enumerate(zip(wanted, kinds)):
        mine, value = F.col("c") == i, F.col("v").cast(kind)
        order = {"mode": F.struct(-F.col("n"), value), "first": F.col("lo"), "last": F.col("hi")}[how]
        best = F.max_by if how == "last" else F.min_by
        picks.append(best(F.col("v"), F.when(mine, order)).cast(kind).alias(out))
    return counts.groupBy(F.col("_k").alias(key)).agg(*picks) if picks else counts.select(F.col("_k").alias(key)).distinct()

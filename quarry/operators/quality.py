"""Data-quality summaries (A17-A20) and the row-count manifest (K3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.quantiles import group_quantiles


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def panel_summary(df: DataFrame, id_col: str, year_col: str, flag: Column | None = None) -> DataFrame:
    """One row — rows, distinct ids, min/max year, NULL ids, flagged rows and
    flagged distinct ids, in a single aggregate."""
    aggs = [
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(_c(id_col)).alias("distinct_ids"),
        F.min(_c(year_col)).alias("min_year"),
        F.max(_c(year_col)).alias("max_year"),
        F.count_if(_c(id_col).isNull()).alias("null_ids"),
    ]
    if flag is not None:
        f = F.coalesce(flag, F.lit(False))
        aggs += [F.count_if(f).alias("flagged_rows"),
                 F.countDistinct(F.when(f, _c(id_col))).alias("flagged_ids")]
    return df.agg(*aggs)


def missingness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column, NULL count and share of rows. One aggregate, then unpivot."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    stack = wide.select("_rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing"))
        for i, c in enumerate(cols)])).alias("_s"))
    return stack.select(
        F.col("_s.column").alias("column"), F.col("_s.missing").cast("long").alias("missing"),
        F.when(F.col("_rows") > 0, F.col("_s.missing") / F.col("_rows")).otherwise(F.lit(0.0)).alias("share"))


def diff_buckets(diff: Column, df: DataFrame, near: int = 180) -> DataFrame:
    """Counts of a day difference: exactly 0, 1..near (absolute), > near, and
    their shares of the non-NULL differences."""
    d = F.abs(diff)
    agg = df.agg(F.count_if(d == 0).alias("exact0"),
                 F.count_if(d.between(1, near)).alias(f"within{near}"),
                 F.count_if(d > near).alias(f"beyond{near}"),
                 F.count(d).alias("non_null"))
    return agg.withColumns({
        f"pct_{c}": F.when(F.col("non_null") > 0, F.col(c) / F.col("non_null") * 100)
        for c in ("exact0", f"within{near}", f"beyond{near}")})


def box_stats(df: DataFrame, col: str) -> DataFrame:
    """Quartiles (interpolated), IQR, whiskers (most extreme values inside
    1.5*IQR) and outlier count. Quartiles come from ranked value counts, so no task
    holds the whole column."""
    found = group_quantiles(df, [], {col: col}, [0.25, 0.5, 0.75])
    q = found.agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    n = df.agg(F.count(F.col(col)).alias("n"))
    q = q.select(n.select("n").scalar().alias("n"), "q1", "median", "q3")
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    # the quartiles are one row: pass them as a scalar subquery (no join)
    bounds = q.select(F.struct("*").alias("b")).scalar()
    lo = bounds["q1"] - 1.5 * bounds["iqr"]
    hi = bounds["q3"] + 1.5 * bounds["iqr"]
    x = F.col(col)
    w = df.agg(
        F.min(F.when(x >= lo, x)).alias("whisker_low"),
        F.max(F.when(x <= hi, x)).alias("whisker_high"),
        F.count_if((x < lo) | (x > hi)).alias("outliers"))
    return w.select(bounds["n"].alias("n"), bounds["q1"].alias("q1"), bounds["median"].alias("median"),
                    bounds["q3"].alias("q3"), bounds["iqr"].alias("iqr"), "whisker_low", "whisker_high", "outliers")


def manifest(frames: Mapping[str, DataFrame], snapshot: str | None = None) -> DataFrame:
    """K3: (table, rows[, snapshot]) — one global count per table, unioned lazily."""
    out = None
    for name, df in frames.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = row if out is None else out.unionByName(row)
    if snapshot is not None:
        out = out.withColumn("snapshot", F.lit(snapshot))
    return out

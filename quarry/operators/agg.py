"""Grouped aggregates, pivots, sorting and top-k.

Every aggregate here is a hash aggregate with a partial (map-side) phase, so a hot
group is pre-reduced in each task before the shuffle. Medians are in quantiles.py.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions.coerce import nan_to_null
from quarry.session import cut_lineage


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def group_mean(df: DataFrame, keys, cols: Sequence[str], drop_null_keys: bool = True) -> DataFrame:
    """A1: per-group mean of each column, NULL/NaN skipped; NULL-key groups dropped
    (pandas groupby default)."""
    keys = _keys(keys)
    if drop_null_keys:
        df = df.dropna(subset=keys)
    return df.groupBy(*keys).agg(*[F.avg(nan_to_null(c)).alias(c) for c in cols])


def group_mode(df: DataFrame, keys, col: str, out: str | None = None) -> DataFrame:
    """A2: most common non-NULL value per group; ties -> smallest value.

    Two hash aggregates instead of a per-group value map: counts per (group, value)
    first (a hot group is spread over its values), then ``min_by`` on
    (-count, value)."""
    keys = _keys(keys)
    counts = (df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n")))
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(col), F.struct(-F.col("_n"), F.col(col))).alias(out or col))


def first_non_null(c, order: Column) -> Column:
    """A3: value of ``c`` on the earliest row (by ``order``) where it is not NULL."""
    return F.min_by(_c(c), F.when(_c(c).isNotNull(), order))


def last_non_null(c, date, *tiebreak) -> Column:
    """A4: value of ``c`` on the latest row where it is not NULL. Undated rows count
    as newest (pandas sorts NaT last); ``tiebreak`` columns order equal dates."""
    d = _c(date)
    order = F.struct(d.isNull(), d, *[_c(t) for t in tiebreak])
    return F.max_by(_c(c), F.when(_c(c).isNotNull(), order))


def year_span(c, prefix: str = "") -> list[Column]:
    """A5: count / min / max of a year column."""
    return [F.count(_c(c)).alias(f"{prefix}count"), F.min(_c(c)).alias(f"{prefix}min"),
            F.max(_c(c)).alias(f"{prefix}max")]


def count_where(cond: Column) -> Column:
    """Rows where the condition is true (NULL counts as false)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def sum_or_zero(c) -> Column:
    """Sum that is 0 (not NULL) for an empty / all-NULL group."""
    return F.coalesce(F.sum(nan_to_null(c)), F.lit(0.0))


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """A10: counts per value, largest first (ties by value)."""
    if dropna:
        df = df.where(F.col(col).isNotNull())
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(col))


def group_size(df: DataFrame, keys) -> DataFrame:
    """Rows per group; groups with a NULL key are dropped."""
    keys = _keys(keys)
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def any_flag(c) -> Column:
    """1 when the group mean of a 0/1 flag is > 0, else 0 (NULL -> 0)."""
    return F.coalesce((F.avg(_c(c)) > 0).cast("int"), F.lit(0))


def pivot_wide(long: DataFrame, index, column: str, value: str, values: Sequence,
               agg: str = "first") -> DataFrame:
    """Long -> wide with explicit pivot values (no extra distinct job).
    With ``first`` the input must hold one row per cell: a second one is an error."""
    index = _keys(index)
    fn = {"first": F.first, "max": F.max, "sum": F.sum, "count": F.count}[agg]
    cell = fn(F.col(value))
    if agg == "first":
        error = F.raise_error(F.lit(f"duplicate cell: more than one {value} for ({', '.join(index)}, {column})"))
        cell = F.when(F.count(F.lit(1)) > 1, error.cast(long.schema[value].dataType)).otherwise(cell)
    return long.groupBy(*index).pivot(column, list(values)).agg(cell)


def assert_unique_cells(long: DataFrame, index, column: str) -> DataFrame:
    """A14 guard: rows whose (index, column) cell is not unique (empty when valid)."""
    keys = _keys(index) + [column]
    return long.groupBy(*keys).count().where(F.col("count") > 1)


def pivot_counts(df: DataFrame, index, column: str, values: Sequence) -> DataFrame:
    """Counts per (index, column value), missing cells 0."""
    index = _keys(index)
    wide = df.dropna(subset=index + [column]).groupBy(*index).pivot(column, list(values)).count()
    return wide.fillna(0, subset=[str(v) for v in values])


def sort_mixed(df: DataFrame, spec: Sequence[tuple[str, bool]]) -> DataFrame:
    """L1: multi-key sort; (column, ascending); NULLs last in both directions."""
    return df.orderBy(*[F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last()
                        for c, asc in spec])


def top_bottom(agg: DataFrame, key: str, value: str, n: int = 15, divider: str = "---") -> DataFrame:
    """Top-n and bottom-n rows of a per-group aggregate with a divider row.
    NULL values are dropped first; with fewer than 2n groups both halves overlap.
    Output: section, pos, key, value. Each half is a bounded TakeOrderedAndProject;
    the positions are numbered over at most n rows each."""
    # both halves read the groups: compute them once
    ranked = cut_lineage(agg.where(F.col(value).isNotNull()).select(key, value))
    key_type = agg.schema[key].dataType
    div_key = F.lit(divider) if key_type.simpleString() == "string" else F.lit(None)
    top = ranked.orderBy(F.desc(value), F.desc(key)).limit(n).withColumn("section", F.lit("top"))
    bottom = ranked.orderBy(F.asc(value), F.asc(key)).limit(n).withColumn("section", F.lit("bottom"))
    top = top.withColumn("pos", F.row_number().over(
        Window.partitionBy("section").orderBy(F.desc(value), F.desc(key))))
    bottom = bottom.withColumn("pos", F.row_number().over(
        Window.partitionBy("section").orderBy(F.asc(value), F.asc(key))) + F.lit(n + 1))
    div = agg.sparkSession.range(1).select(
        F.lit("divider").alias("section"), F.lit(n + 1).alias("pos"),
        div_key.cast(key_type).alias(key), F.lit(None).cast(agg.schema[value].dataType).alias(value))
    cols = ["section", "pos", key, value]
    return top.select(cols).unionByName(div.select(cols)).unionByName(bottom.select(cols))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """L3: the first n rows by ``order`` (bounded; plans as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def latest_value(df: DataFrame, col: str) -> DataFrame:
    """One-row frame with max(col)."""
    return df.agg(F.max(col).alias(f"max_{col}"))


def latest_partition(df: DataFrame, col: str, source: DataFrame | None = None) -> DataFrame:
    """Rows whose ``col`` equals the column maximum. The maximum is a one-row
    aggregate (a proven size bound), broadcast to the scan. When ``df`` is a join whose
    ``col`` comes from one table and no join drops that table's last value, pass that table
    as ``source``: the maximum then needs no second run of the join."""
    mx = F.broadcast((df if source is None else source).agg(F.max(col).alias("_latest")))
    return df.join(mx, F.col(col) == F.col("_latest"), "inner").drop("_latest")

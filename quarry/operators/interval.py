"""Interval-overlap existence join.

flag = 1 when the left row's key has at least one period that overlaps the left
[begin, end] window, under these rules (closed bounds):
  * left begin or end NULL  -> overlap (cannot rule it out)
  * period start NULL       -> overlap (checked before the termination test)
  * term < begin            -> no overlap
  * start > end             -> no overlap
  * otherwise               -> overlap
Keys without periods get 0.

Plan shape (exact, no per-key arrays, no pair explosion). An open end is the last day there is, a
NULL start the first with an open end, and a window without a bound reaches from the first day to
the last; then a window is hit if the latest end among the periods that start by its end is not
before its begin:
  * the starts of periods and the ends of windows are events of one union, reduced on the map side
    to one row per (key, day): a hot key has as many rows as there are days;
  * a running maximum over the days of a key gives the latest end so far;
  * the left rows look their day up, an equality on (key, day) in which a hot key is spread by its
    days, and windows without a bound, which all end on one day, by a salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def overlaps(begin: Column, end: Column, start: Column, term: Column) -> Column:
    """F32 as a row predicate (for one window and one period)."""
    return (begin.isNull() | end.isNull() | start.isNull()
            | (~(term.isNotNull() & (term < begin)) & ~(start > end)))


#: The first and the last day there are, and the parts that the last is dealt to.
FIRST, LAST, SALT = "0001-01-01", "9999-12-31", 32


def interval_overlap_flag(left: DataFrame, key: str, begin: str, end: str,
                          periods: DataFrame, p_key: str, start: str, term: str,
                          out: str = "flag") -> DataFrame:
    """Add a 0/1 column ``out`` to ``left`` (row count preserved)."""
    first, last = F.lit(FIRST).cast("date"), F.lit(LAST).cast("date")
    b, e = F.col(begin).cast("date"), F.col(end).cast("date")
    unbounded = b.isNull() | e.isNull()
    day = F.when(unbounded, last).otherwise(e)
    hashed = [f"`{c}`" for c, kind in left.dtypes if "map<" not in kind]
    rows = left.withColumns({"_k": F.col(key), "_b": F.when(unbounded, first).otherwise(b), "_d": day,
                             "_salt": F.when(day == last, F.pmod(F.xxhash64(*hashed), F.lit(SALT))).otherwise(F.lit(0).cast("long"))})
    s, t = F.col(start).cast("date"), F.col(term).cast("date")
    starts = periods.select(F.col(p_key).alias("_k"), F.coalesce(s, first).alias("_d"),
                            F.when(s.isNull() | t.isNull(), last).otherwise(t).alias("_t"))
    ends = left.select(F.col(key).alias("_k"), day.alias("_d"), F.lit(None).cast("date").alias("_t"))
    days = starts.unionByName(ends).where(F.col("_k").isNotNull()).groupBy("_k", "_d").agg(F.max("_t").alias("_t"))
    so_far = Window.partitionBy("_k").orderBy("_d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    salts = F.when(F.col("_d") == last, F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    days = (days.select("_k", "_d", F.max("_t").over(so_far).alias("_until")).where(F.col("_until").isNotNull())
            .withColumn("_salt", F.explode(salts)))
    found = rows.join(days, ["_k", "_d", "_salt"], "left")
    flag = F.coalesce(F.col("_until") >= F.col("_b"), F.lit(False)).cast("int")
    return found.select(*[rows[c] for c in left.columns], flag.alias(out))

"""Joins and unions: null-safe full outer merge with provenance, normalised-key
lookups, latest-value replacement, fill-from-right, key coverage, fallbacks
(J1-J4, J10-J12, U1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.finance import provenance
from quarry.operators.dedupe import keep_first, latest_per_key


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def nullsafe_full_outer(left: DataFrame, right: DataFrame, keys, prefer_left: Sequence[str] = (),
                        labels: tuple[str, str, str] = ("both", "left only", "right only"),
                        label_col: str = "source") -> DataFrame:
    """Full outer merge where NULL keys match each other (pandas merge, T2);
    many-to-many fan-out is kept. Adds 0/1 presence flags ``in_left``/``in_right``
    and a provenance label. Columns in ``prefer_left`` that exist on both sides
    become coalesce(left, right). Plans as a sort-merge join on the coalesced key,
    never a nested loop."""
    keys = _keys(keys)
    l = left.withColumn("_in_l", F.lit(1))
    r = right.withColumn("_in_r", F.lit(1))
    la, ra = l.alias("l"), r.alias("r")
    cond = None
    for k in keys:
        c = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        cond = c if cond is None else cond & c
    j = la.join(ra, cond, "full")
    lcols = [c for c in left.columns if c not in keys]
    rcols = [c for c in right.columns if c not in keys]
    both = set(lcols) & set(rcols)
    out = [F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys]
    for c in lcols:
        if c in both and c in prefer_left:
            out.append(F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}")).alias(c))
        else:
            out.append(F.col(f"l.{c}").alias(c if c not in both else f"{c}_left"))
    for c in rcols:
        if c in both and c in prefer_left:
            continue
        out.append(F.col(f"r.{c}").alias(c if c not in both else f"{c}_right"))
    in_l = F.coalesce(F.col("l._in_l"), F.lit(0)).alias("in_left")
    in_r = F.coalesce(F.col("r._in_r"), F.lit(0)).alias("in_right")
    res = j.select(*out, in_l, in_r)
    return res.withColumn(label_col, provenance("in_left", "in_right", *labels))


def fold_key(c) -> Column:
    """Case-insensitive trimmed join key."""
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def lookup_left(left: DataFrame, right: DataFrame, exact: Sequence[tuple[str, str]] = (),
                folded: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Left join on exact keys plus case-insensitive trimmed keys (may fan out
    when the right side repeats a key, T8). Pairs are (left column, right column);
    right key columns are dropped from the output."""
    cond = F.lit(True)
    for lc, rc in exact:
        cond = cond & left[lc].eqNullSafe(right[rc])
    for lc, rc in folded:
        cond = cond & (fold_key(left[lc]) == fold_key(right[rc]))
    j = left.join(right, cond, "left")
    drop = [right[rc] for _, rc in list(exact) + list(folded)]
    for d in drop:
        j = j.drop(d)
    return j


def replace_from_latest(df: DataFrame, lookup: DataFrame, key: str, value: str,
                        date: str | None = None, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Take the newest ``value`` per key from ``lookup`` (the first by ``tiebreak`` when
    there is no date column, which then must be given) and replace ``value`` in ``df`` with it (left join; missing ->
    NULL). The lookup is reduced to one row per key before the join, so the join
    never fans out."""
    if date is not None and date in lookup.columns:
        lk = latest_per_key(lookup, key, date, tiebreak)
    else:
        if not tiebreak:
            raise ValueError("a lookup without a date column needs tiebreak columns that order its rows")
        lk = keep_first(lookup, key, list(tiebreak))
    lk = lk.select(F.col(key), F.col(value).alias("_new_value"))
    base = df.drop(value) if value in df.columns else df
    return base.join(lk, key, "left").withColumnRenamed("_new_value", value)


def fill_from_right(left: DataFrame, right: DataFrame, on: Sequence[tuple[Column, Column]],
                    fill: Sequence[str], suffix: str = "_r") -> DataFrame:
    """Left join on computed keys (e.g. normalised name + state); for each
    column in ``fill`` the right value fills the left's NULLs (``combine_first``).
    NULL keys match NULL keys (T2)."""
    lk = left.withColumns({f"_lk{i}": lc for i, (lc, _) in enumerate(on)})
    rsel = {f"_rk{i}": rc for i, (_, rc) in enumerate(on)}
    rk = right.withColumns(rsel).select(*rsel.keys(), *[F.col(c).alias(c + suffix) for c in fill])
    cond = None
    for i in range(len(on)):
        c = F.col(f"_lk{i}").eqNullSafe(F.col(f"_rk{i}"))
        cond = c if cond is None else cond & c
    j = lk.join(rk, cond, "left")
    j = j.withColumns({c: F.coalesce(F.col(c), F.col(c + suffix)) for c in fill})
    return j.drop(*[f"_lk{i}" for i in range(len(on))], *rsel.keys(), *[c + suffix for c in fill])


def backfill_left(left: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Plain metadata left join on one key."""
    return left.join(meta, key, "left")


def key_coverage(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Distinct non-NULL left keys, how many occur on the right, and the share.
    Distinct keys on both sides (hash aggregates), then one left join of key sets — no row of
    either side is materialised per key."""
    right_key = right_key or left_key
    lk = left.select(F.col(left_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    rk = right.select(F.col(right_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    res = lk.join(rk.withColumn("_m", F.lit(1)), "_k", "left").agg(
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum("_m"), F.lit(0)).cast("long").alias("matched_keys"))
    return res.withColumn(
        "coverage", F.when(F.col("distinct_keys") > 0,
                           F.col("matched_keys") / F.col("distinct_keys")).otherwise(F.lit(0.0)))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Row-wise concatenation by column name; missing columns become NULL
    (UNION ALL)."""
    frames = [f for f in frames if f is not None]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out

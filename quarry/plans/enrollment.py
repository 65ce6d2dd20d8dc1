"""R2 in full: entity-type filter, fiscal dates chosen by source label, interval overlap with
open terminations, NULL windows, NULL starts and NULL keys, and key coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import coerce as C
from quarry.operators import interval as IV
from quarry.operators import merge as M
from quarry.plans.bindings import r4
from quarry.plans.recipes_sql import pad6
from quarry.plans.recipes_sql import r4 as sql_r4
from quarry.session import Tables

#: The two kinds of entity that count, and the label whose rows use the second pair of dates.
KINDS = ("A", "R")
SECOND_ONLY = "CMS only"


def choose_dates(df, label: str, first: tuple[str, str], second: tuple[str, str]):
    """``fy_begin`` and ``fy_end``: the second pair for rows labelled ``SECOND_ONLY``, else the first."""
    other = F.coalesce(F.col(label) == SECOND_ONLY, F.lit(False))
    pick = lambda a, b: F.when(other, C.to_date_lenient(b)).otherwise(C.to_date_lenient(a))
    return df.withColumns({"fy_begin": pick(first[0], second[0]), "fy_end": pick(first[1], second[1])})


def q_recipe_enroll_dated(spark, sf_dir):
    t = Tables(spark, sf_dir)
    day = F.col("o_orderdate").cast("date")
    text = lambda d: F.date_format(d, "M/d/yyyy")
    left = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 13 != 0, C.zero_pad(F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")), 6, drop_after_dot=True)).alias("ccn"),
        F.when(F.col("o_custkey") % 3 == 0, SECOND_ONLY).when(F.col("o_custkey") % 3 == 1, "both").alias("label"),
        F.when(F.col("o_orderkey") % 11 != 0, text(day)).alias("b1"), text(F.date_add(day, 30)).alias("e1"),
        text(F.date_add(day, 20)).alias("b2"), F.when(F.col("o_orderkey") % 17 != 0, text(F.date_add(day, 25))).alias("e2"))
    left = choose_dates(left, "label", ("b1", "e1"), ("b2", "e2"))
    ship = F.col("l_shipdate").cast("date")
    per = t.lineitem.where(F.col("l_returnflag").isin(*KINDS)).select(
        C.zero_pad(F.col("l_orderkey").cast("string"), 6).alias("ccn"),
        C.to_date_lenient(F.when(F.col("l_linenumber") != 3, text(ship))).alias("s"),
        C.to_date_lenient(F.when(F.col("l_linenumber") % 2 == 1, text(F.date_add(ship, (F.col("l_partkey") % 40).cast("int"))))).alias("t"))
    res = IV.interval_overlap_flag(left, "ccn", "fy_begin", "fy_end", per, "ccn", "s", "t", out="enrolled")
    share = M.key_coverage(left, per, "ccn", "ccn").select("coverage").scalar()
    return res.select("o_orderkey", "ccn", "enrolled", r4(share).alias("coverage"))


SQL = {"recipe_enroll_dated": f"""
WITH l AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey END AS k, o_custkey % 3 = 0 AS second, o_orderdate::DATE AS d FROM orders),
 w AS (SELECT *, CASE WHEN second THEN d + 20 WHEN o_orderkey % 11 <> 0 THEN d END AS b,
              CASE WHEN NOT second THEN d + 30 WHEN o_orderkey % 17 <> 0 THEN d + 25 END AS e FROM l),
 p AS (SELECT l_orderkey AS k, CASE WHEN l_linenumber <> 3 THEN l_shipdate::DATE END AS s,
              CASE WHEN l_linenumber % 2 = 1 THEN l_shipdate::DATE + CAST(l_partkey % 40 AS INTEGER) END AS t
       FROM lineitem WHERE l_returnflag IN ('A', 'R')),
 c AS (SELECT count(DISTINCT w.k) FILTER (WHERE w.k IN (SELECT k FROM p)) / count(DISTINCT w.k) AS share FROM w)
SELECT o_orderkey, CASE WHEN k IS NOT NULL THEN {pad6("CAST(k AS VARCHAR)")} END AS ccn,
  CAST(EXISTS (SELECT 1 FROM p WHERE p.k = w.k AND (b IS NULL OR e IS NULL OR s IS NULL OR (NOT coalesce(t < b, false) AND s <= e))) AS INTEGER) AS enrolled,
  {sql_r4("share")} AS coverage
FROM w, c
"""}

"""The ten report shapes, over an order-level panel built from the test tables.

Panel (one row per order): entity = customer, Year = order year, State = nation,
FType = priority bucket, Segment = market segment, RU = 'R'/'U' by account
balance, margin = total price in thousands, cost = total price per line item,
flag = order finished, funding = returned-line revenue (0 when none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import coerce as C
from quarry.functions import finance as FN
from quarry.operators import agg as A
from quarry.operators import quantiles as QT
from quarry.operators import dedupe as D
from quarry.plans.bindings import r4
from quarry.session import Tables

# Report buckets and category lists.
PRIORITY_BUCKETS = {"URG": ["1-URGENT"], "HIGH": ["2-HIGH"], "MED": ["3-MEDIUM"]}
FTYPES = ["URG", "HIGH", "MED", "Other"]
SEGMENTS3 = ["AUTOMOBILE", "BUILDING", "MACHINERY"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def report_panel(t: Tables) -> DataFrame:
    li = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("funding"))
    o = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left"))
    return o.select(
        F.col("o_custkey").alias("id"), "o_orderkey", F.year("o_orderdate").alias("Year"),
        F.col("n_name").alias("State"), FN.bucket("o_orderpriority", PRIORITY_BUCKETS).alias("FType"),
        F.col("c_mktsegment").alias("Segment"),
        F.when(F.col("c_acctbal") < 5000, "R").otherwise("U").alias("RU"),
        (F.col("o_totalprice") / 1000).alias("margin"),
        C.safe_div("o_totalprice", "lines").alias("cost"),
        (F.col("o_orderstatus") == "F").cast("int").alias("flag"),
        F.coalesce(F.col("funding"), F.lit(0.0)).alias("funding"),
        "o_orderstatus", F.col("o_orderdate").cast("date").alias("odate"))


def _wide(long: DataFrame, index: str, column: str, value: str, values) -> DataFrame:
    wide = A.pivot_wide(long, index, column, value, values)
    return wide.select(index, *[r4(v).alias(v) for v in values])


def q_report_q1(spark, sf_dir):
    """National trend: median margin by year x type, wide."""
    p = report_panel(Tables(spark, sf_dir))
    long = QT.group_medians(p, ["Year", "FType"], {"m": "margin"})
    return _wide(long, "Year", "FType", "m", FTYPES)


def q_report_q2(spark, sf_dir):
    """State performance: latest year, median margin per state, top/bottom 15."""
    t = Tables(spark, sf_dir)
    p = A.latest_partition(report_panel(t), "Year", t.orders.select(F.year("o_orderdate").alias("Year")))
    per = QT.group_medians(p, "State", {"Median_Margin": "margin"})
    tb = A.top_bottom(per, "State", "Median_Margin", n=15)
    return tb.select("section", "pos", "State", r4("Median_Margin").alias("Median_Margin"))


def q_report_q3(spark, sf_dir):
    """Conversions: first row per flagged entity, counted by year x segment."""
    p = report_panel(Tables(spark, sf_dir)).where(F.col("o_orderstatus") == "P")
    first = D.first_per_key(p, "id", [F.asc("odate"), F.asc("o_orderkey")])
    first = first.withColumn("Conv_Year", F.year("odate"))
    return A.pivot_counts(first, "Conv_Year", "Segment", SEGMENTS)


def q_report_q4(spark, sf_dir):
    """Ownership comparison: segments in a list, medians + distinct entities."""
    p = report_panel(Tables(spark, sf_dir)).where(F.col("Segment").isin(*SEGMENTS3))
    per = p.groupBy("Segment").agg(F.countDistinct("id").alias("Entity_Count"))
    out = QT.with_medians(per, p, "Segment", {"Median_Margin": "margin", "Median_Cost": "cost", "Median_Funding": "funding",
                                              "Median_Flag_Pct": F.col("flag") * 100})
    return out.select("Segment", *[r4(c).alias(c) for c in ("Median_Margin", "Median_Cost", "Median_Funding",
                                                           "Median_Flag_Pct")], "Entity_Count")


def q_report_q5(spark, sf_dir):
    """Rural/urban: median margin by year x R/U, wide."""
    p = report_panel(Tables(spark, sf_dir)).where(F.col("RU").isin("R", "U"))
    long = QT.group_medians(p, ["Year", "RU"], {"m": "margin"})
    return _wide(long, "Year", "RU", "m", ["R", "U"])


def q_report_q6(spark, sf_dir):
    """Mix: per year, medians of two shares."""
    p = report_panel(Tables(spark, sf_dir))
    out = QT.group_medians(p, "Year", {"Flag_Pct": F.col("flag") * 100, "Funding_Share": C.safe_div("funding", F.col("margin") * 1000)})
    return out.select("Year", r4("Flag_Pct").alias("Flag_Pct"), r4("Funding_Share").alias("Funding_Share"))


def q_report_q7(spark, sf_dir):
    """Two-type comparison: median margin by year for two types, wide."""
    p = report_panel(Tables(spark, sf_dir)).where(F.col("FType").isin("URG", "HIGH"))
    long = QT.group_medians(p, ["Year", "FType"], {"m": "margin"})
    return _wide(long, "Year", "FType", "m", ["URG", "HIGH"])


def q_report_q8(spark, sf_dir):
    """Participation: latest year, flagged rows / distinct entities per state, top 20."""
    t = Tables(spark, sf_dir)
    p = A.latest_partition(report_panel(t), "Year", t.orders.select(F.year("o_orderdate").alias("Year")))
    per = p.groupBy("State").agg(F.countDistinct("id").alias("Total"),
                                 A.count_where(F.col("flag") == 1).alias("Flagged"))
    per = per.withColumn("Rate", F.col("Flagged") / F.col("Total"))
    top = A.top_n(per, [F.desc("Rate"), F.asc("State")], 20)
    return top.select("State", "Total", "Flagged", r4("Rate").alias("Rate"))


def q_report_q9(spark, sf_dir):
    """Funding: years in a range, total funding, median margin, rows with funding."""
    p = report_panel(Tables(spark, sf_dir)).where(F.col("Year").between(1996, 2000))
    per = p.groupBy("Year").agg(A.sum_or_zero("funding").alias("Total_Funding"), A.count_where(F.col("funding") > 0).alias("With_Funding"))
    out = QT.with_medians(per, p, "Year", {"Median_Margin": "margin"})
    return out.select("Year", F.round("Total_Funding", 2).alias("Total_Funding"),
                      r4("Median_Margin").alias("Median_Margin"), "With_Funding")


def q_report_q10(spark, sf_dir):
    """Cost trend: median cost by year for three types, wide."""
    p = report_panel(Tables(spark, sf_dir)).where(F.col("FType").isin("URG", "HIGH", "MED"))
    long = QT.group_medians(p, ["Year", "FType"], {"m": "cost"})
    return _wide(long, "Year", "FType", "m", ["URG", "HIGH", "MED"])

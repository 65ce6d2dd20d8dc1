"""Queries for operators that no report or recipe shows by itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import agg as A
from quarry.operators import columns as P
from quarry.operators import dedupe as D
from quarry.plans.bindings import r4
from quarry.plans.recipes import _conversion_inputs, conversion_list
from quarry.plans.recipes_sql import r4 as sql_r4
from quarry.session import Tables


def q_group_mean(spark, sf_dir):
    """A1 with NULL keys and NaN values: those groups and values are left out."""
    o = Tables(spark, sf_dir).orders.select(
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderpriority")).alias("k"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.floor("o_totalprice").cast("double")).alias("price"))
    return A.group_mean(o, "k", ["price"]).select("k", r4("price").alias("price"))


def q_group_size(spark, sf_dir):
    """Groups with a NULL key are dropped."""
    o = Tables(spark, sf_dir).orders.withColumn("k", F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderpriority")))
    return A.group_size(o, ["k", "o_orderstatus"])


def q_latest_value(spark, sf_dir):
    """L5."""
    return A.latest_value(Tables(spark, sf_dir).orders.select(F.col("o_orderdate").cast("date").alias("d")), "d")


def q_column_layout(spark, sf_dir):
    """Wanted columns that exist, helpers dropped, a constant and a typed
    NULL, the canonical order with a missing column and an extra one."""
    o = Tables(spark, sf_dir).orders
    o = P.keep_existing(o, ["o_orderstatus", "absent", "o_orderkey", "o_custkey", "o_orderpriority"])
    o = P.drop_existing(o, ["o_orderpriority", "never"])
    o = P.with_constant(P.with_constant(o, "source", "orders"), "note", None, "string")
    return P.canonical_order(o, ["o_orderkey", "year", "o_custkey"], {"year": "int"})


def q_conversion_fallback(spark, sf_dir):
    """Without the base list the second list stands alone, its ids NULL."""
    return conversion_list(None, _conversion_inputs(Tables(spark, sf_dir))[1])


def q_longest_span(spark, sf_dir):
    """W1 on spans with NULL ends and equal lengths."""
    li = Tables(spark, sf_dir).lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("b"),
        F.when(F.col("l_linenumber") % 3 != 0, F.date_add(F.col("l_shipdate").cast("date"), (F.col("l_partkey") % 9).cast("int"))).alias("e"))
    return D.dedupe_longest(li, "l_orderkey", "b", "e", [F.asc("l_linenumber")])


SQL = {
    "group_mean": f"""
SELECT k, {sql_r4("avg(price)")} AS price FROM (
  SELECT CASE WHEN o_custkey % 5 <> 0 THEN o_orderpriority END AS k, CASE WHEN o_orderkey % 3 <> 0 THEN floor(o_totalprice) END AS price FROM orders)
WHERE k IS NOT NULL GROUP BY k""",
    "group_size": """
SELECT o_orderpriority AS k, o_orderstatus, count(*) AS count FROM orders WHERE o_custkey % 5 <> 0 GROUP BY ALL""",
    "latest_value": "SELECT max(o_orderdate::DATE) AS max_d FROM orders",
    "column_layout": """
SELECT o_orderkey, NULL::INTEGER AS year, o_custkey, o_orderstatus, 'orders' AS source, NULL::VARCHAR AS note FROM orders""",
    "conversion_fallback": """
SELECT NULL::BIGINT AS "Pre-REH CCN", NULL::BIGINT AS "Post-REH CCN", upper(s_name) || ' Community Hospital' AS "Hospital Name", lower(n_name) AS "State",
  strftime(DATE '2022-06-01' + CAST(s_suppkey % 200 AS INTEGER), '%Y-%m-%d') AS "REH Conversion Date", 'Closed' AS "Current Status", 'CAH' AS "Previous Medicare Payment Type"
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "longest_span": """
SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS b, CASE WHEN l_linenumber % 3 <> 0 THEN l_shipdate::DATE + CAST(l_partkey % 9 AS INTEGER) END AS e
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY date_diff('day', b, e) DESC NULLS LAST, b DESC NULLS LAST, l_linenumber) = 1""",
}

"""R6 in full: average baselines per (unified id, state) with identity, scope, period rows,
nineteen means, modes, first and last values, flags, solvency and derived financials."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions import coerce as C
from quarry.functions import finance as FN
from quarry.functions import temporal as TM
from quarry.operators import merge as M
from quarry.operators.fanin import fan_in
from quarry.plans.bindings import exact_mean, r4
from quarry.plans.recipes_sql import _solvency
from quarry.plans.recipes_sql import r4 as sql_r4
from quarry.session import Tables, cut_lineage

#: The means: all but ``share`` are exact sums over counts.
MEANS = ("price gross ret other qty disc tax lines acct max_price min_price implied implied_clean late "
         "prio seglen urgent dcoh share").split()


def baseline_rows(t: Tables) -> DataFrame:
    """One row per order: its reporting entity, period, measures and flags."""
    line = F.col("l_extendedprice").cast("decimal(38,4)")
    li = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(line).cast("double").alias("gross"), F.sum(F.when(F.col("l_returnflag") == "R", line)).cast("double").alias("ret"),
        F.sum(F.when(F.col("l_returnflag") != "R", line)).cast("double").alias("other"),
        F.sum(F.col("l_quantity").cast("decimal(38,4)")).cast("double").alias("qty"),
        F.sum(F.col("l_discount").cast("decimal(38,4)")).cast("double").alias("disc"),
        F.sum(F.col("l_tax").cast("decimal(38,4)")).cast("double").alias("tax"), F.count(F.lit(1)).alias("lines"),
        F.max("l_extendedprice").alias("max_price"), F.min("l_extendedprice").alias("min_price"),
        F.count_if(F.col("l_returnflag") == "N").alias("late"))
    o = (t.orders.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
         .join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")))
    prefix = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    o = o.withColumns({
        "ccn": F.concat(prefix, F.lpad((1200 + F.col("c_custkey") % 400).cast("string"), 4, "0")),
        "pre": F.when(F.col("c_custkey") % 9 == 0, F.concat(prefix, F.lpad((F.col("c_custkey") % 90).cast("string"), 4, "0"), F.lit(".0"))),
        "b": F.col("o_orderdate").cast("date"), "e": F.date_add(F.col("o_orderdate").cast("date"), 90),
        "event": F.when(F.col("c_acctbal") < 0, F.lit("1999-01-01").cast("date")), "y": F.year("o_orderdate")})
    o = o.withColumns({"uid": C.unified_id("pre", "ccn"), "converter": F.col("pre").isNotNull()})
    o = o.withColumn("is_cah", C.id_suffix_between("uid", 1300, 1399)).where(F.col("is_cah") | F.col("converter"))
    o = o.withColumn("row_type", TM.period_label("b", "e", "event"))
    return o.select(
        "uid", F.col("n_name").alias("state"), "o_orderkey", "b", "e", "event", "y", "row_type", "is_cah", "converter", "pre",
        "o_orderstatus", "o_orderpriority", "c_mktsegment", "gross", "ret", "other", "qty", "disc", "tax", "lines", "max_price", "min_price", "late",
        F.col("o_totalprice").alias("price"), F.col("c_acctbal").alias("acct"),
        FN.implied_other_income("o_totalprice", "gross", "ret").alias("implied"),
        FN.implied_other_income("o_totalprice", "gross", "ret", "other").alias("implied_clean"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("prio"), F.length("c_mktsegment").alias("seglen"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"), (F.col("o_totalprice") / 1000).alias("dcoh"),
        FN.share_with_fallback("ret", "other", F.lit(50.0)).alias("share"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("qty")).alias("distance"))


def average_baseline(rows: DataFrame) -> DataFrame:
    """One record per (uid, state): means at that grain, all else at the grain of the uid.

    ``rows`` should be a stage on disk: two aggregates read it, one for the means and spans, one
    (``fan_in``) for all modes, first and last values."""
    in_period = F.col("row_type") == "CAH_Year"
    own = Window.partitionBy("uid")
    means = rows.where(in_period).groupBy("uid", "state").agg(
        *[(F.avg(m) if m == "share" else exact_mean(m)).alias(m) for m in MEANS],
        F.count("y").alias("_years"), F.min("y").alias("_first"), F.max("y").alias("_last"), F.sum("urgent").alias("_urgent"))
    # the spans are those of the uid, over all its states, known or not
    means = means.withColumns({
        "year_count": F.sum("_years").over(own), "year_min": F.min("_first").over(own), "year_max": F.max("_last").over(own),
        "any_urgent": F.coalesce((F.sum("_urgent").over(own) > 0).cast("int"), F.lit(0))}).drop("_years", "_first", "_last", "_urgent")
    period = lambda c: F.when(in_period, F.col(c))
    converted = lambda c: F.when(F.col("converter"), F.col(c))
    one = fan_in(
        rows, "uid", modes={f"top_{c[2:]}": period(c) for c in ("o_orderpriority", "c_mktsegment", "o_orderstatus")},
        firsts={"first_status": period("o_orderstatus"), "is_cah": period("is_cah"), "converter": period("converter"),
                "event_date": converted("event"), "pre_raw": converted("pre")},
        lasts={"distance": period("distance")}, first_order=F.struct("b", "o_orderkey"),
        last_order=F.struct(F.col("e").isNull(), "e", "o_orderkey"))
    out = M.backfill_left(means.dropna(subset=["uid", "state"]), one, "uid")
    share = F.col("share")
    return out.withColumns(
        FN.solvency({"Days_Cash_on_Hand": F.col("dcoh"), "Current_Ratio": share * 10, "Debt_Ratio": 1 - share, "Operating_Margin_Pct": (F.col("price") - 150000) / 1e6})
        | FN.derived_financials("price", "gross", share))


def q_recipe_baseline_full(spark, sf_dir):
    out = average_baseline(cut_lineage(baseline_rows(Tables(spark, sf_dir))))
    return out.select(
        "uid", "state", *[r4(m).alias(f"mean_{m}") for m in MEANS], "first_status", "is_cah", "converter", "distance", "year_count", "year_min", "year_max",
        "any_urgent", "top_orderpriority", "top_mktsegment", "top_orderstatus", "event_date", "pre_raw",
        F.col("Solvency_Score").alias("score"), F.col("Solvency_Status").alias("status"), F.col("Solvency_Flags").alias("flags"),
        r4("Historical_Op_Income").alias("op_income"), r4("Historical_Op_Margin").alias("op_margin"),
        r4("IP_Revenue").alias("ip_revenue"), r4("OP_Revenue").alias("op_revenue"), F.col("Swing_Bed_Risk").alias("swing_risk"))


def _mode(c: str) -> str:
    return (f" m_{c} AS (SELECT uid, {c} AS top_{c[2:]} FROM (SELECT uid, {c}, count(*) AS k FROM p WHERE {c} IS NOT NULL GROUP BY 1, 2)\n"
            f"   QUALIFY row_number() OVER (PARTITION BY uid ORDER BY k DESC, {c}) = 1)")


_MEAN_SQL = ", ".join(f"avg({m}) AS {m}" if m == "share" else f"sum({m}::DECIMAL(38,8))::DOUBLE / count({m}) AS {m}" for m in MEANS)
SQL = {"recipe_baseline_full": f"""
WITH li AS (SELECT l_orderkey, sum(l_extendedprice::DECIMAL(38,4))::DOUBLE AS gross,
    (sum(l_extendedprice::DECIMAL(38,4)) FILTER (WHERE l_returnflag = 'R'))::DOUBLE AS ret,
    (sum(l_extendedprice::DECIMAL(38,4)) FILTER (WHERE l_returnflag <> 'R'))::DOUBLE AS other,
    sum(l_quantity::DECIMAL(38,4))::DOUBLE AS qty, sum(l_discount::DECIMAL(38,4))::DOUBLE AS disc, sum(l_tax::DECIMAL(38,4))::DOUBLE AS tax,
    count(*) AS lines, max(l_extendedprice) AS max_price, min(l_extendedprice) AS min_price, count(*) FILTER (WHERE l_returnflag = 'N') AS late
  FROM lineitem GROUP BY 1),
 j AS (SELECT *, lpad(n_nationkey::VARCHAR, 2, '0') || lpad((1200 + c_custkey % 400)::VARCHAR, 4, '0') AS ccn,
    CASE WHEN c_custkey % 9 = 0 THEN lpad(n_nationkey::VARCHAR, 2, '0') || lpad((c_custkey % 90)::VARCHAR, 4, '0') || '.0' END AS pre
  FROM orders LEFT JOIN li ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
 o AS (SELECT coalesce(split_part(pre, '.', 1), ccn) AS uid, n_name AS state, o_orderkey, o_orderdate::DATE AS b, o_orderdate::DATE + 90 AS e,
    CASE WHEN c_acctbal < 0 THEN DATE '1999-01-01' END AS event, CAST(year(o_orderdate) AS INTEGER) AS y, pre, pre IS NOT NULL AS converter,
    o_orderstatus, o_orderpriority, c_mktsegment, gross, ret, other, qty, disc, tax, lines, max_price, min_price, late,
    o_totalprice AS price, c_acctbal AS acct, o_totalprice - (gross - ret) AS implied, o_totalprice - (gross - ret) - coalesce(other, 0) AS implied_clean,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio, length(c_mktsegment) AS seglen, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS urgent,
    o_totalprice / 1000 AS dcoh,
    least(greatest(CASE WHEN ret IS NOT NULL AND other IS NOT NULL AND ret + other > 0 THEN ret / (ret + other) ELSE 50.0 / 100 END, 0.0), 1.0) AS share,
    CASE WHEN o_orderkey % 4 <> 0 THEN qty END AS distance FROM j),
 s AS (SELECT *, CAST(substr(uid, 3) AS DOUBLE) BETWEEN 1300 AND 1399 AS is_cah FROM o),
 r AS (SELECT * FROM s WHERE is_cah OR converter),
 p AS (SELECT * FROM r WHERE event IS NULL OR (b < event AND e <= event)),
 m AS (SELECT uid, state, {_MEAN_SQL} FROM p GROUP BY 1, 2),
 f AS (SELECT uid, arg_min(o_orderstatus, (b, o_orderkey)) AS first_status, arg_min(is_cah, (b, o_orderkey)) AS is_cah, arg_min(converter, (b, o_orderkey)) AS converter,
    arg_max(distance, (e, o_orderkey)) FILTER (WHERE distance IS NOT NULL) AS distance, count(y) AS year_count, min(y) AS year_min, max(y) AS year_max,
    coalesce(CAST(avg(urgent) > 0 AS INTEGER), 0) AS any_urgent FROM p GROUP BY 1),
 c AS (SELECT uid, arg_min(event, (b, o_orderkey)) FILTER (WHERE event IS NOT NULL) AS event_date, arg_min(pre, (b, o_orderkey)) AS pre_raw FROM r WHERE converter GROUP BY 1),
{_mode("o_orderpriority")},
{_mode("c_mktsegment")},
{_mode("o_orderstatus")}
SELECT m.uid, state, {", ".join(f"{sql_r4('m.' + x)} AS mean_{x}" for x in MEANS)}, first_status, is_cah, converter, distance, year_count, year_min, year_max,
  any_urgent, top_orderpriority, top_mktsegment, top_orderstatus, event_date, pre_raw,
  {_solvency("dcoh", "share * 10", "1 - share", "(price - 150000) / 1e6")},
  {sql_r4("price - gross")} AS op_income, {sql_r4("CASE WHEN price > 0 THEN (price - gross) / price END")} AS op_margin,
  {sql_r4("price * (1 - share)")} AS ip_revenue, {sql_r4("price * share")} AS op_revenue, (1 - share) > 0.25 AS swing_risk
FROM m LEFT JOIN f USING (uid) LEFT JOIN c USING (uid) LEFT JOIN m_o_orderpriority USING (uid) LEFT JOIN m_c_mktsegment USING (uid) LEFT JOIN m_o_orderstatus USING (uid)
"""}

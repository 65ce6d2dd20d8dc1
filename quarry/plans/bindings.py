"""Driver bindings: one named query per operator, over the TPC-H-ish test tables.

Each query reads whole tables from ``sf_dir``. Doubles are rounded to 4 decimals
and timestamps cast to DATE so that results compare exactly with the SQL oracle
(``quarry.plans.oracle``). Derived NULLs (``key % n = 0``) stand in for missing
values because the tables have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.functions import coerce as C
from quarry.functions import finance as FN
from quarry.functions import temporal as TM
from quarry.functions import text as TX
from quarry.operators import agg as A
from quarry.operators import dedupe as D
from quarry.operators import identity as ID
from quarry.operators import interval as IV
from quarry.operators import merge as M
from quarry.operators import quality as Q
from quarry.operators import quantiles as QT
from quarry.operators import rank as R
from quarry.operators import similarity as S
from quarry.operators.fanin import fan_in
from quarry.operators.ordering import global_row_number
from quarry.session import TABLES, Tables


def r4(c):
    """Round to 4 decimals, half up, with plain double arithmetic (floor(x*1e4 +
    0.5) / 1e4) so that any engine doing IEEE arithmetic gets the same bits."""
    x = F.col(c) if isinstance(c, str) else c
    return F.floor(x * 10000 + 0.5) / 10000


def exact_mean(c):
    """Mean of a column of at most 8 decimals with an exact (decimal) sum, so the value
    does not depend on summation order."""
    x = F.col(c) if isinstance(c, str) else c
    return F.sum(x.cast("decimal(38,8)")).cast("double") / F.count(x)


def _date(c):
    return F.col(c).cast("date")


# ---------------------------------------------------------------- dates / dedupe

def q_dominant_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    b = _date("o_orderdate")
    e = F.date_add(b, (F.lit(90) + F.col("o_orderkey") % 400).cast("int"))
    return o.select("o_orderkey", TM.dominant_year(b, e).alias("dominant_year"))


def q_dedupe_longest(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    li = li.withColumn("ship_year", F.year("l_shipdate"))
    order = [F.col("l_quantity").desc_nulls_last(), F.col("l_shipdate").desc_nulls_last()] + \
        [F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice",
                                  "l_discount", "l_tax", "l_returnflag", "l_linestatus")]
    kept = D.keep_first(li, ["l_partkey", "ship_year"], order)
    return kept.select("l_partkey", "ship_year", "l_orderkey", "l_linenumber", "l_quantity",
                       _date("l_shipdate").alias("l_shipdate"))


def q_latest_per_key(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    kept = D.latest_per_key(o, "o_custkey", "o_orderdate", [F.desc("o_orderkey")])
    return kept.select("o_custkey", "o_orderkey", _date("o_orderdate").alias("o_orderdate"),
                       r4("o_totalprice").alias("o_totalprice"))


def q_first_per_key(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    kept = D.first_per_key(ev, "user_id", [F.asc("ts"), F.asc("event_id")])
    return kept.select("user_id", "event_id", _date("ts").alias("day"), "event_type",
                       r4("value").alias("value"))


def q_dup_count(spark, sf_dir):
    return D.duplicate_count(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- joins

def _cust_year_totals(t: Tables):
    o, li = t.orders, t.lineitem
    y_nulled = F.when(F.col("o_custkey") % 7 == 0, F.lit(None).cast("int"))
    a = (o.select(F.col("o_custkey").alias("k"),
                  y_nulled.otherwise(F.year("o_orderdate")).alias("y"), "o_totalprice")
         .groupBy("k", "y").agg(F.round(F.sum("o_totalprice"), 2).alias("ov")))
    b = (li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
         .select(F.col("o_custkey").alias("k"),
                 y_nulled.otherwise(F.year("l_shipdate")).alias("y"), "l_extendedprice")
         .groupBy("k", "y").agg(F.round(F.sum("l_extendedprice"), 2).alias("sv")))
    return a, b


def q_nullsafe_full_outer(spark, sf_dir):
    a, b = _cust_year_totals(Tables(spark, sf_dir))
    m = M.nullsafe_full_outer(a, b, ["k", "y"], label_col="src")
    return m.select("k", "y", "ov", "sv", "src")


def q_lookup_left(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # left carries the nation as free text (lower case); right is the nation list
    left = t.customer.join(
        t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.lower("n_name").alias("cust_nation")),
        "c_nationkey")
    right = t.nation.select("n_nationkey", F.concat(F.lit(" "), F.upper("n_name"), F.lit(" ")).alias("n_label"),
                            "n_regionkey")
    j = M.lookup_left(left, right, exact=[("c_nationkey", "n_nationkey")], folded=[("cust_nation", "n_label")])
    return j.select(C.zero_pad("c_custkey", 6).alias("cust_id"), "c_nationkey", "n_regionkey")


def _rekey_changes(t: Tables):
    n = t.nation
    return n.select(F.col("n_nationkey").alias("old_key"),
                    F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey") + 25).alias("new_key"),
                    "n_name", "n_regionkey", F.col("n_nationkey").alias("ord"))


def q_lookup_update(spark, sf_dir):
    t = Tables(spark, sf_dir)
    cust = t.customer.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 2 == 1, F.col("c_nationkey") + 25).otherwise(F.col("c_nationkey")).alias("c_key"))
    out = ID.apply_rekey(cust, "c_key", _rekey_changes(t), "old_key", "new_key",
                         ["n_name", "n_regionkey"], "ord")
    return out.select("c_custkey", "c_key", "n_name", "n_regionkey", "is_rekeyed", "old_id")


def q_interval_overlap(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", _date("o_orderdate").alias("b"),
                        F.date_add(_date("o_orderdate"), 30).alias("e"))
    p = t.lineitem.select("l_orderkey",
                          F.when(F.col("l_linenumber") == 3, F.lit(None).cast("date"))
                          .otherwise(_date("l_shipdate")).alias("s"),
                          F.date_add(_date("l_shipdate"), 15).alias("t"))
    res = IV.interval_overlap_flag(o, "o_orderkey", "b", "e", p, "l_orderkey", "s", "t")
    return res.select("o_orderkey", "flag")


def q_key_coverage(spark, sf_dir):
    t = Tables(spark, sf_dir)
    cov = M.key_coverage(t.orders, t.lineitem, "o_orderkey", "l_orderkey")
    return cov.select("distinct_keys", "matched_keys", r4("coverage").alias("coverage"))


def q_tfidf_match(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    left = p.select(F.col("p_name").alias("name")).distinct()
    right = p.select(F.concat_ws(" ", "p_brand", "p_name").alias("entity")).distinct()
    left = left.withColumn("text", TX.similarity_text("name"))
    right = right.withColumn("text", TX.similarity_text("entity"))
    m = S.tfidf_match(left, right, "text", "text", threshold=0.40)
    return m.select(F.col("name").alias("p_name"), r4("match_score").alias("match_score"), "match_flag")


def q_embed_rerank(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    name = F.concat(F.lit("group "), F.col("label").cast("string"), F.lit(" part "), (F.col("vec_id") % 7).cast("string"))
    e = e.withColumn("text", TX.similarity_text(name))
    # every fifth row against all others: both sides grow with the table
    left = e.where(F.col("vec_id") % 5 == 0)
    right = e.where(F.col("vec_id") % 5 != 0)
    res = S.shortlist_rerank(left, right, "vec_id", "vec_id", "text", "text", "embedding", "embedding",
                             k=10, threshold=0.82)
    return res.select("vec_id", r4("rerank_score").alias("rerank_score"), "rerank_flag")


# ---------------------------------------------------------------- ranks / pivots / aggregates

def q_pct_rank_avg(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return R.pct_rank_avg(p, "p_size", "pctl").select("p_partkey", r4("pctl").alias("pctl"))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _latest_event_values(ev: DataFrame) -> DataFrame:
    latest = D.latest_per_key(ev, ["user_id", "event_type"], "ts", [F.desc("event_id")])
    return A.pivot_wide(latest, "user_id", "event_type", "value", EVENT_TYPES)


def q_pivot_latest(spark, sf_dir):
    wide = _latest_event_values(Tables(spark, sf_dir).events)
    return wide.select("user_id", *[r4(c).alias(c) for c in EVENT_TYPES])


TYPE_BUCKETS = {"ECONOMY": ["ECONOMY"], "SMALL": ["SMALL"]}


def q_median_trend(spark, sf_dir):
    """Flagship: per order year x bucketed part type, median unit price, wide."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")
    o = t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"))
    p = t.part.select("p_partkey", FN.bucket("p_type", TYPE_BUCKETS).alias("b"))
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    long = QT.group_medians(j, ["y", "b"], {"med": C.safe_div("l_extendedprice", "l_quantity")})
    wide = A.pivot_wide(long, "y", "b", "med", ["ECONOMY", "SMALL", "Other"])
    return wide.select("y", *[r4(c).alias(c) for c in ["ECONOMY", "SMALL", "Other"]])


def _orders_nation(t: Tables) -> DataFrame:
    return (t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")))


def q_top_bottom(spark, sf_dir):
    t = Tables(spark, sf_dir)
    per = QT.group_medians(_orders_nation(t), "n_name", {"med": "o_totalprice"})
    tb = A.top_bottom(per, "n_name", "med", n=5)
    return tb.select("section", "pos", "n_name", r4("med").alias("med"))


def q_top_ratio(spark, sf_dir):
    t = Tables(spark, sf_dir)
    on = _orders_nation(t).withColumn("y", F.year("o_orderdate"))
    latest = A.latest_partition(on, "y", t.orders.select(F.year("o_orderdate").alias("y")))
    per = latest.groupBy("n_name").agg(
        F.countDistinct("o_custkey").alias("total"),
        A.count_where(F.col("o_orderpriority") == "1-URGENT").alias("flagged"))
    per = per.withColumn("rate", F.col("flagged") / F.col("total"))
    top = A.top_n(per, [F.desc("rate"), F.asc("n_name")], 20)
    return top.select("n_name", "total", "flagged", r4("rate").alias("rate"))


def q_multi_agg(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    per = j.groupBy("c_mktsegment").agg(F.countDistinct("o_custkey").alias("customers"))
    out = QT.with_medians(per, j, "c_mktsegment", {
        "med_totalprice": "o_totalprice", "med_acctbal": "c_acctbal", "med_year": F.year("o_orderdate")})
    return out.select("c_mktsegment", *[r4(c).alias(c) for c in ("med_totalprice", "med_acctbal", "med_year")],
                      "customers")


def q_pivot_counts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.withColumn("y", F.year("o_orderdate"))
    return A.pivot_counts(o, "y", "o_orderstatus", ["F", "O", "P"])


def q_cond_sum(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.withColumn("day", _date("ts"))
    out = ev.groupBy("day").agg(
        A.sum_or_zero(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("purchase_value"),
        A.count_where(F.col("value") > 50).alias("n_over_50"))
    return out.select("day", r4("purchase_value").alias("purchase_value"), "n_over_50")


def q_group_mean_any(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.withColumn("y", F.year("o_orderdate")).withColumn(
        "urgent", (F.col("o_orderpriority") == "1-URGENT").cast("int"))
    out = o.groupBy("o_custkey").agg(
        exact_mean("o_totalprice").alias("mean_price"),
        *A.year_span("y", "year_"),
        A.any_flag("urgent").alias("any_urgent"))
    return out.select("o_custkey", r4("mean_price").alias("mean_price"), "year_count", "year_min",
                      "year_max", "any_urgent")


def q_group_mode(spark, sf_dir):
    return A.group_mode(Tables(spark, sf_dir).orders, "o_custkey", "o_orderpriority", "top")


def _nulled_orders(o: DataFrame) -> DataFrame:
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("date")).otherwise(_date("o_orderdate")).alias("d"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("v"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"))


def q_last_nonnull_snapshot(spark, sf_dir):
    o = _nulled_orders(Tables(spark, sf_dir).orders)
    snap = D.last_non_null_snapshot(o, "o_custkey", ["v", "d", "o_orderstatus"], "d", ["o_orderkey"])
    return snap.select("o_custkey", r4("v").alias("last_v"), F.col("d").alias("last_d"),
                       F.col("o_orderstatus").alias("last_status"))


def q_ratios(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     r4(C.safe_div("l_extendedprice", "l_quantity")).alias("unit_price"),
                     r4(C.safe_div("l_tax", "l_discount")).alias("tax_per_discount"))


def q_event_period(spark, sf_dir):
    t = Tables(spark, sf_dir)
    first_ship = (t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
                  .groupBy("o_custkey").agg(F.min(_date("l_shipdate")).alias("event")))
    o = t.orders.select("o_orderkey", "o_custkey", _date("o_orderdate").alias("b"),
                        F.date_add(_date("o_orderdate"), 30).alias("e"))
    j = o.join(first_ship, "o_custkey", "left")
    return j.select("o_orderkey", TM.period_label("b", "e", "event", "before", "after", "transition").alias("period"),
                    TM.months_since("event", "e").alias("months_since"))


def q_share_split(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    per = j.groupBy("o_custkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("ret"),
        F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice"))).alias("other"),
        F.sum("l_extendedprice").alias("rev"))
    share = FN.share_with_fallback("ret", "other", F.lit(50.0))
    per = per.withColumn("share", share)
    d = FN.derived_financials("rev", F.col("other"), "share")
    return per.select("o_custkey", r4("share").alias("op_share"), r4(d["OP_Revenue"]).alias("op_revenue"),
                      r4(d["IP_Revenue"]).alias("ip_revenue"), d["Swing_Bed_Risk"].alias("swing_risk"))


def q_solvency(spark, sf_dir):
    t = Tables(spark, sf_dir)
    n_orders = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = t.customer.join(n_orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    metrics = {
        "Days_Cash_on_Hand": F.col("c_acctbal") / 50,
        "Current_Ratio": F.col("c_acctbal") / 1000,
        "Debt_Ratio": F.col("n") / 20,
        "Operating_Margin_Pct": (F.col("c_acctbal") - 3000) / 20000,
    }
    s = FN.solvency(metrics)
    return c.select("c_custkey", s["Solvency_Score"].alias("score"), s["Solvency_Status"].alias("status"),
                    s["Solvency_Flags"].alias("flags"))


def q_id_clean(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    raw = F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))
    padded = C.zero_pad(raw, 6, drop_after_dot=True)
    pre = F.when(F.col("c_custkey") % 5 == 0, F.concat((F.col("c_custkey") + 100000).cast("string"), F.lit(".0")))
    return c.select(
        "c_custkey", padded.alias("padded"),
        C.clean_zip(F.concat(F.col("c_custkey").cast("string"), F.lit("-1234"))).alias("zip5"),
        C.id_suffix_between(padded, 100, 199).alias("in_range"),
        C.unified_id(pre, F.col("c_custkey").cast("string")).alias("unified"))


def q_text_norm(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", TX.normalize_text("text").alias("norm"), TX.name_key("text").alias("name_key"))


def q_json_flatten(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    parsed = F.from_json("props", "k BIGINT")
    return ev.select("event_id", parsed["k"].alias("k"))


def _ship_diff(t: Tables) -> DataFrame:
    return (t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.datediff(_date("l_shipdate"), _date("o_orderdate")).alias("x")))


def q_bucket_diff(spark, sf_dir):
    t = Tables(spark, sf_dir)
    x = _ship_diff(t)
    b = Q.diff_buckets(F.col("x"), x, 180)
    return b.select("exact0", "within180", "beyond180", "non_null",
                    *[r4(c).alias(c) for c in ("pct_exact0", "pct_within180", "pct_beyond180")])


def q_box_stats(spark, sf_dir):
    x = _ship_diff(Tables(spark, sf_dir))
    b = Q.box_stats(x, "x")
    return b.select("n", *[r4(c).alias(c) for c in ("q1", "median", "q3", "iqr")],
                    "whisker_low", "whisker_high", "outliers")


def q_missingness(spark, sf_dir):
    o = _nulled_orders(Tables(spark, sf_dir).orders)
    m = Q.missingness(o, ["o_orderkey", "o_custkey", "o_orderstatus", "d", "v", "o_orderpriority"])
    return m.select("column", "missing", r4("share").alias("share"))


def q_value_counts(spark, sf_dir):
    return A.value_counts(Tables(spark, sf_dir).lineitem, "l_returnflag")


def q_union_by_name(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.withColumn("y", F.year("o_orderdate"))
    cols = ["o_orderkey", "o_custkey", "y", "o_orderpriority"]
    early = o.where(F.col("y") < 1998).select(*cols)
    late = o.where(F.col("y") >= 1998).select("o_orderkey", "o_custkey", "y")
    return M.union_by_name([early, late])


def q_manifest(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return Q.manifest({name: getattr(t, name) for name in TABLES})


def q_name_fill_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    left = t.supplier.select(
        "s_suppkey", "s_name", "s_nationkey",
        F.when(F.col("s_suppkey") % 4 == 0, F.lit(None).cast("double")).otherwise(F.col("s_acctbal")).alias("s_acctbal"))
    right = t.supplier.select(F.concat(F.upper("s_name"), F.lit(" Regional Medical Center")).alias("r_name"),
                              F.col("s_nationkey").alias("r_nation"), "s_acctbal")
    out = M.fill_from_right(left, right, [(TX.name_key("s_name"), TX.name_key("r_name")),
                                          (F.col("s_nationkey"), F.col("r_nation"))], ["s_acctbal"])
    return out.select("s_suppkey", "s_name", "s_nationkey", r4("s_acctbal").alias("s_acctbal"))


def q_attr_fan_in(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    attrs = fan_in(o, "o_custkey", {"top_priority": "o_orderpriority"}, {"first_status": "o_orderstatus"}, {"last_price": "o_totalprice"},
                   F.struct("o_orderdate", "o_orderkey"), F.struct(F.col("o_orderdate").isNull(), "o_orderdate", "o_orderkey"), "n_orders")
    latest = D.latest_per_key(o, "o_custkey", "o_orderdate", [F.desc("o_orderkey")]).select(
        "o_custkey", F.col("o_orderkey").alias("latest_orderkey"))
    j = latest.join(attrs, "o_custkey", "left")
    return j.select("o_custkey", "latest_orderkey", "top_priority", "first_status",
                    r4("last_price").alias("last_price"), "n_orders")


def q_filters(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    li = li.withColumn("tax_d", F.when(F.col("l_linenumber") == 1, F.lit(None).cast("double")).otherwise(F.col("l_tax")))
    f = li.where(F.col("l_returnflag").isin("R", "A") | (F.col("l_linestatus") == "O"))
    f = f.where(F.col("l_quantity").between(10, 40)).dropna(subset=["tax_d"])
    return f.select("l_orderkey", "l_linenumber", "l_quantity", F.lit("lineitem").alias("src"),
                    FN.or_flag(F.col("l_discount") > 0.05, F.col("tax_d") > 0.05).alias("flag"))


def q_label_map(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey",
                    FN.flag_label("o_orderstatus", "finished", "not finished", token="F").alias("status_label"),
                    TM.iso_date("o_orderdate").alias("iso_date"),
                    FN.report_round("o_totalprice", 0).alias("price_r"))


def q_sort_latest(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.withColumn("y", F.year("o_orderdate"))
    latest = A.latest_partition(o, "y")
    order = [F.col("o_orderpriority").asc_nulls_last(), F.col("o_totalprice").desc_nulls_last(),
             F.col("o_orderkey").asc()]
    return global_row_number(latest, order, "rn").select("o_orderkey", "rn")


def q_derived_ratios(spark, sf_dir):
    """the derived ratio set over per-order inputs mapped onto the ratio
    spec's column names (inputs absent from the frame give NULL ratios)."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("ext"),
        F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("tax"),
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("disc"),
        F.count(F.lit(1)).alias("n"))
    o = t.orders.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    inputs = o.select(
        "o_orderkey",
        F.col("o_totalprice").alias("CMS_Current_Assets"), F.col("ext").alias("CMS_Current_Liabilities"),
        F.col("tax").alias("CMS_Total_Liabilities"), F.col("o_totalprice").alias("CMS_Total_Assets"),
        F.col("disc").alias("CMS_Cash"), F.col("ext").alias("CMS_Operating_Expense"),
        F.col("n").alias("Total_Discharges"), F.col("ext").alias("CMS_Total_Costs"),
        (F.col("o_totalprice") / 1e6).alias("NASHP_Operating_Margin"))
    r = FN.derive_ratios(inputs)
    other = FN.implied_other_income(F.col("CMS_Current_Assets"), F.col("CMS_Current_Liabilities"),
                                    F.col("CMS_Total_Liabilities"), F.col("CMS_Cash"))
    return r.select("o_orderkey", *[r4(c).alias(c) for c in (
        "Operating_Margin_Pct", "Net_Profit_Margin_Pct", "Current_Ratio", "Debt_Ratio", "Days_Cash_on_Hand",
        "Cost_per_Discharge", "Labor_Cost_Pct")], r4(other).alias("implied_other"))


def q_pivot_multi_index(spark, sf_dir):
    """Counts per (year, nation) pivoted on order status, missing cells 0."""
    on = _orders_nation(Tables(spark, sf_dir)).withColumn("y", F.year("o_orderdate"))
    return A.pivot_counts(on, ["y", "n_name"], "o_orderstatus", ["F", "O", "P"])

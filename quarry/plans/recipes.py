"""Composite recipes (R1-R8, R10) bound to the test tables. Each is one lazy plan
composed from the operators; the hospital-panel roles map as noted per recipe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import coerce as C
from quarry.functions import finance as FN
from quarry.functions import temporal as TM
from quarry.functions import text as TX
from quarry.operators import agg as A
from quarry.operators import columns as P
from quarry.operators import dedupe as D
from quarry.operators import interval as IV
from quarry.operators import merge as M
from quarry.operators import quality as Q
from quarry.operators import rank as R
from quarry.operators import similarity as S
from quarry.plans.bindings import EVENT_TYPES, _latest_event_values, exact_mean, r4
from quarry.session import Tables, cut_lineage


def _d(c):
    return F.col(c).cast("date")


# ---------------------------------------------------------------- R1 + R5

def panel(t: Tables) -> DataFrame:
    """Entity-year panel. Source 1 = orders placed on a dominant year of a
    reporting window and deduped to the longest window per (entity, year);
    source 2 = shipped totals per (entity, ship year); null-safe full outer merge
    with provenance; safe ratios."""
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("k"), "o_totalprice",
                        _d("o_orderdate").alias("b"))
    o = o.withColumn("e", F.date_add("b", (F.lit(90) + F.col("o_orderkey") % 400).cast("int")))
    o = o.withColumn("y", TM.dominant_year("b", "e"))
    src1 = D.dedupe_longest(o, ["k", "y"], "b", "e", [F.asc("o_orderkey")]).select("k", "y", "o_totalprice")
    src2 = (t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("k"), F.year("l_shipdate").alias("y"))
            .agg(F.round(F.sum("l_extendedprice"), 2).alias("ship_total"), F.count(F.lit(1)).alias("lines")))
    m = M.nullsafe_full_outer(src1, src2, ["k", "y"], label_col="src")
    return m.withColumns({"avg_line": C.safe_div("ship_total", "lines"),
                          "order_to_ship": C.safe_div("o_totalprice", "ship_total")})


def q_recipe_panel(spark, sf_dir):
    """R1 + R5: panel, region filter (isin), latest value per entity replaced from a
    dated lookup."""
    t = Tables(spark, sf_dir)
    m = panel(t)
    region = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name"))
    m = m.join(region, F.col("k") == F.col("c_custkey")).where(F.col("r_name").isin("AMERICA", "EUROPE"))
    lookup = t.events.select(F.col("user_id").alias("k"), "ts", "event_id", F.col("value").alias("latest_value"))
    m = M.replace_from_latest(m.withColumn("latest_value", F.lit(None).cast("double")), lookup, "k",
                              "latest_value", "ts", [F.desc("event_id")])
    return m.select("k", "y", r4("o_totalprice").alias("o_totalprice"), "ship_total", "lines", "src",
                    r4("avg_line").alias("avg_line"), r4("order_to_ship").alias("order_to_ship"),
                    r4("latest_value").alias("latest_value"))


# ---------------------------------------------------------------- R2 / R3

def q_recipe_enroll_interval(spark, sf_dir):
    """R2: ids arrive as text ('123.0'), dates as text in mixed layouts; ids are
    zero-padded, dates parsed leniently, then the interval-overlap flag."""
    t = Tables(spark, sf_dir)
    left = t.orders.select(
        C.zero_pad(F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")), 6, drop_after_dot=True).alias("ccn"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("fy_begin_txt"),
        F.date_format(F.date_add(_d("o_orderdate"), 30), "yyyy-MM-dd").alias("fy_end_txt"))
    left = left.withColumns({"fy_begin": C.to_date_lenient("fy_begin_txt"),
                             "fy_end": C.to_date_lenient("fy_end_txt")})
    per = t.lineitem.select(
        C.zero_pad(F.col("l_orderkey").cast("string"), 6).alias("ccn"),
        F.when(F.col("l_linenumber") == 3, F.lit("")).otherwise(F.date_format("l_shipdate", "M/d/yyyy")).alias("s_txt"),
        F.date_format(F.date_add(_d("l_shipdate"), 15), "yyyy-MM-dd").alias("t_txt"))
    per = per.withColumns({"s": C.to_date_lenient("s_txt"), "t": C.to_date_lenient("t_txt")})
    res = IV.interval_overlap_flag(left, "ccn", "fy_begin", "fy_end", per, "ccn", "s", "t", out="enrolled")
    return res.select("ccn", "enrolled")


def q_recipe_enroll_name(spark, sf_dir):
    """Customers matched to suppliers by TF-IDF similarity of name + place text."""
    t = Tables(spark, sf_dir)
    left = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", TX.similarity_text("c_name", "n_name", "c_mktsegment").alias("text")))
    right = (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
             .select(TX.similarity_text("s_name", "n_name").alias("text")))
    m = S.tfidf_match(left, right, "text", "text", threshold=0.40)
    return m.select("c_custkey", r4("match_score").alias("match_score"), "match_flag")


# ---------------------------------------------------------------- R4

def q_recipe_enrich(spark, sf_dir):
    """Latest value per (entity, measure) pivoted wide, average-tie percentile per
    measure, left-joined to the entity table."""
    t = Tables(spark, sf_dir)
    wide = _latest_event_values(t.events)
    wide = R.pct_rank_columns(wide, "user_id", EVENT_TYPES, "_pctl")
    out = t.customer.join(wide, F.col("c_custkey") == F.col("user_id"), "left")
    cols = [r4(c).alias(c) for c in EVENT_TYPES] + [r4(f"{c}_pctl").alias(f"{c}_pctl") for c in EVENT_TYPES]
    return out.select("c_custkey", "c_nationkey", *cols)


# ---------------------------------------------------------------- R6 / R7

def _order_rows(t: Tables) -> DataFrame:
    li = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("ret"),
        F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice"))).alias("other"))
    o = (t.orders.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
         .join(t.customer.select("c_custkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey")))
    return o.withColumns({
        "b": _d("o_orderdate"), "e": F.date_add(_d("o_orderdate"), 90),
        "event": F.when(F.col("c_acctbal") < 0, F.lit("1999-01-01").cast("date")),
        "share": FN.share_with_fallback("ret", "other", F.lit(50.0)),
        "urgent": (F.col("o_orderpriority") == "1-URGENT").cast("int"),
        "y": F.year("o_orderdate")})


def _score_and_derive(df: DataFrame, price: str, share: str | None) -> DataFrame:
    metrics = {
        "Days_Cash_on_Hand": F.col(price) / 1000,
        "Current_Ratio": (F.col(share) * 10) if share else F.lit(None).cast("double"),
        "Debt_Ratio": (1 - F.col(share)) if share else F.lit(None).cast("double"),
        "Operating_Margin_Pct": (F.col(price) - 150000) / 1e6,
    }
    s = FN.solvency(metrics)
    d = FN.derived_financials(F.col(price), F.col(price) * 0.9,
                              F.col(share) if share else F.lit(None).cast("double"))
    return df.withColumns({**s, **d})


def q_recipe_baseline_avg(spark, sf_dir):
    """Rows before each entity's event (period classifier), per-entity means,
    mode, first value, year span and any-flag in one aggregate, then solvency and
    derived financials."""
    t = Tables(spark, sf_dir)
    rows = _order_rows(t)
    rows = rows.withColumn("row_type", TM.period_label("b", "e", "event"))
    rows = rows.where(F.col("row_type") == "CAH_Year")
    order = F.struct(F.col("b"), F.col("o_orderkey"))
    agg = rows.groupBy("o_custkey").agg(
        exact_mean("o_totalprice").alias("mean_price"), F.avg("share").alias("mean_share"),
        A.first_non_null("o_orderstatus", order).alias("first_status"),
        *A.year_span("y", "year_"), A.any_flag("urgent").alias("any_urgent"))
    mode = A.group_mode(rows, "o_custkey", "o_orderpriority", "top_priority")
    out = _score_and_derive(agg.join(mode, "o_custkey", "left"), "mean_price", "mean_share")
    return out.select(
        "o_custkey", r4("mean_price").alias("mean_price"), r4("mean_share").alias("mean_share"),
        "top_priority", "first_status", "year_count", "year_min", "year_max", "any_urgent",
        F.col("Solvency_Score").alias("score"), F.col("Solvency_Status").alias("status"),
        F.col("Solvency_Flags").alias("flags"), r4("Historical_Op_Income").alias("op_income"),
        r4("Historical_Op_Margin").alias("op_margin"), r4("IP_Revenue").alias("ip_revenue"),
        r4("OP_Revenue").alias("op_revenue"), F.col("Swing_Bed_Risk").alias("swing_risk"))


def q_recipe_baseline_recent(spark, sf_dir):
    """Per-column last non-NULL snapshot, metadata back-fill, solvency, derived."""
    t = Tables(spark, sf_dir)
    o = t.orders.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("date")).otherwise(_d("o_orderdate")).alias("d"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("v"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("p"))
    snap = D.last_non_null_snapshot(o, "o_custkey", ["v", "d", "p"], "d", ["o_orderkey"])
    meta = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    snap = M.backfill_left(snap, meta, "o_custkey")
    out = _score_and_derive(snap, "v", None)
    return out.select(
        "o_custkey", r4("v").alias("last_v"), F.col("d").alias("last_d"), F.col("p").alias("last_priority"),
        "c_mktsegment", F.col("Solvency_Score").alias("score"), F.col("Solvency_Status").alias("status"),
        F.col("Solvency_Flags").alias("flags"), r4("Historical_Op_Income").alias("op_income"),
        r4("IP_Revenue").alias("ip_revenue"), F.col("Swing_Bed_Risk").alias("swing_risk"))


# ---------------------------------------------------------------- R8

FINAL_COLUMNS = ["Pre-REH CCN", "Post-REH CCN", "Hospital Name", "State", "REH Conversion Date",
                 "Current Status", "Previous Medicare Payment Type"]


def conversion_list(base: DataFrame | None, extra: DataFrame | None) -> DataFrame | None:
    """R8 core: base list (upstream headers) harmonised and labelled; a second list
    with free headers harmonised by keyword rules fills base NULLs on normalised
    name + state. Fallbacks (J12): both missing or empty -> None; base missing or empty ->
    the second list with NULL ids. Base columns that are absent are NULL; the state may
    come as ENROLLMENT STATE."""
    base = None if base is None or base.isEmpty() else base
    extra = None if extra is None or extra.isEmpty() else extra
    if extra is not None:
        extra = P.normalize_headers(extra)
        extra = P.rename(extra, P.harmonize_headers(extra.columns))
        extra = P.drop_null_rows(extra, how="all")
    if base is None:
        if extra is None:
            return None
        out = extra.withColumns({"Post-REH CCN": F.lit(None).cast("long"), "Pre-REH CCN": F.lit(None).cast("long")})
        return P.canonical_order(out, FINAL_COLUMNS, {c: "string" for c in FINAL_COLUMNS}).select(*FINAL_COLUMNS) \
            .dropna(subset=["Hospital Name"])
    b = P.normalize_headers(base)

    def one_of(*names):
        return next((F.col(n) for n in names if n in b.columns), F.lit(None).cast("string"))

    b = b.select(
        C.to_long_id(one_of("CCN")).alias("Post-REH CCN"), C.to_long_id(one_of("CAH OR HOSPITAL CCN")).alias("Pre-REH CCN"),
        one_of("ORGANIZATION NAME").alias("Hospital Name"), one_of("STATE", "ENROLLMENT STATE").alias("State"),
        one_of("REH CONVERSION DATE").alias("REH Conversion Date"),
        FN.flag_label(one_of("REH CONVERSION FLAG")).alias("Previous Medicare Payment Type"),
        F.lit("Active").alias("Current Status"))
    b = b.dropna(subset=["Post-REH CCN"])
    if extra is not None and {"Hospital Name", "State"} <= set(extra.columns):
        fill = [c for c in ("Previous Medicare Payment Type", "Current Status", "REH Conversion Date")
                if c in extra.columns]
        right = extra.dropna(subset=["Hospital Name"])
        b = M.fill_from_right(
            b, right,
            [(TX.name_key("Hospital Name"), TX.name_key(right["Hospital Name"])),
             (F.upper(F.trim("State")), F.upper(F.trim(right["State"])))], fill)
    return b.select(*FINAL_COLUMNS).dropna(subset=["Hospital Name"])


def _conversion_inputs(t: Tables):
    sn = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    base = sn.select(
        F.col("s_suppkey").cast("string").alias("CCN "),
        F.when(F.col("s_suppkey") % 2 == 0, F.concat((F.col("s_suppkey") + 500000).cast("string"), F.lit(".0")))
        .alias("CAH OR HOSPITAL CCN"),
        F.col("s_name").alias("ORGANIZATION NAME"), F.col("n_name").alias("STATE"),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), (F.col("s_suppkey") % 365).cast("int")),
                                 "yyyy-MM-dd")).alias("REH CONVERSION DATE"),
        F.when(F.col("s_acctbal") > 5000, "Y").otherwise("N").alias("REH CONVERSION FLAG"))
    extra = sn.select(
        F.concat(F.upper("s_name"), F.lit(" Community Hospital")).alias(" Facility Name"),
        F.lower("n_name").alias("State "),
        F.date_format(F.date_add(F.lit("2022-06-01").cast("date"), (F.col("s_suppkey") % 200).cast("int")),
                      "yyyy-MM-dd").alias("Effective Date"),
        F.lit("CAH").alias("Prior Type"), F.lit("Closed").alias("Status"))
    return base, extra


def q_recipe_conversion_list(spark, sf_dir):
    base, extra = _conversion_inputs(Tables(spark, sf_dir))
    return conversion_list(base, extra)


# ---------------------------------------------------------------- R10

def q_recipe_quality(spark, sf_dir):
    """One-row quality report over the panel: summary counts, duplicate keys,
    key coverage against the entity table, bucketed order-to-ship differences."""
    t = Tables(spark, sf_dir)
    m = cut_lineage(panel(t))  # four summaries read it
    summary = Q.panel_summary(m, "k", "y", F.col("src") == "both")
    dups = D.duplicate_count(m, ["k", "y"])
    cov = M.key_coverage(m, t.customer, "k", "c_custkey")
    diff = (t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.datediff(_d("l_shipdate"), _d("o_orderdate")).alias("x")))
    buckets = Q.diff_buckets(F.col("x"), diff, 180).select("exact0", "within180", "beyond180")
    # every part is one row: attach them as scalar subqueries (no joins)
    parts = [dups, cov, buckets]
    structs = [p.select(F.struct("*").alias("s")).scalar() for p in parts]
    extra = [st[c].alias(c) for p, st in zip(parts, structs) for c in p.columns]
    out = summary.select("*", *extra)
    return out.select("rows", "distinct_ids", "min_year", "max_year", "null_ids", "flagged_rows", "flagged_ids",
                      "dups", "distinct_keys", "matched_keys", r4("coverage").alias("coverage"),
                      "exact0", "within180", "beyond180")

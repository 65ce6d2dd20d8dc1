"""R1 end to end from landed files: yearly CSV files whose headers differ, a second source, a list of
re-keyed entities, through stages with declared columns to the panel. Every stage is published
(``sources.snapshots``), so a run that stopped goes on with the stage it had not finished."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import coerce as C
from quarry.functions import finance as FN
from quarry.functions import temporal as TM
from quarry.operators import columns as P
from quarry.operators import dedupe as D
from quarry.operators import identity as ID
from quarry.operators import merge as M
from quarry.plans.bindings import r4
from quarry.plans.recipes_sql import r4 as sql_r4
from quarry.session import Tables, ensure_checkpoint_dir
from quarry.sources import readers as RD
from quarry.sources import snapshots as SN

# Headers of the landed files and the names they get.
REPORT_NAMES = {
    "Provider CCN": "CCN", "Hospital Name": "Hospital_Name", "CCN Facility Type": "Facility_Type", "State Code": "State", "Zip Code": "Zip",
    "Fiscal Year Begin Date": "FY_Begin", "Fiscal Year End Date": "FY_End", "Cash on Hand and in Banks": "CMS_Cash",
    "Total Current Assets": "CMS_Current_Assets", "Total Current Liabilities": "CMS_Current_Liabilities", "Total Assets": "CMS_Total_Assets",
    "Total Liabilities": "CMS_Total_Liabilities", "Less Total Operating Expense": "CMS_Operating_Expense",
    "Total Salaries From Worksheet A": "CMS_Total_Salaries", "Total Costs": "CMS_Total_Costs", "Outpatient Revenue": "CMS_Outpatient_Revenue",
    "Net Patient Revenue": "CMS_Net_Patient_Revenue", "Cost of Charity Care": "CMS_Charity_Care_Cost", "Total Discharges": "Total_Discharges",
    "Total Days": "Total_Patient_Days", "Medicare Days": "Medicare_Days", "Medicaid Days": "Medicaid_Days",
}
SECOND_NAMES = {
    "CCN#": "CCN", " Facility Type": "Facility_Type", "Hospital Name": "Hospital_Name", "Fiscal Year Beginning": "FY_Begin_NASHP",
    "Fiscal Year Ending": "FY_End_NASHP", "Net Patient Revenue": "NASHP_Net_Patient_Revenue", "Hospital Operating Costs": "NASHP_Hospital_Op_Costs",
    "Adjusted Patient Discharges": "Adjusted_Patient_Discharges", "Operating Profit Margin": "NASHP_Operating_Margin", "Net Profit Margin": "NASHP_Net_Profit_Margin",
}
CHANGES = {"Pre-REH CCN": "long", "Post-REH CCN": "long", "REH Conversion Date": "date", "Current Status": "string",
           "Previous Medicare Payment Type": "string", "No": "long"}
BOTH, FIRST, SECOND = "CMS + NASHP", "CMS only", "NASHP only"
FIRST_COLUMNS = ["CCN", "Hospital_Name", "State", "Zip", "Year", "FY_Begin_NASHP", "FY_End_NASHP", "FY_Begin_CMS", "FY_End_CMS", "Data_Source",
                 "Facility_Type", "Is_CAH", "Is_REH_Converter", "REH_Conversion_Date", "Post_REH_Months", "REH_Status", "Pre_REH_CCN", "Pre_REH_Payment_Type"]
RATIOS = [*FN.PERCENT_SPEC, *FN.RATIO_SPEC]

_KINDS = {"CCN": "long", "Hospital_Name": "string", "Facility_Type": "string", "State": "string", "Zip": "string", "FY_Begin": "date", "FY_End": "date",
          "FY_Begin_NASHP": "date", "FY_End_NASHP": "date"}
REPORT_KINDS = {n: _KINDS.get(n, "double") for n in REPORT_NAMES.values()}
SECOND_KINDS = {n: _KINDS.get(n, "double") for n in SECOND_NAMES.values()}


def _ddl(kinds: dict[str, str], **more: str) -> str:
    return ", ".join(f"`{n}` {'bigint' if k == 'long' else k}" for n, k in (kinds | more).items())


_MERGED = {"CCN": "long", "Year": "int", "Hospital_Name": "string", "State": "string", "Zip": "string", "FY_Begin_CMS": "date", "FY_End_CMS": "date",
           "FY_Begin_NASHP": "date", "FY_End_NASHP": "date", "Data_Source": "string", "Facility_Type": "string", "Is_CAH": "int"} | {r: "double" for r in RATIOS}
_FLAGGED = _MERGED | {"Is_REH_Converter": "int", "REH_Conversion_Date": "date", "REH_Status": "string", "Pre_REH_CCN": "long", "Pre_REH_Payment_Type": "string",
                      "Post_REH_Months": "double"}


def build_panel(spark: SparkSession, root: str, run: str, reports: dict[int, str], second: str, changes: str) -> DataFrame:
    """The panel of entities and years from landed files: ``reports`` (year -> folder of CSV files),
    ``second`` and ``changes`` (CSV files or folders). Stages are published under ``root`` as ``run``."""
    def at(name, build, kinds, **more):
        by = ["Year"] if name == "panel" else []
        return SN.stage(spark, root, name, run, build, _ddl(kinds, **more), by)

    def read_reports():
        df = P.drop_null_rows(RD.stack_yearly(spark, reports, REPORT_KINDS, REPORT_NAMES), ["CCN"])
        return df.withColumn("Year", TM.dominant_year("FY_Begin", "FY_End"))

    def read_second():
        kinds = {h: SECOND_KINDS[n] for h, n in SECOND_NAMES.items()}
        df = P.drop_null_rows(P.rename(RD.read_csv_by_name(spark, second, kinds), SECOND_NAMES), ["CCN"])
        return df.withColumn("Year", TM.dominant_year("FY_Begin_NASHP", "FY_End_NASHP"))

    def merge():
        one = at("reports", read_reports, REPORT_KINDS, Year="int")
        one = D.dedupe_longest(one, ["CCN", "Year"], "FY_Begin", "FY_End", [F.desc("CMS_Cash")])
        one = P.rename(one, {"FY_Begin": "FY_Begin_CMS", "FY_End": "FY_End_CMS", "Facility_Type": "Facility_Type_CMS"})
        two = P.rename(at("second", read_second, SECOND_KINDS, Year="int"), {"Facility_Type": "Facility_Type_NASHP"})
        df = M.nullsafe_full_outer(one, two, ["CCN", "Year"], ["Hospital_Name"], (BOTH, FIRST, SECOND), "Data_Source")
        df = df.withColumns({
            "Facility_Type": F.coalesce("Facility_Type_CMS", "Facility_Type_NASHP"),
            "Is_CAH": FN.or_flag(F.col("Facility_Type_CMS") == "CAH", F.col("Facility_Type_NASHP") == "Critical Access Hospitals")})
        return FN.derive_ratios(df)

    def flag():
        listed = RD.read_csv_by_name(spark, changes, CHANGES)
        attrs = {"REH Conversion Date": "REH_Conversion_Date", "Current Status": "REH_Status", "Previous Medicare Payment Type": "Pre_REH_Payment_Type"}
        listed = P.rename(listed, attrs)
        df = ID.apply_rekey(at("merged", merge, _MERGED), "CCN", listed, "Pre-REH CCN", "Post-REH CCN", list(attrs.values()), "No", "Is_REH_Converter", "Pre_REH_CCN")
        return df.withColumn("Post_REH_Months", TM.months_since("REH_Conversion_Date", F.coalesce("FY_End_NASHP", "FY_End_CMS"), "Is_REH_Converter"))

    def finish():
        df = at("flagged", flag, _FLAGGED).withColumn("Zip", C.clean_zip("Zip"))
        return P.canonical_order(df, FIRST_COLUMNS)

    return at("panel", finish, _FLAGGED)


def land(t: Tables, folder: str) -> tuple[dict[int, str], str, str]:
    """The test tables as landed CSV: a folder per year, in even years with all columns, in odd
    years in another order, with a column nobody maps and without one that is mapped."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    day, key, price = F.col("o_orderdate").cast("date"), F.col("o_orderkey"), F.col("o_totalprice")
    cells = [
        F.when(key % 97 != 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))), F.col("c_name"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "CAH").otherwise("STH"), F.col("n_name"),
        F.concat((F.col("o_custkey") % 99999).cast("string"), F.lit("-12")), F.date_format(day, "M/d/yyyy"),
        F.when(key % 31 != 0, F.date_format(F.date_add(day, (90 + key % 400).cast("int")), "yyyy-MM-dd")),
        price / 8, price * 2, F.when(key % 5 == 0, F.lit(0.0)).otherwise(price / 2), price * 4, F.when(key % 7 != 0, price * 3), price / 4, price / 16,
        price / 2, price / 32, price, price / 64, key % 50, key % 400, key % 90, key % 70]
    raw = o.select(F.year(day).alias("y"), *[c.cast("string").alias(h) for h, c in zip(REPORT_NAMES, cells)])
    years = sorted(r.y for r in t.orders.select(F.year("o_orderdate").alias("y")).distinct().collect())
    odd = raw.select("y", F.lit("x").alias("Report Record Number"), *reversed([c for c in raw.columns if c not in ("y", "Cost of Charity Care")]))
    for name, df, rest in (("even", raw, 0), ("odd", odd, 1)):
        df.where(F.col("y") % 2 == rest).write.partitionBy("y").option("header", True).csv(f"{folder}/{name}")
    reports = {y: f"{folder}/{'odd' if y % 2 else 'even'}/y={y}" for y in years}
    li = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    money = lambda c: F.sum(F.col(c).cast("decimal(38,4)")).cast("double")
    two = li.groupBy(F.col("o_custkey").alias("k"), F.year("l_shipdate").alias("y")).agg(
        money("l_extendedprice").alias("p"), money("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"))
    two = two.join(t.customer, F.col("k") == F.col("c_custkey"))
    cells = [F.col("k"), F.when(F.col("k") % 10 == 0, "Critical Access Hospitals").otherwise("Short Term"), F.upper("c_name"),
             F.concat(F.col("y").cast("string"), F.lit("-01-01")), F.concat(F.col("y").cast("string"), F.lit("-12-31")),
             F.col("p"), F.col("p") / 2, F.when(F.col("n") > 1, F.col("n")), F.col("n") / 64, F.col("q") / 1024]
    two.select(*[c.cast("string").alias(h) for h, c in zip(SECOND_NAMES, cells)]).write.option("header", True) \
        .option("ignoreLeadingWhiteSpace", False).csv(f"{folder}/second")  # a header begins with a blank
    k = F.col("c_custkey")
    day = F.date_add(F.lit("1996-01-01").cast("date"), (k % 500).cast("int"))
    changes = t.customer.where(k % 20 == 0).select(
        F.when(k % 140 != 0, k).alias("Pre-REH CCN"), F.when(k % 40 == 0, k + 1).alias("Post-REH CCN"),
        F.date_format(day, "MM/dd/yyyy").alias("REH Conversion Date"), F.when(k % 60 == 0, "Closed").otherwise("Active").alias("Current Status"),
        F.lit("CAH").alias("Previous Medicare Payment Type"), k.alias("No"))
    changes.write.option("header", True).csv(f"{folder}/changes")
    return reports, f"{folder}/second", f"{folder}/changes"


def q_recipe_panel_landed(spark, sf_dir):
    root = f"{ensure_checkpoint_dir(spark)}/landed-{uuid.uuid4().hex}"
    panel = build_panel(spark, root, "run", *land(Tables(spark, sf_dir), f"{root}/landing"))
    return panel.select(*[c for c in FIRST_COLUMNS], *[r4(c).alias(c) for c in RATIOS])


def _div(a: str, b: str, scale: str = "") -> str:
    return f"CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) END{scale}"


_RATIO_SQL = {
    "Operating_Margin_Pct": "om * 100", "Net_Profit_Margin_Pct": "nm * 100", "Current_Ratio": _div("ca", "cl"), "Debt_Ratio": _div("tl", "ta"),
    "Days_Cash_on_Hand": _div("cash", "oe / 365.0"), "Labor_Cost_Pct": f"({_div('sal', 'tc')}) * 100.0", "Rev_per_Discharge": _div("npr", "disch"),
    "Cost_per_Discharge": _div("tc", "disch"), "Outpatient_Rev_Pct": f"({_div('outp', 'npr')}) * 100.0", "Medicare_Pct_Days": f"({_div('md', 'days')}) * 100.0",
    "Medicaid_Pct_Days": f"({_div('cd', 'days')}) * 100.0", "Charity_Care_Pct_Revenue": f"({_div('cc', 'npr')}) * 100.0",
    "Rev_per_Adj_Discharge": _div("p", "adj"), "Cost_per_Adj_Discharge": _div("p / 2", "adj"),
}

SQL = {"recipe_panel_landed": f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS k, c_name, n_name, o_orderdate::DATE AS b,
    CASE WHEN o_orderkey % 31 <> 0 THEN o_orderdate::DATE + CAST(90 + o_orderkey % 400 AS INTEGER) END AS e,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'CAH' ELSE 'STH' END AS ft, lpad(CAST(o_custkey % 99999 AS VARCHAR), 5, '0') AS zip,
    o_totalprice / 8 AS cash, o_totalprice * 2 AS ca, CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE o_totalprice / 2 END AS cl, o_totalprice * 4 AS ta,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice * 3 END AS tl, o_totalprice / 4 AS oe, o_totalprice / 16 AS sal, o_totalprice / 2 AS tc,
    o_totalprice / 32 AS outp, o_totalprice AS npr, CASE WHEN year(o_orderdate) % 2 = 0 THEN o_totalprice / 64 END AS cc,
    (o_orderkey % 50)::DOUBLE AS disch, (o_orderkey % 400)::DOUBLE AS days, (o_orderkey % 90)::DOUBLE AS md, (o_orderkey % 70)::DOUBLE AS cd
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
 r AS (SELECT * FROM o WHERE k IS NOT NULL),
 d AS (SELECT o_orderkey, yr, date_diff('day', greatest(b, make_date(yr::INTEGER, 1, 1)), least(e, make_date(yr::INTEGER, 12, 31))) + 1 AS n
       FROM (SELECT *, unnest(range(year(b), year(e) + 1)) AS yr FROM r WHERE e IS NOT NULL)),
 y AS (SELECT o_orderkey, CAST(yr AS INTEGER) AS y FROM d QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY n DESC, yr) = 1),
 one AS (SELECT r.*, y FROM r LEFT JOIN y USING (o_orderkey)
         QUALIFY row_number() OVER (PARTITION BY k, y ORDER BY date_diff('day', b, e) DESC NULLS LAST, b DESC NULLS LAST, cash DESC) = 1),
 two AS (SELECT o_custkey AS k2, CAST(year(l_shipdate) AS INTEGER) AS y2, upper(any_value(c_name)) AS name2, sum(l_extendedprice::DECIMAL(38,4))::DOUBLE AS p,
     count(*)::DOUBLE / 64 AS om, sum(l_quantity::DECIMAL(38,4))::DOUBLE / 1024 AS nm, CASE WHEN count(*) > 1 THEN count(*)::DOUBLE END AS adj,
     CASE WHEN o_custkey % 10 = 0 THEN 'Critical Access Hospitals' ELSE 'Short Term' END AS ft2
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, o_custkey),
 m AS (SELECT coalesce(k, k2) AS "CCN", coalesce(y, y2) AS "Year", coalesce(c_name, name2) AS "Hospital_Name", n_name AS "State", zip AS "Zip",
     CASE WHEN k2 IS NOT NULL THEN make_date(y2, 1, 1) END AS "FY_Begin_NASHP", CASE WHEN k2 IS NOT NULL THEN make_date(y2, 12, 31) END AS "FY_End_NASHP",
     b AS "FY_Begin_CMS", e AS "FY_End_CMS", CASE WHEN k IS NULL THEN 'NASHP only' WHEN k2 IS NULL THEN 'CMS only' ELSE 'CMS + NASHP' END AS "Data_Source",
     coalesce(ft, ft2) AS "Facility_Type", CAST(coalesce(ft = 'CAH', false) OR coalesce(ft2 LIKE 'Critical%', false) AS INTEGER) AS "Is_CAH",
     {", ".join(f'{sql_r4(x)} AS "{n}"' for n, x in _RATIO_SQL.items())}
   FROM one FULL JOIN two ON k = k2 AND y IS NOT DISTINCT FROM y2),
 ch AS (SELECT CASE WHEN c_custkey % 140 <> 0 THEN c_custkey END AS pre, CASE WHEN c_custkey % 40 = 0 THEN c_custkey + 1 END AS post, c_custkey AS n,
     DATE '1996-01-01' + CAST(c_custkey % 500 AS INTEGER) AS ev, CASE WHEN c_custkey % 60 = 0 THEN 'Closed' ELSE 'Active' END AS st FROM customer WHERE c_custkey % 20 = 0),
 x AS (SELECT pre AS target, pre, ev, st, CASE WHEN post IS NULL THEN 0 ELSE 1 END AS phase, n, 0 AS step FROM ch WHERE pre IS NOT NULL
       UNION ALL SELECT post, pre, ev, st, 1, n, 1 FROM ch WHERE pre IS NOT NULL AND post IS NOT NULL),
 f AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY target ORDER BY phase DESC, n DESC, step DESC) = 1)
SELECT m.*, CASE WHEN target IS NULL THEN 0 ELSE 1 END AS "Is_REH_Converter", ev AS "REH_Conversion_Date",
  CASE WHEN target IS NOT NULL AND coalesce("FY_End_NASHP", "FY_End_CMS") IS NOT NULL THEN round_even(greatest(date_diff('day', ev, coalesce("FY_End_NASHP", "FY_End_CMS")) / 30.44, 0.0), 1) END AS "Post_REH_Months",
  st AS "REH_Status", pre AS "Pre_REH_CCN", CASE WHEN target IS NOT NULL THEN 'CAH' END AS "Pre_REH_Payment_Type"
FROM m LEFT JOIN f ON "CCN" = target
"""}

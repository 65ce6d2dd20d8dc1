"""SQL oracles for the R9 reports (DuckDB)."""

from __future__ import annotations


def r4(x: str) -> str:
    return f"(floor(({x}) * 10000 + 0.5) / 10000)"


PANEL = """
  WITH li AS (SELECT l_orderkey, count(*) AS lines,
                     sum(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS funding FROM lineitem GROUP BY 1),
  p AS (SELECT o_custkey AS id, o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "Year", n_name AS "State",
     CASE WHEN trim(o_orderpriority) = '1-URGENT' THEN 'URG' WHEN trim(o_orderpriority) = '2-HIGH' THEN 'HIGH'
          WHEN trim(o_orderpriority) = '3-MEDIUM' THEN 'MED' ELSE 'Other' END AS "FType",
     c_mktsegment AS "Segment", CASE WHEN c_acctbal < 5000 THEN 'R' ELSE 'U' END AS "RU",
     o_totalprice / 1000 AS margin, CASE WHEN lines <> 0 THEN o_totalprice / lines END AS cost,
     CAST(o_orderstatus = 'F' AS INTEGER) AS flag, coalesce(funding, 0.0) AS funding,
     o_orderstatus, o_orderdate::DATE AS odate
   FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
   LEFT JOIN li ON o_orderkey = l_orderkey)
"""


def _wide(index: str, col: str, val: str, values) -> str:
    cols = ", ".join(f'{r4(f"max({val}) FILTER (WHERE {col} = {v!r})")} AS "{v}"' for v in values)
    return f'SELECT "{index}", {cols} FROM long GROUP BY "{index}"'


SQL = {}

SQL["report_q1"] = PANEL + """, long AS (SELECT "Year", "FType", median(margin) AS m FROM p GROUP BY 1, 2)
""" + _wide("Year", '"FType"', "m", ["URG", "HIGH", "MED", "Other"])

SQL["report_q2"] = PANEL + f""", l AS (SELECT * FROM p WHERE "Year" = (SELECT max("Year") FROM p)),
 per AS (SELECT "State", median(margin) AS med FROM l GROUP BY 1),
 t AS (SELECT 'top' AS section, CAST(row_number() OVER (ORDER BY med DESC, "State" DESC) AS INTEGER) AS pos,
              "State", med FROM per WHERE med IS NOT NULL ORDER BY med DESC, "State" DESC LIMIT 15),
 b AS (SELECT 'bottom' AS section, CAST(row_number() OVER (ORDER BY med, "State") + 16 AS INTEGER) AS pos,
              "State", med FROM per WHERE med IS NOT NULL ORDER BY med, "State" LIMIT 15)
SELECT section, pos, "State", {r4("med")} AS "Median_Margin" FROM t
UNION ALL SELECT 'divider', 16, '---', NULL
UNION ALL SELECT section, pos, "State", {r4("med")} FROM b
"""

SQL["report_q3"] = PANEL + """, f AS (SELECT * FROM p WHERE o_orderstatus = 'P'
   QUALIFY row_number() OVER (PARTITION BY id ORDER BY odate, o_orderkey) = 1)
SELECT CAST(year(odate) AS INTEGER) AS "Conv_Year",
""" + ",\n".join(f"  count(*) FILTER (WHERE \"Segment\" = '{s}') AS \"{s}\""
                 for s in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + """
FROM f WHERE odate IS NOT NULL AND "Segment" IS NOT NULL GROUP BY 1
"""

SQL["report_q4"] = PANEL + f"""
SELECT "Segment", {r4("median(margin)")} AS "Median_Margin", {r4("median(cost)")} AS "Median_Cost",
  {r4("median(funding)")} AS "Median_Funding", {r4("median(flag * 100)")} AS "Median_Flag_Pct",
  count(DISTINCT id) AS "Entity_Count"
FROM p WHERE "Segment" IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') GROUP BY 1
"""

SQL["report_q5"] = PANEL + """, long AS (SELECT "Year", "RU", median(margin) AS m FROM p WHERE "RU" IN ('R', 'U')
  GROUP BY 1, 2)
""" + _wide("Year", '"RU"', "m", ["R", "U"])

SQL["report_q6"] = PANEL + f"""
SELECT "Year", {r4("median(flag * 100)")} AS "Flag_Pct",
  {r4("median(CASE WHEN margin * 1000 <> 0 THEN funding / (margin * 1000) END)")} AS "Funding_Share"
FROM p GROUP BY 1
"""

SQL["report_q7"] = PANEL + """, long AS (SELECT "Year", "FType", median(margin) AS m FROM p
  WHERE "FType" IN ('URG', 'HIGH') GROUP BY 1, 2)
""" + _wide("Year", '"FType"', "m", ["URG", "HIGH"])

SQL["report_q8"] = PANEL + f""", l AS (SELECT * FROM p WHERE "Year" = (SELECT max("Year") FROM p)),
 per AS (SELECT "State", count(DISTINCT id) AS "Total", count(*) FILTER (WHERE flag = 1) AS "Flagged" FROM l GROUP BY 1)
SELECT "State", "Total", "Flagged", {r4('"Flagged" / "Total"')} AS "Rate" FROM per
ORDER BY "Flagged" / "Total" DESC, "State" LIMIT 20
"""

SQL["report_q9"] = PANEL + f"""
SELECT "Year", round(coalesce(sum(funding), 0.0), 2) AS "Total_Funding", {r4("median(margin)")} AS "Median_Margin",
  count(*) FILTER (WHERE funding > 0) AS "With_Funding"
FROM p WHERE "Year" BETWEEN 1996 AND 2000 GROUP BY 1
"""

SQL["report_q10"] = PANEL + """, long AS (SELECT "Year", "FType", median(cost) AS m FROM p
  WHERE "FType" IN ('URG', 'HIGH', 'MED') GROUP BY 1, 2)
""" + _wide("Year", '"FType"', "m", ["URG", "HIGH", "MED"])

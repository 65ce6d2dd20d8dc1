"""SQL oracles for the recipes (DuckDB)."""

from __future__ import annotations

from quarry.plans.oracle import _norm, _sim_text, _tfidf


def r4(x: str) -> str:
    return f"(floor(({x}) * 10000 + 0.5) / 10000)"


def pad6(x: str) -> str:
    return f"(CASE WHEN length({x}) >= 6 THEN {x} ELSE lpad({x}, 6, '0') END)"


_NOISE_SUBS = ["hospital", "medical", "center", "health", "regional", "rural",
               "emergency", "community", "general", "memorial", "critical", "access"]


def name_key(x: str) -> str:
    s = f"regexp_replace(lower(coalesce(CAST({x} AS VARCHAR), '')), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')"
    for w in _NOISE_SUBS:
        s = f"replace({s}, '{w}', ' ')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


PANEL = """
 r AS (SELECT o_orderkey, o_custkey AS k, o_totalprice, o_orderdate::DATE AS b,
              o_orderdate::DATE + CAST(90 + o_orderkey % 400 AS INTEGER) AS e FROM orders),
 yy AS (SELECT *, unnest(range(year(b), year(e) + 1)) AS yr FROM r),
 nd AS (SELECT *, date_diff('day', greatest(b, make_date(yr::INTEGER, 1, 1)), least(e, make_date(yr::INTEGER, 12, 31))) + 1
          AS days FROM yy),
 dy AS (SELECT o_orderkey, k, o_totalprice, b, e, CAST(yr AS INTEGER) AS y FROM nd
        QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY days DESC, yr) = 1),
 s1 AS (SELECT k, y, o_totalprice FROM dy
        QUALIFY row_number() OVER (PARTITION BY k, y ORDER BY date_diff('day', b, e) DESC NULLS LAST,
                                   b DESC NULLS LAST, o_orderkey) = 1),
 s2 AS (SELECT o_custkey AS k, CAST(year(l_shipdate) AS INTEGER) AS y, round(sum(l_extendedprice), 2) AS ship_total,
               count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
 m AS (SELECT coalesce(s1.k, s2.k) AS k, coalesce(s1.y, s2.y) AS y, o_totalprice, ship_total, lines,
         CASE WHEN s1.k IS NOT NULL AND s2.k IS NOT NULL THEN 'both' WHEN s1.k IS NOT NULL THEN 'left only'
              ELSE 'right only' END AS src,
         CASE WHEN lines <> 0 THEN ship_total / lines END AS avg_line,
         CASE WHEN ship_total <> 0 THEN o_totalprice / ship_total END AS order_to_ship
       FROM s1 FULL JOIN s2 ON s1.k = s2.k AND s1.y IS NOT DISTINCT FROM s2.y)
"""

SQL: dict[str, str] = {}

SQL["recipe_panel"] = f"""
WITH {PANEL},
 cr AS (SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey),
 lk AS (SELECT user_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1)
SELECT m.k, m.y, {r4("o_totalprice")} AS o_totalprice, ship_total, lines, src, {r4("avg_line")} AS avg_line,
       {r4("order_to_ship")} AS order_to_ship, {r4("lk.value")} AS latest_value
FROM m JOIN cr ON m.k = cr.c_custkey LEFT JOIN lk ON m.k = lk.user_id
WHERE r_name IN ('AMERICA', 'EUROPE')
"""

SQL["recipe_enroll_interval"] = f"""
SELECT {pad6("CAST(o_orderkey AS VARCHAR)")} AS ccn,
  CAST(EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND
   (l_linenumber = 3 OR (l_shipdate::DATE + 15 >= o_orderdate::DATE
     AND l_shipdate::DATE <= o_orderdate::DATE + 30))) AS INTEGER) AS enrolled
FROM orders
"""

SQL["recipe_enroll_name"] = f"""
WITH lsrc AS (SELECT c_custkey, {_sim_text("c_name || ' ' || n_name || ' ' || c_mktsegment")} AS t
              FROM customer JOIN nation ON c_nationkey = n_nationkey),
 rsrc AS (SELECT {_sim_text("s_name || ' ' || n_name")} AS t FROM supplier JOIN nation ON s_nationkey = n_nationkey),
 {_tfidf("lsrc", "rsrc")},
 best AS (SELECT lt, max(score) AS s FROM pairs GROUP BY lt)
SELECT c_custkey, CASE WHEN s >= 0.4 - 1e-9 THEN {r4("s")} END AS match_score,
       CASE WHEN s >= 0.4 - 1e-9 THEN 1 ELSE 0 END AS match_flag
FROM lsrc LEFT JOIN best ON lsrc.t = best.lt
"""

_TYPES = ["click", "error", "purchase", "signup", "view"]


def _pctl(c: str) -> str:
    return (f"CASE WHEN {c} IS NOT NULL THEN (rank() OVER (ORDER BY {c} NULLS LAST) - 1 "
            f"+ (count(*) OVER (PARTITION BY {c}) + 1) / 2.0) / count({c}) OVER () * 100 END")


SQL["recipe_enrich"] = f"""
WITH l AS (SELECT user_id, event_type, value FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1),
 w AS (SELECT user_id, {", ".join(f"max(value) FILTER (WHERE event_type = '{c}') AS {c}" for c in _TYPES)}
       FROM l GROUP BY user_id),
 p AS (SELECT *, {", ".join(f"{_pctl(c)} AS {c}_pctl" for c in _TYPES)} FROM w)
SELECT c_custkey, c_nationkey, {", ".join(f"{r4(c)} AS {c}" for c in _TYPES)},
       {", ".join(f"{r4(c + '_pctl')} AS {c}_pctl" for c in _TYPES)}
FROM customer LEFT JOIN p ON c_custkey = user_id
"""

_ORDER_ROWS = """
 li AS (SELECT l_orderkey, sum(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS ret,
               sum(l_extendedprice) FILTER (WHERE l_returnflag <> 'R') AS other FROM lineitem GROUP BY 1),
 o AS (SELECT o.*, c_acctbal, o_orderdate::DATE AS b, o_orderdate::DATE + 90 AS e,
              CASE WHEN c_acctbal < 0 THEN DATE '1999-01-01' END AS event,
              least(greatest(CASE WHEN ret IS NOT NULL AND other IS NOT NULL AND coalesce(ret, 0) + coalesce(other, 0) > 0
                   THEN ret / (coalesce(ret, 0) + coalesce(other, 0)) ELSE 50.0 / 100 END, 0.0), 1.0) AS share,
              CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS urgent, CAST(year(o_orderdate) AS INTEGER) AS y
       FROM orders o LEFT JOIN li ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey)
"""


def _solvency(dcoh: str, cr: str, dr: str, om: str) -> str:
    score = (f"(CASE WHEN {dcoh} IS NULL THEN 0 WHEN {dcoh} < 30 THEN 2 WHEN {dcoh} < 90 THEN 1 ELSE 0 END"
             f" + CASE WHEN {cr} IS NULL THEN 0 WHEN {cr} < 1.0 THEN 2 WHEN {cr} < 2.0 THEN 1 ELSE 0 END"
             f" + CASE WHEN {dr} IS NULL THEN 0 WHEN {dr} > 0.7 THEN 2 WHEN {dr} > 0.5 THEN 1 ELSE 0 END"
             f" + CASE WHEN {om} IS NULL THEN 0 WHEN {om} < -0.10 THEN 2 WHEN {om} < 0 THEN 1 ELSE 0 END)")
    flags = (f"concat_ws(', ', CASE WHEN {dcoh} < 30 THEN 'DCOH<30' WHEN {dcoh} < 90 THEN 'DCOH<90' END,"
             f" CASE WHEN {cr} < 1.0 THEN 'CR<1.0' WHEN {cr} < 2.0 THEN 'CR<2.0' END,"
             f" CASE WHEN {dr} > 0.7 THEN 'DR>0.7' WHEN {dr} > 0.5 THEN 'DR>0.5' END,"
             f" CASE WHEN {om} < -0.10 THEN 'OM<-10%' WHEN {om} < 0 THEN 'OM<0%' END)")
    return (f"CAST({score} AS INTEGER) AS score, CASE WHEN {score} >= 4 THEN 'Distressed' WHEN {score} >= 2 "
            f"THEN 'Marginal' ELSE 'Stable' END AS status, CASE WHEN {flags} = '' THEN 'None' ELSE {flags} END AS flags")


SQL["recipe_baseline_avg"] = f"""
WITH {_ORDER_ROWS},
 rows AS (SELECT * FROM o WHERE CASE WHEN event IS NULL THEN 'CAH_Year' WHEN b >= event THEN 'REH_Year'
                                     WHEN e <= event THEN 'CAH_Year' ELSE 'Transition' END = 'CAH_Year'),
 fs AS (SELECT o_custkey, o_orderstatus AS first_status FROM rows WHERE o_orderstatus IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY b, o_orderkey) = 1),
 md AS (SELECT o_custkey, o_orderpriority AS top_priority FROM
         (SELECT o_custkey, o_orderpriority, count(*) AS c FROM rows WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY c DESC, o_orderpriority) = 1),
 a AS (SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(o_totalprice) AS mean_price,
              avg(share) AS mean_share, count(y) AS year_count, min(y) AS year_min, max(y) AS year_max,
              coalesce(CAST(avg(urgent) > 0 AS INTEGER), 0) AS any_urgent FROM rows GROUP BY o_custkey)
SELECT a.o_custkey, {r4("mean_price")} AS mean_price, {r4("mean_share")} AS mean_share, top_priority, first_status,
  year_count, year_min, year_max, any_urgent,
  {_solvency("mean_price / 1000", "mean_share * 10", "1 - mean_share", "(mean_price - 150000) / 1e6")},
  {r4("mean_price - mean_price * 0.9")} AS op_income,
  {r4("CASE WHEN mean_price > 0 THEN (mean_price - mean_price * 0.9) / mean_price END")} AS op_margin,
  {r4("mean_price * (1 - coalesce(mean_share, 0.5))")} AS ip_revenue,
  {r4("mean_price * coalesce(mean_share, 0.5)")} AS op_revenue,
  (1 - coalesce(mean_share, 0.5)) > 0.25 AS swing_risk
FROM a LEFT JOIN md USING (o_custkey) LEFT JOIN fs USING (o_custkey)
"""

SQL["recipe_baseline_recent"] = f"""
WITH o AS (SELECT o_orderkey, o_custkey,
             CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate::DATE END AS d,
             CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS v,
             CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders),
 lv AS (SELECT o_custkey, v FROM o WHERE v IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (d IS NULL) DESC, d DESC, o_orderkey DESC) = 1),
 ld AS (SELECT o_custkey, d FROM o WHERE d IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC, o_orderkey DESC) = 1),
 lp AS (SELECT o_custkey, p FROM o WHERE p IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (d IS NULL) DESC, d DESC, o_orderkey DESC) = 1),
 k AS (SELECT DISTINCT o_custkey FROM o),
 s AS (SELECT k.o_custkey, lv.v, ld.d, lp.p FROM k LEFT JOIN lv USING (o_custkey) LEFT JOIN ld USING (o_custkey)
       LEFT JOIN lp USING (o_custkey))
SELECT s.o_custkey, {r4("v")} AS last_v, d AS last_d, p AS last_priority, c_mktsegment,
  {_solvency("v / 1000", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "(v - 150000) / 1e6")},
  {r4("v - v * 0.9")} AS op_income, {r4("v * (1 - 0.5)")} AS ip_revenue, (1 - 0.5) > 0.25 AS swing_risk
FROM s LEFT JOIN customer ON s.o_custkey = c_custkey
"""

SQL["recipe_conversion_list"] = f"""
WITH sn AS (SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey),
 base AS (SELECT s_suppkey AS "Post-REH CCN",
            CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey + 500000 END AS "Pre-REH CCN",
            s_name AS "Hospital Name", n_name AS "State",
            CASE WHEN s_suppkey % 3 = 0 THEN NULL
                 ELSE strftime(DATE '2023-01-01' + CAST(s_suppkey % 365 AS INTEGER), '%Y-%m-%d') END AS conv_date,
            CASE WHEN s_acctbal > 5000 THEN 'CAH' ELSE 'Short-Term Hospital' END AS pay_type,
            'Active' AS status FROM sn),
 extra AS (SELECT upper(s_name) || ' Community Hospital' AS name, lower(n_name) AS st,
            strftime(DATE '2022-06-01' + CAST(s_suppkey % 200 AS INTEGER), '%Y-%m-%d') AS eff,
            'CAH' AS prior_type, 'Closed' AS cur_status FROM sn)
SELECT "Pre-REH CCN", "Post-REH CCN", "Hospital Name", "State",
  coalesce(conv_date, eff) AS "REH Conversion Date", coalesce(status, cur_status) AS "Current Status",
  coalesce(pay_type, prior_type) AS "Previous Medicare Payment Type"
FROM base LEFT JOIN extra ON {name_key('base."Hospital Name"')} = {name_key("extra.name")}
  AND upper(trim(base."State")) = upper(trim(extra.st)) AND extra.name IS NOT NULL
WHERE "Hospital Name" IS NOT NULL
"""

SQL["recipe_quality"] = f"""
WITH {PANEL},
 summ AS (SELECT count(*) AS rows, count(DISTINCT k) AS distinct_ids, min(y) AS min_year, max(y) AS max_year,
            count(*) FILTER (WHERE k IS NULL) AS null_ids, count(*) FILTER (WHERE src = 'both') AS flagged_rows,
            count(DISTINCT CASE WHEN src = 'both' THEN k END) AS flagged_ids FROM m),
 dups AS (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS dups FROM (SELECT count(*) AS n FROM m GROUP BY k, y)),
 lk AS (SELECT DISTINCT k FROM m WHERE k IS NOT NULL),
 rk AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey IS NOT NULL),
 cov AS (SELECT count(*) AS distinct_keys, CAST(count(rk.k) AS BIGINT) AS matched_keys,
                CASE WHEN count(*) > 0 THEN count(rk.k) / count(*) ELSE 0.0 END AS coverage
         FROM lk LEFT JOIN rk ON lk.k = rk.k),
 d AS (SELECT date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS x FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 bk AS (SELECT count(*) FILTER (abs(x) = 0) AS exact0, count(*) FILTER (abs(x) BETWEEN 1 AND 180) AS within180,
               count(*) FILTER (abs(x) > 180) AS beyond180 FROM d)
SELECT rows, distinct_ids, min_year, max_year, null_ids, flagged_rows, flagged_ids, dups, distinct_keys,
       matched_keys, {r4("coverage")} AS coverage, exact0, within180, beyond180
FROM summ, dups, cov, bk
"""

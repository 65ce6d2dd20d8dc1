"""Independent SQL (DuckDB dialect) for each driver binding in ``bindings``.

The tables are pre-registered views. Same column names and rounding as the Spark
side; DuckDB ``round_even`` is used where the Spark side rounds half-even.
"""

from __future__ import annotations

# ---------------------------------------------------------------- shared fragments

_NULLED_ORDERS = """
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate::DATE END AS d,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS v,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders
"""

_ORDERS_NATION = """
  SELECT o.*, n_name FROM orders o JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
"""

_SHIP_DIFF = """
  SELECT date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS x
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

# char_wb 3-4-grams of a normalised text column t (one row per gram occurrence)
def _grams(src: str, key: str) -> str:
    return f"""
  SELECT {key}, g AS gram FROM (
    SELECT {key}, unnest(list_concat(
      list_transform(range(1, length(w) - 1), lambda i: substr(w, i, 3)),
      CASE WHEN length(w) >= 4 THEN list_transform(range(1, length(w) - 2), lambda i: substr(w, i, 4))
           ELSE []::VARCHAR[] END)) AS g
    FROM (SELECT {key}, ' ' || unnest(string_split_regex(t, '\\s+')) || ' ' AS w FROM {src})
    WHERE length(w) > 2)
"""


def _norm(expr: str) -> str:
    s = f"lower(coalesce(CAST({expr} AS VARCHAR), ''))"
    s = f"regexp_replace({s}, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')"
    s = f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"
    return s


def _sim_text(expr: str) -> str:
    return ("trim(regexp_replace(" + _norm(expr) +
            ", '\\b(hospital|center|medical|health|system|regional|community)\\b', '', 'g'))")


def _tfidf(left_src: str, right_src: str, tag: str = "") -> str:
    """CTEs with text column t, left_src and right_src, must be defined by the caller; produces CTE
    'pairs'(lt, rt, score) over all text pairs. All names made here end in ``tag``."""
    return f"""
  docs{tag} AS (SELECT 'L' AS side, t, count(*) AS mult FROM {left_src} GROUP BY t
           UNION ALL SELECT 'R', t, count(*) FROM {right_src} GROUP BY t),
  ndocs{tag} AS (SELECT sum(mult) AS n FROM docs{tag}),
  dg{tag} AS ({_grams(f"docs{tag}", "side, t, mult")}),
  tf{tag} AS (SELECT side, t, gram, count(*) AS tf, any_value(mult) AS mult FROM dg{tag} GROUP BY side, t, gram),
  dfreq{tag} AS (SELECT gram, sum(mult) AS df FROM tf{tag} GROUP BY gram),
  w{tag} AS (SELECT side, t, gram, tf * (ln((1 + n) / (1 + df)) + 1) AS w
        FROM tf{tag} JOIN dfreq{tag} USING (gram), ndocs{tag}),
  nw{tag} AS (SELECT side, t, gram, w / sqrt(sum(w * w) OVER (PARTITION BY side, t)) AS w FROM w{tag}),
  pairs{tag} AS (SELECT l.t AS lt, r.t AS rt, sum(l.w * r.w) AS score
            FROM nw{tag} l JOIN nw{tag} r ON l.gram = r.gram AND l.side = 'L' AND r.side = 'R'
            GROUP BY l.t, r.t)
"""


def _dense_cos(a: str, b: str) -> str:
    def dot(x, y):
        return f"list_reduce(list_transform(range(1, len({x}) + 1), lambda i: {x}[i]::DOUBLE * {y}[i]::DOUBLE), lambda p, q: p + q)"
    return f"({dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)})))"


SQL: dict[str, str] = {}

SQL["dominant_year"] = """
WITH r AS (SELECT o_orderkey, o_orderdate::DATE AS b,
             o_orderdate::DATE + CAST(90 + o_orderkey % 400 AS INTEGER) AS e FROM orders),
 y AS (SELECT o_orderkey, b, e, unnest(range(year(b), year(e) + 1)) AS yr FROM r),
 n AS (SELECT o_orderkey, yr, date_diff('day', greatest(b, make_date(yr::INTEGER, 1, 1)),
             least(e, make_date(yr::INTEGER, 12, 31))) + 1 AS days FROM y)
SELECT o_orderkey, CAST(yr AS INTEGER) AS dominant_year FROM n
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY days DESC, yr) = 1
"""

SQL["dedupe_longest"] = """
SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS ship_year, l_orderkey, l_linenumber, l_quantity,
       l_shipdate::DATE AS l_shipdate
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey, year(l_shipdate)
  ORDER BY l_quantity DESC NULLS LAST, l_shipdate DESC NULLS LAST, l_orderkey, l_linenumber, l_suppkey,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1
"""

SQL["latest_per_key"] = """
SELECT o_custkey, o_orderkey, o_orderdate::DATE AS o_orderdate, (floor((o_totalprice) * 10000 + 0.5) / 10000) AS o_totalprice
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""

SQL["first_per_key"] = """
SELECT user_id, event_id, ts::DATE AS day, event_type, (floor((value) * 10000 + 0.5) / 10000) AS value
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
"""

SQL["dup_count"] = """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS dups FROM
  (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
"""

_CUST_YEAR = """
 a AS (SELECT o_custkey AS k, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS y,
             round(sum(o_totalprice), 2) AS ov FROM orders GROUP BY 1, 2),
 b AS (SELECT o_custkey AS k, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(year(l_shipdate) AS INTEGER) END AS y,
             round(sum(l_extendedprice), 2) AS sv FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             GROUP BY 1, 2)
"""

SQL["nullsafe_full_outer"] = f"""
WITH {_CUST_YEAR}
SELECT coalesce(a.k, b.k) AS k, coalesce(a.y, b.y) AS y, ov, sv,
  CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both'
       WHEN a.k IS NOT NULL THEN 'left only' ELSE 'right only' END AS src
FROM a FULL JOIN b ON a.k = b.k AND a.y IS NOT DISTINCT FROM b.y
"""

SQL["lookup_left"] = """
SELECT CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 6 THEN CAST(c_custkey AS VARCHAR)
            ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS cust_id,
       c_nationkey, r.n_regionkey
FROM customer c
JOIN (SELECT n_nationkey AS nk, lower(n_name) AS cust_nation FROM nation) cn ON c.c_nationkey = cn.nk
LEFT JOIN (SELECT n_nationkey, ' ' || upper(n_name) || ' ' AS n_label, n_regionkey FROM nation) r
  ON c.c_nationkey = r.n_nationkey AND lower(trim(cn.cust_nation)) = lower(trim(r.n_label))
"""

SQL["lookup_update"] = """
WITH ch AS (SELECT n_nationkey AS old_key,
                   CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey + 25 END AS new_key,
                   n_name, n_regionkey, n_nationkey AS ord FROM nation),
 ex AS (SELECT old_key AS target, n_name, n_regionkey, old_key AS old_id, 0 AS phase, ord, 0 AS step
          FROM ch WHERE old_key IS NOT NULL AND new_key IS NULL
        UNION ALL
        SELECT old_key, n_name, n_regionkey, old_key, 1, ord, 0 FROM ch
          WHERE old_key IS NOT NULL AND new_key IS NOT NULL
        UNION ALL
        SELECT new_key, n_name, n_regionkey, old_key, 1, ord, 1 FROM ch
          WHERE old_key IS NOT NULL AND new_key IS NOT NULL),
 best AS (SELECT * FROM ex QUALIFY row_number() OVER (PARTITION BY target
            ORDER BY phase DESC, ord DESC, step DESC) = 1),
 cust AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 1 THEN c_nationkey + 25 ELSE c_nationkey END AS c_key
          FROM customer)
SELECT c_custkey, c_key, n_name, n_regionkey,
       CASE WHEN target IS NOT NULL THEN 1 ELSE 0 END AS is_rekeyed, old_id
FROM cust LEFT JOIN best ON c_key = target
"""

SQL["interval_overlap"] = """
SELECT o_orderkey, CAST(EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND
   (l_linenumber = 3 OR (l_shipdate::DATE + 15 >= o_orderdate::DATE
     AND l_shipdate::DATE <= o_orderdate::DATE + 30))) AS INTEGER) AS flag FROM orders
"""

SQL["key_coverage"] = """
WITH lk AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderkey IS NOT NULL),
 rk AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey IS NOT NULL)
SELECT count(*) AS distinct_keys, CAST(count(rk.k) AS BIGINT) AS matched_keys,
       (floor((count(rk.k) / count(*)) * 10000 + 0.5) / 10000) AS coverage
FROM lk LEFT JOIN rk ON lk.k = rk.k
"""

SQL["tfidf_match"] = f"""
WITH lsrc AS (SELECT name, {_sim_text("name")} AS t FROM (SELECT DISTINCT p_name AS name FROM part)),
 rsrc AS (SELECT {_sim_text("entity")} AS t FROM (SELECT DISTINCT p_brand || ' ' || p_name AS entity FROM part)),
 {_tfidf("lsrc", "rsrc")},
 best AS (SELECT lt, max(score) AS s FROM pairs GROUP BY lt)
SELECT name AS p_name, CASE WHEN s >= 0.4 - 1e-9 THEN (floor((s) * 10000 + 0.5) / 10000) END AS match_score,
       CASE WHEN s >= 0.4 - 1e-9 THEN 1 ELSE 0 END AS match_flag
FROM lsrc LEFT JOIN best ON lsrc.t = best.lt
"""

SQL["embed_rerank"] = f"""
WITH e AS (SELECT vec_id, embedding, {_sim_text("'group ' || CAST(label AS VARCHAR) || ' part ' || CAST(vec_id % 7 AS VARCHAR)")} AS t FROM embeddings),
 lsrc AS (SELECT * FROM e WHERE vec_id % 5 = 0),
 rsrc AS (SELECT * FROM e WHERE vec_id % 5 <> 0),
 {_tfidf("lsrc", "rsrc")},
 cand AS (SELECT l.vec_id AS lid, r.vec_id AS rid, round(coalesce(p.score, 0), 9) AS s
          FROM lsrc l, rsrc r LEFT JOIN pairs p ON p.lt = l.t AND p.rt = r.t),
 top AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY lid ORDER BY s DESC, rid) <= 10),
 dense AS (SELECT lid, max({_dense_cos("l.embedding", "r.embedding")}) AS d
           FROM top JOIN lsrc l ON l.vec_id = lid JOIN rsrc r ON r.vec_id = rid GROUP BY lid)
SELECT l.vec_id, (floor((d) * 10000 + 0.5) / 10000) AS rerank_score, CASE WHEN d >= 0.82 THEN 1 ELSE 0 END AS rerank_flag
FROM lsrc l LEFT JOIN dense ON l.vec_id = dense.lid
"""

SQL["pct_rank_avg"] = """
SELECT p_partkey, (floor(((rank() OVER (ORDER BY p_size)
       + (count(*) OVER (PARTITION BY p_size) - 1) / 2.0)
       / count(*) OVER () * 100) * 10000 + 0.5) / 10000) AS pctl FROM part
"""

_LATEST_EVENTS = """
  SELECT user_id, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
"""

SQL["pivot_latest"] = f"""
WITH l AS ({_LATEST_EVENTS})
SELECT user_id,
  (floor((max(value) FILTER (WHERE event_type = 'click')) * 10000 + 0.5) / 10000) AS click,
  (floor((max(value) FILTER (WHERE event_type = 'error')) * 10000 + 0.5) / 10000) AS error,
  (floor((max(value) FILTER (WHERE event_type = 'purchase')) * 10000 + 0.5) / 10000) AS purchase,
  (floor((max(value) FILTER (WHERE event_type = 'signup')) * 10000 + 0.5) / 10000) AS signup,
  (floor((max(value) FILTER (WHERE event_type = 'view')) * 10000 + 0.5) / 10000) AS view
FROM l GROUP BY user_id
"""

SQL["median_trend"] = """
WITH m AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS y,
         CASE WHEN trim(p_type) = 'ECONOMY' THEN 'ECONOMY' WHEN trim(p_type) = 'SMALL' THEN 'SMALL'
              ELSE 'Other' END AS b,
         median(CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END) AS med
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT y, (floor((max(med) FILTER (WHERE b = 'ECONOMY')) * 10000 + 0.5) / 10000) AS "ECONOMY",
          (floor((max(med) FILTER (WHERE b = 'SMALL')) * 10000 + 0.5) / 10000) AS "SMALL",
          (floor((max(med) FILTER (WHERE b = 'Other')) * 10000 + 0.5) / 10000) AS "Other"
FROM m GROUP BY y
"""

SQL["top_bottom"] = f"""
WITH per AS (SELECT n_name, median(o_totalprice) AS med FROM ({_ORDERS_NATION}) GROUP BY n_name),
 t AS (SELECT 'top' AS section, CAST(row_number() OVER (ORDER BY med DESC, n_name DESC) AS INTEGER) AS pos, n_name, med
       FROM per WHERE med IS NOT NULL ORDER BY med DESC, n_name DESC LIMIT 5),
 b AS (SELECT 'bottom' AS section, CAST(row_number() OVER (ORDER BY med, n_name) + 6 AS INTEGER) AS pos, n_name, med
       FROM per WHERE med IS NOT NULL ORDER BY med, n_name LIMIT 5)
SELECT section, pos, n_name, (floor((med) * 10000 + 0.5) / 10000) AS med FROM t
UNION ALL SELECT 'divider', 6, '---', NULL
UNION ALL SELECT section, pos, n_name, (floor((med) * 10000 + 0.5) / 10000) FROM b
"""

SQL["top_ratio"] = f"""
WITH on_ AS (SELECT *, year(o_orderdate) AS y FROM ({_ORDERS_NATION})),
 latest AS (SELECT * FROM on_ WHERE y = (SELECT max(y) FROM on_)),
 per AS (SELECT n_name, count(DISTINCT o_custkey) AS total,
                count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS flagged FROM latest GROUP BY n_name)
SELECT n_name, total, flagged, (floor((flagged / total) * 10000 + 0.5) / 10000) AS rate FROM per
ORDER BY flagged / total DESC, n_name LIMIT 20
"""

SQL["multi_agg"] = """
SELECT c_mktsegment, (floor((median(o_totalprice)) * 10000 + 0.5) / 10000) AS med_totalprice, (floor((median(c_acctbal)) * 10000 + 0.5) / 10000) AS med_acctbal,
       (floor((median(year(o_orderdate)::DOUBLE)) * 10000 + 0.5) / 10000) AS med_year, count(DISTINCT o_custkey) AS customers
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
"""

SQL["pivot_counts"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS y,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
  count(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
  count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1
"""

SQL["cond_sum"] = """
SELECT ts::DATE AS day, (floor((coalesce(sum(value) FILTER (WHERE event_type = 'purchase'), 0)) * 10000 + 0.5) / 10000) AS purchase_value,
       count(*) FILTER (WHERE value > 50) AS n_over_50
FROM events GROUP BY 1
"""

SQL["group_mean_any"] = """
SELECT o_custkey, (floor((sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(o_totalprice)) * 10000 + 0.5) / 10000) AS mean_price, count(year(o_orderdate)) AS year_count,
       CAST(min(year(o_orderdate)) AS INTEGER) AS year_min, CAST(max(year(o_orderdate)) AS INTEGER) AS year_max,
       coalesce(CAST(avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) > 0 AS INTEGER), 0) AS any_urgent
FROM orders GROUP BY o_custkey
"""

SQL["group_mode"] = """
SELECT o_custkey, o_orderpriority AS top FROM
  (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) = 1
"""

SQL["last_nonnull_snapshot"] = f"""
WITH o AS ({_NULLED_ORDERS}),
 lv AS (SELECT o_custkey, v FROM o WHERE v IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (d IS NULL) DESC, d DESC, o_orderkey DESC) = 1),
 ld AS (SELECT o_custkey, d FROM o WHERE d IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC, o_orderkey DESC) = 1),
 ls AS (SELECT o_custkey, o_orderstatus FROM o WHERE o_orderstatus IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (d IS NULL) DESC, d DESC, o_orderkey DESC) = 1),
 k AS (SELECT DISTINCT o_custkey FROM o)
SELECT k.o_custkey, (floor((lv.v) * 10000 + 0.5) / 10000) AS last_v, ld.d AS last_d, ls.o_orderstatus AS last_status
FROM k LEFT JOIN lv USING (o_custkey) LEFT JOIN ld USING (o_custkey) LEFT JOIN ls USING (o_custkey)
"""

SQL["ratios"] = """
SELECT l_orderkey, l_linenumber,
  (floor((CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END) * 10000 + 0.5) / 10000) AS unit_price,
  (floor((CASE WHEN l_discount <> 0 THEN l_tax / l_discount END) * 10000 + 0.5) / 10000) AS tax_per_discount
FROM lineitem
"""

SQL["event_period"] = """
WITH fs AS (SELECT o_custkey, min(l_shipdate::DATE) AS ev FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            GROUP BY o_custkey),
 o AS (SELECT o_orderkey, o_custkey, o_orderdate::DATE AS b, o_orderdate::DATE + 30 AS e FROM orders)
SELECT o_orderkey,
  CASE WHEN ev IS NULL THEN 'before' WHEN b >= ev THEN 'after' WHEN e <= ev THEN 'before' ELSE 'transition' END AS period,
  round_even(greatest(date_diff('day', ev, e) / 30.44, 0.0), 1) AS months_since
FROM o LEFT JOIN fs USING (o_custkey)
"""

SQL["share_split"] = """
WITH per AS (
  SELECT o_custkey, sum(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS ret,
         sum(l_extendedprice) FILTER (WHERE l_returnflag <> 'R') AS other, sum(l_extendedprice) AS rev
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
 s AS (SELECT *, least(greatest(CASE WHEN ret IS NOT NULL AND other IS NOT NULL AND coalesce(ret, 0) + coalesce(other, 0) > 0
                      THEN ret / (coalesce(ret, 0) + coalesce(other, 0)) ELSE 50.0 / 100 END, 0.0), 1.0) AS share FROM per)
SELECT o_custkey, (floor((share) * 10000 + 0.5) / 10000) AS op_share, (floor((rev * coalesce(share, 0.5)) * 10000 + 0.5) / 10000) AS op_revenue,
       (floor((rev * (1 - coalesce(share, 0.5))) * 10000 + 0.5) / 10000) AS ip_revenue, (1 - coalesce(share, 0.5)) > 0.25 AS swing_risk
FROM s
"""

SQL["solvency"] = """
WITH n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
 m AS (SELECT c_custkey, c_acctbal / 50 AS dcoh, c_acctbal / 1000 AS cr, n / 20 AS dr,
              (c_acctbal - 3000) / 20000 AS om FROM customer LEFT JOIN n ON c_custkey = o_custkey),
 s AS (SELECT c_custkey,
   CASE WHEN dcoh IS NULL THEN 0 WHEN dcoh < 30 THEN 2 WHEN dcoh < 90 THEN 1 ELSE 0 END
 + CASE WHEN cr IS NULL THEN 0 WHEN cr < 1.0 THEN 2 WHEN cr < 2.0 THEN 1 ELSE 0 END
 + CASE WHEN dr IS NULL THEN 0 WHEN dr > 0.7 THEN 2 WHEN dr > 0.5 THEN 1 ELSE 0 END
 + CASE WHEN om IS NULL THEN 0 WHEN om < -0.10 THEN 2 WHEN om < 0 THEN 1 ELSE 0 END AS score,
   concat_ws(', ',
     CASE WHEN dcoh < 30 THEN 'DCOH<30' WHEN dcoh < 90 THEN 'DCOH<90' END,
     CASE WHEN cr < 1.0 THEN 'CR<1.0' WHEN cr < 2.0 THEN 'CR<2.0' END,
     CASE WHEN dr > 0.7 THEN 'DR>0.7' WHEN dr > 0.5 THEN 'DR>0.5' END,
     CASE WHEN om < -0.10 THEN 'OM<-10%' WHEN om < 0 THEN 'OM<0%' END) AS fl FROM m)
SELECT c_custkey, CAST(score AS INTEGER) AS score,
  CASE WHEN score >= 4 THEN 'Distressed' WHEN score >= 2 THEN 'Marginal' ELSE 'Stable' END AS status,
  CASE WHEN fl = '' THEN 'None' ELSE fl END AS flags
FROM s
"""

_PAD6 = "CASE WHEN length({x}) >= 6 THEN {x} ELSE lpad({x}, 6, '0') END"

SQL["id_clean"] = f"""
WITH c AS (SELECT c_custkey,
             split_part(trim(CAST(c_custkey AS VARCHAR) || '.0'), '.', 1) AS s,
             CASE WHEN c_custkey % 5 = 0 THEN split_part(CAST(c_custkey + 100000 AS VARCHAR) || '.0', '.', 1) END AS pre,
             split_part(trim(CAST(c_custkey AS VARCHAR) || '-1234'), '-', 1) AS z
           FROM customer),
 p AS (SELECT *, {_PAD6.format(x='s')} AS padded FROM c)
SELECT c_custkey, padded,
  CASE WHEN length(z) >= 5 THEN z ELSE lpad(z, 5, '0') END AS zip5,
  coalesce(TRY_CAST(substr(padded, 3) AS DOUBLE) BETWEEN 100 AND 199, false) AS in_range,
  coalesce({_PAD6.format(x='pre')}, {_PAD6.format(x='CAST(c_custkey AS VARCHAR)')}) AS unified
FROM p
"""

SQL["text_norm"] = f"""
WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS lt FROM documents),
 k AS (SELECT doc_id, {_norm("text")} AS norm,
   regexp_replace(regexp_replace(lt, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '', '', 'g') AS k0 FROM documents
   JOIN d USING (doc_id))
SELECT doc_id, norm,
  trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(k0,
      'hospital', ' '), 'medical', ' '), 'center', ' '), 'health', ' '), 'regional', ' '), 'rural', ' '),
      'emergency', ' '), 'community', ' '), 'general', ' '), 'memorial', ' '), 'critical', ' '), 'access', ' '),
    '\\s+', ' ', 'g')) AS name_key
FROM k
"""

SQL["json_flatten"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
"""

SQL["bucket_diff"] = f"""
WITH d AS ({_SHIP_DIFF}),
 c AS (SELECT count(*) FILTER (abs(x) = 0) AS exact0, count(*) FILTER (abs(x) BETWEEN 1 AND 180) AS within180,
              count(*) FILTER (abs(x) > 180) AS beyond180, count(x) AS non_null FROM d)
SELECT exact0, within180, beyond180, non_null,
  (floor((CASE WHEN non_null > 0 THEN exact0 / non_null * 100 END) * 10000 + 0.5) / 10000) AS pct_exact0,
  (floor((CASE WHEN non_null > 0 THEN within180 / non_null * 100 END) * 10000 + 0.5) / 10000) AS pct_within180,
  (floor((CASE WHEN non_null > 0 THEN beyond180 / non_null * 100 END) * 10000 + 0.5) / 10000) AS pct_beyond180
FROM c
"""

SQL["box_stats"] = f"""
WITH d AS ({_SHIP_DIFF}),
 q AS (SELECT count(x) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med,
              quantile_cont(x, 0.75) AS q3 FROM d),
 b AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT n, (floor((q1) * 10000 + 0.5) / 10000) AS q1, (floor((med) * 10000 + 0.5) / 10000) AS median, (floor((q3) * 10000 + 0.5) / 10000) AS q3, (floor((iqr) * 10000 + 0.5) / 10000) AS iqr,
  CAST(min(x) FILTER (WHERE x >= lo) AS INTEGER) AS whisker_low,
  CAST(max(x) FILTER (WHERE x <= hi) AS INTEGER) AS whisker_high,
  count(*) FILTER (WHERE x < lo OR x > hi) AS outliers
FROM d, b GROUP BY n, q1, med, q3, iqr
"""

SQL["missingness"] = f"""
WITH o AS ({_NULLED_ORDERS}), n AS (SELECT count(*) AS rows FROM o)
SELECT c AS "column", m AS missing, (floor((CASE WHEN rows > 0 THEN m / rows ELSE 0.0 END) * 10000 + 0.5) / 10000) AS share FROM (
  SELECT 'o_orderkey' AS c, count(*) FILTER (WHERE o_orderkey IS NULL) AS m FROM o
  UNION ALL SELECT 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM o
  UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM o
  UNION ALL SELECT 'd', count(*) FILTER (WHERE d IS NULL) FROM o
  UNION ALL SELECT 'v', count(*) FILTER (WHERE v IS NULL) FROM o
  UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM o), n
"""

SQL["value_counts"] = """
SELECT l_returnflag, count(*) AS count FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1
"""

SQL["union_by_name"] = """
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y,
       CASE WHEN year(o_orderdate) < 1998 THEN o_orderpriority END AS o_orderpriority
FROM orders
"""

_TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents "
                "embeddings pages benchmark labels conversations").split()
SQL["manifest"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in _TABLE_NAMES)

SQL["name_fill_join"] = """
WITH l AS (SELECT s_suppkey, s_name, s_nationkey,
                  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_acctbal END AS s_acctbal FROM supplier),
 r AS (SELECT upper(s_name) || ' Regional Medical Center' AS r_name, s_nationkey AS r_nation, s_acctbal AS r_acct
       FROM supplier),
 nk AS (SELECT 1)
SELECT s_suppkey, s_name, s_nationkey, (floor((coalesce(l.s_acctbal, r.r_acct)) * 10000 + 0.5) / 10000) AS s_acctbal
FROM l LEFT JOIN r ON
  trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
     regexp_replace(lower(l.s_name), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'),
     'hospital', ' '), 'medical', ' '), 'center', ' '), 'health', ' '), 'regional', ' '), 'rural', ' '),
     'emergency', ' '), 'community', ' '), 'general', ' '), 'memorial', ' '), 'critical', ' '), 'access', ' '),
     '\\s+', ' ', 'g'))
  = trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
     regexp_replace(lower(r.r_name), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'),
     'hospital', ' '), 'medical', ' '), 'center', ' '), 'health', ' '), 'regional', ' '), 'rural', ' '),
     'emergency', ' '), 'community', ' '), 'general', ' '), 'memorial', ' '), 'critical', ' '), 'access', ' '),
     '\\s+', ' ', 'g'))
  AND l.s_nationkey = r.r_nation
"""

SQL["attr_fan_in"] = """
WITH latest AS (SELECT o_custkey, o_orderkey AS latest_orderkey FROM orders
                QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
 fs AS (SELECT o_custkey, o_orderstatus AS first_status FROM orders WHERE o_orderstatus IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1),
 lp AS (SELECT o_custkey, o_totalprice AS last_price FROM orders WHERE o_totalprice IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate IS NULL DESC, o_orderdate DESC,
                                   o_orderkey DESC) = 1),
 n AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey),
 md AS (SELECT o_custkey, o_orderpriority AS top_priority FROM
         (SELECT o_custkey, o_orderpriority, count(*) AS c FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY c DESC, o_orderpriority) = 1)
SELECT o_custkey, latest_orderkey, top_priority, first_status, (floor((last_price) * 10000 + 0.5) / 10000) AS last_price, n_orders
FROM latest LEFT JOIN n USING (o_custkey) LEFT JOIN fs USING (o_custkey) LEFT JOIN lp USING (o_custkey)
LEFT JOIN md USING (o_custkey)
"""

SQL["filters"] = """
WITH li AS (SELECT *, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END AS tax_d FROM lineitem)
SELECT l_orderkey, l_linenumber, l_quantity, 'lineitem' AS src,
  CAST(coalesce(l_discount > 0.05, false) OR coalesce(tax_d > 0.05, false) AS INTEGER) AS flag
FROM li
WHERE (l_returnflag IN ('R', 'A') OR l_linestatus = 'O') AND l_quantity BETWEEN 10 AND 40 AND tax_d IS NOT NULL
"""

SQL["label_map"] = """
SELECT o_orderkey,
  CASE WHEN upper(o_orderstatus) = 'F' THEN 'finished'
       WHEN o_orderstatus IS NOT NULL AND o_orderstatus <> '' THEN 'not finished' END AS status_label,
  strftime(o_orderdate::DATE, '%Y-%m-%d') AS iso_date,
  round_even(o_totalprice, 0) AS price_r
FROM orders
"""

SQL["sort_latest"] = """
WITH o AS (SELECT * FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders))
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority ASC NULLS LAST, o_totalprice DESC NULLS LAST,
                                      o_orderkey) AS rn
FROM o
"""

SQL["derived_ratios"] = """
WITH li AS (SELECT l_orderkey, sum(l_extendedprice) AS ext, sum(l_extendedprice * l_tax) AS tax,
                   sum(l_extendedprice * l_discount) AS disc, count(*) AS n FROM lineitem GROUP BY 1),
 o AS (SELECT o_orderkey, o_totalprice AS ca, ext AS cl, tax AS tl, o_totalprice AS ta, disc AS cash, ext AS opex,
              n AS dis, ext AS costs, o_totalprice / 1e6 AS om FROM orders LEFT JOIN li ON o_orderkey = l_orderkey)
SELECT o_orderkey,
  (floor((om * 100) * 10000 + 0.5) / 10000) AS "Operating_Margin_Pct",
  CAST(NULL AS DOUBLE) AS "Net_Profit_Margin_Pct",
  (floor((CASE WHEN cl <> 0 THEN ca / cl END) * 10000 + 0.5) / 10000) AS "Current_Ratio",
  (floor((CASE WHEN ta <> 0 THEN tl / ta END) * 10000 + 0.5) / 10000) AS "Debt_Ratio",
  (floor((CASE WHEN opex / 365.0 <> 0 THEN cash / (opex / 365.0) END) * 10000 + 0.5) / 10000) AS "Days_Cash_on_Hand",
  (floor((CASE WHEN dis <> 0 THEN costs / dis END) * 10000 + 0.5) / 10000) AS "Cost_per_Discharge",
  CAST(NULL AS DOUBLE) AS "Labor_Cost_Pct",
  (floor((ca - (cl - tl) - coalesce(cash, 0.0)) * 10000 + 0.5) / 10000) AS implied_other
FROM o
"""

SQL["pivot_multi_index"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS y, n_name,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
  count(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
  count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus IS NOT NULL AND n_name IS NOT NULL GROUP BY 1, 2
"""

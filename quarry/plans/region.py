"""R5 and R10 in full: the panel of a region with a guarded lookup on padded ids, and the quality
report as one long table of sections."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import coerce as C
from quarry.operators import agg as A
from quarry.operators import merge as M
from quarry.operators import quality as Q
from quarry.plans.bindings import r4
from quarry.plans.recipes import panel
from quarry.plans.recipes_sql import PANEL, pad6
from quarry.plans.recipes_sql import r4 as sql_r4
from quarry.session import Tables, cut_lineage, ensure_checkpoint_dir
from quarry.sources import guards as G
from quarry.sources import snapshots as SN

# Columns of the distance lookup.
ID, YEAR, DISTANCE = "CCN", "Year", "nearest_building_road_dist_miles"


def region_panel(df: DataFrame, states: Sequence[str], lookup: DataFrame | None, tiebreak: Sequence = ()) -> DataFrame:
    """The rows of ``states`` (P7), with the id as six padded digits (F7) and the newest distance of
    each id in place of the old one (J3). A lookup without the columns it needs (S8), such as the
    text that stands for a file that was not fetched, leaves the distance as it is, or NULL."""
    df = df.where(F.col("State").isin(*states)).withColumn(ID, C.zero_pad(ID, 6, drop_after_dot=True))

    def fill(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumn(ID, C.zero_pad(ID, 6, drop_after_dot=True))
        if YEAR in right.columns:
            right = right.withColumn(YEAR, C.to_number(YEAR))
        return M.replace_from_latest(left, right, ID, DISTANCE, YEAR, tiebreak)

    if not G.has_columns(lookup, [ID, DISTANCE]) and DISTANCE in df.columns:
        return df
    return G.enrich_or_null(df, lookup, [ID, DISTANCE], fill, DISTANCE)


def q_recipe_region(spark, sf_dir):
    """The region's panel three times: with the lookup, without a lookup, with one of other columns."""
    t = Tables(spark, sf_dir)
    region = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", F.col("r_name").alias("State")))
    m = panel(t).join(region, F.col("k") == F.col("c_custkey"))
    m = cut_lineage(m.select(F.concat(F.col("k").cast("string"), F.lit(".0")).alias(ID), "State", F.col("y").alias(YEAR), "ship_total"))
    lookup = t.events.select(
        F.concat(F.lit(" "), F.col("user_id").cast("string")).alias(ID), (F.col("event_id") % 5 + 2018).cast("string").alias(YEAR),
        F.col("value").alias(DISTANCE), "event_id")
    frames = {"lookup": lookup, "none": None, "pointer": lookup.select(F.col(YEAR).alias("version https://git-lfs"))}
    out = None
    for name, x in frames.items():
        part = region_panel(m, ["ASIA", "EUROPE"], x, [F.desc("event_id")]).select(
            F.lit(name).alias("source"), ID, "State", YEAR, "ship_total", r4(DISTANCE).alias("distance"))
        out = part if out is None else out.unionByName(part)
    return out


def quality_sections(m: DataFrame, key: str, year: str, source: str, measure: str, snapshot: DataFrame) -> DataFrame:
    """Section, name, value: summary (A17), rows by source (A10), missing values by column (A18), the
    box of a measure (A20), duplicate keys (W7) and the rows of each published table (K3)."""
    def long(df: DataFrame, section: str) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in df.columns])
        return df.select(F.lit(section).alias("section"), F.explode(cells).alias("x")).select("section", "x.name", "x.value")

    def pairs(df: DataFrame, section: str, name: str, value: str) -> DataFrame:
        return df.select(F.lit(section).alias("section"), F.col(name).alias("name"), F.col(value).cast("double").alias("value"))

    return M.union_by_name([
        long(Q.panel_summary(m, key, year, F.col(source) == "both"), "summary"),
        pairs(A.value_counts(m, source), "source", source, "count"),
        pairs(Q.missingness(m), "missing", "column", "missing"),
        long(Q.box_stats(m, measure), "box"),
        pairs(snapshot, "published", "table", "rows")])


def q_recipe_quality_report(spark, sf_dir):
    t = Tables(spark, sf_dir)
    root = f"{ensure_checkpoint_dir(spark)}/quality-{uuid.uuid4().hex}"
    rows = SN.publish({"panel": panel(t), "entities": t.customer}, root, "20260101", {"panel": ["y"]})
    m = SN.published(spark, root, "panel")
    out = quality_sections(m, "k", "y", "src", "lines", rows)
    return out.select("section", "name", r4("value").alias("value"))


_WHISKERS = ("min(lines) FILTER (WHERE lines >= q1 - 1.5 * (q3 - q1))", "max(lines) FILTER (WHERE lines <= q3 + 1.5 * (q3 - q1))",
             "count(*) FILTER (WHERE lines < q1 - 1.5 * (q3 - q1) OR lines > q3 + 1.5 * (q3 - q1))")
_COLUMNS = ["k", "y", "o_totalprice", "ship_total", "lines", "in_left", "in_right", "src", "avg_line", "order_to_ship"]

SQL = {
    "recipe_region": f"""
WITH {PANEL},
 cr AS (SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')),
 lk AS (SELECT user_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 5 DESC, event_id DESC) = 1),
 p AS (SELECT {pad6("CAST(k AS VARCHAR)")} AS "CCN", r_name AS "State", y AS "Year", ship_total, {sql_r4("value")} AS d FROM m JOIN cr ON k = c_custkey LEFT JOIN lk ON k = user_id)
SELECT 'lookup' AS source, "CCN", "State", "Year", ship_total, d AS distance FROM p
UNION ALL SELECT 'none', "CCN", "State", "Year", ship_total, NULL FROM p
UNION ALL SELECT 'pointer', "CCN", "State", "Year", ship_total, NULL FROM p
""",
    "recipe_quality_report": f"""
WITH {PANEL},
 q AS (SELECT count(lines) AS n, quantile_cont(lines, 0.25) AS q1, quantile_cont(lines, 0.5) AS med, quantile_cont(lines, 0.75) AS q3 FROM m),
 b AS (SELECT n, q1, med, q3, {_WHISKERS[0]} AS lo, {_WHISKERS[1]} AS hi, {_WHISKERS[2]} AS outliers FROM m, q GROUP BY 1, 2, 3, 4),
 sm AS (SELECT count(*) AS rows, count(DISTINCT k) AS distinct_ids, min(y) AS min_year, max(y) AS max_year, count(*) FILTER (WHERE k IS NULL) AS null_ids,
         count(*) FILTER (WHERE src = 'both') AS flagged_rows, count(DISTINCT k) FILTER (WHERE src = 'both') AS flagged_ids FROM m),
 rep AS (
  {" UNION ALL ".join(f"SELECT 'summary' AS section, '{c}' AS name, {c}::DOUBLE AS value FROM sm" for c in ("rows", "distinct_ids", "min_year", "max_year", "null_ids", "flagged_rows", "flagged_ids"))}
  UNION ALL SELECT 'source', src, count(*) FROM m GROUP BY src
  {" ".join(f"UNION ALL SELECT 'missing', '{c}', " + ("max(0)" if c.startswith("in_") else f"count(*) FILTER (WHERE {c} IS NULL)") + " FROM m" for c in _COLUMNS)}
  {" ".join(f"UNION ALL SELECT 'box', '{n}', {x} FROM b" for n, x in (("n", "n"), ("q1", "q1"), ("median", "med"), ("q3", "q3"), ("iqr", "q3 - q1"), ("whisker_low", "lo"), ("whisker_high", "hi"), ("outliers", "outliers")))}
  UNION ALL SELECT 'published', 'panel', count(*) FROM m UNION ALL SELECT 'published', 'entities', count(*) FROM customer)
SELECT section, name, {sql_r4("value")} AS value FROM rep
"""}

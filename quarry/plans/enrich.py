"""R4 in full: measures of places brought to the panel by state and folded county, the year kept in
the pivot index, percentiles, and how much is missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.operators import agg as A
from quarry.operators import columns as P
from quarry.operators import dedupe as D
from quarry.operators import merge as M
from quarry.operators import quality as Q
from quarry.operators import rank as R
from quarry.plans.bindings import r4
from quarry.plans.recipes_sql import _pctl
from quarry.plans.recipes_sql import r4 as sql_r4
from quarry.session import Tables, cut_lineage

YEAR, STATE, PLACE, MEASURE, VALUE = "year", "stateabbr", "locationname", "measure", "data_value"


def assert_one_each(df: DataFrame, keys: Sequence, what: str) -> DataFrame:
    """``df`` unchanged, unless two of its rows have equal keys: then reading it is an error that
    names them. Checked where the rows are, by a window on the keys."""
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    several = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    named = F.concat(F.lit(f"{what}: more than one row for "), F.to_json(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])))
    # the check decides about every row, so that no plan can leave it out
    return df.withColumn("__ok", F.when(several, F.raise_error(named).cast("boolean")).otherwise(F.lit(True))).where("__ok").drop("__ok")


def places_wide(places: DataFrame, measures: Sequence[str], order: Sequence = ()) -> DataFrame:
    """Long rows of places -> one row per (year, state, place) with the measures' values of that year,
    where each measure has only its latest year, and percentiles among all rows.

    A place whose measures are of different years has a row for each of these years (and so have
    the panel rows it is joined to): that fan-out is kept. Any other, two rows of one year whose
    names differ in case or blanks only, is an error."""
    places = P.normalize_headers(places, lower=True).where(F.col(MEASURE).isin(*measures))
    latest = D.latest_per_key(places, [STATE, PLACE, MEASURE], YEAR, order)
    wide = A.pivot_wide(latest, [YEAR, STATE, PLACE], MEASURE, VALUE, measures)
    wide = cut_lineage(assert_one_each(wide, [STATE, M.fold_key(PLACE), YEAR], "places"))
    wide = wide.withColumn("__row", F.struct(YEAR, STATE, PLACE))
    return R.pct_rank_columns(wide, "__row", measures, "_PCTL").drop("__row")


def enrich(panel: DataFrame, places: DataFrame, measures: Sequence[str], state: str = "State", county: str = "County", order: Sequence = ()) -> DataFrame:
    """panel with the measures and percentiles of its places (J2: state as it is, county folded)."""
    wide = P.drop_existing(places_wide(places, measures, order), [YEAR])
    return M.lookup_left(panel, wide, exact=[(state, STATE)], folded=[(county, PLACE)])


MEASURES = ["click", "error", "purchase", "signup"]


def q_recipe_enrich_county(spark, sf_dir):
    t = Tables(spark, sf_dir)
    nation = t.nation.select("n_nationkey", "n_name")
    place = F.concat(F.lit("County "), (F.col("c_custkey") % 37).cast("string"))
    panel = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.when(F.col("c_custkey") % 29 != 0, F.col("n_name")).alias("State"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("  "), F.upper(place))).when(F.col("c_custkey") % 41 != 0, place).alias("County"))
    users = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).where(F.col("c_custkey") % 5 != 0)
    places = t.events.join(users, F.col("user_id") == F.col("c_custkey")).select(
        (2018 + F.col("event_id") % 4).cast("int").alias(" Year"), F.col("n_name").alias("StateAbbr"), place.alias("LocationName "),
        F.col("event_type").alias("Measure"), F.col("value").alias("Data_Value"), "event_id")
    out = cut_lineage(enrich(panel, places, MEASURES, order=[F.desc("event_id")]))
    missing = Q.missingness(out, MEASURES)  # one row per measure
    lost = {m: missing.where(F.col("column") == m).select("missing").scalar() for m in MEASURES}
    return out.select("c_custkey", "State", "County", *[r4(m).alias(m) for m in MEASURES], *[r4(f"{m}_PCTL").alias(f"{m}_pctl") for m in MEASURES],
                      *[x.alias(f"{m}_missing") for m, x in lost.items()])


SQL = {"recipe_enrich_county": f"""
WITH c AS (SELECT *, 'County ' || CAST(c_custkey % 37 AS VARCHAR) AS place FROM customer JOIN nation ON c_nationkey = n_nationkey),
 panel AS (SELECT c_custkey, CASE WHEN c_custkey % 29 <> 0 THEN n_name END AS "State",
             CASE WHEN c_custkey % 3 = 0 THEN '  ' || upper(place) WHEN c_custkey % 41 <> 0 THEN place END AS "County" FROM c),
 p AS (SELECT CAST(2018 + event_id % 4 AS INTEGER) AS y, n_name AS st, place, event_type AS m, value AS v, event_id
       FROM events JOIN c ON user_id = c_custkey WHERE c_custkey % 5 <> 0 AND event_type IN ('click', 'error', 'purchase', 'signup')),
 l AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY st, place, m ORDER BY y DESC, event_id DESC) = 1),
 w AS (SELECT y, st, place, {", ".join(f"max(v) FILTER (WHERE m = '{m}') AS {m}" for m in MEASURES)} FROM l GROUP BY 1, 2, 3),
 r AS (SELECT *, {", ".join(f"{_pctl(m)} AS {m}_pctl" for m in MEASURES)} FROM w),
 j AS (SELECT panel.*, r.* FROM panel LEFT JOIN r ON "State" IS NOT DISTINCT FROM st AND lower(trim("County")) = lower(trim(place)))
SELECT c_custkey, "State", "County", {", ".join(f"{sql_r4(m)} AS {m}" for m in MEASURES)}, {", ".join(f"{sql_r4(m + '_pctl')} AS {m}_pctl" for m in MEASURES)},
  {", ".join(f"(count(*) OVER () - count({m}) OVER ())::BIGINT AS {m}_missing" for m in MEASURES)}
FROM j
"""}

"""R3 with the choice of matcher: a plan picked by what the second list has.

* no second list, or an empty one: the stage is skipped (S9), the flag stays NULL;
* it has the entity's id: interval overlap on padded ids (J6);
* else by name: sparse shortlist and dense rerank (J8) where both sides have vectors, TF-IDF
  similarity (J7) where not.

The choice reads schemas only; whether a list is empty takes one small job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import coerce as C
from quarry.functions import text as TX
from quarry.operators import interval as IV
from quarry.operators import similarity as S
from quarry.plans.bindings import r4
from quarry.plans.oracle import _dense_cos, _sim_text, _tfidf
from quarry.plans.recipes_sql import r4 as sql_r4
from quarry.session import Tables, cut_lineage
from quarry.sources import guards as G

# Headers of the second list.
ID, START, END, KIND = "Medicare Provider Number", "Participating Start Date", "Termination Date", "Entity Type"
#: Kinds of entity that count, where the list says the kind.
KINDS = ("CAH", "SCH", "DSH", "PED", "CAN", "RRC", "SOL")


def match_enrollment(panel: DataFrame, entities: DataFrame | None, kinds: Sequence[str] = KINDS,
                     tfidf_threshold: float = 0.40, dense_threshold: float = 0.82) -> DataFrame:
    """panel (row_id, ccn, fy_begin, fy_end, text and perhaps vector) with ``matched_by`` ('id',
    'rerank', 'name' or NULL), ``match_score`` (of the name matchers) and ``enrolled`` (0 / 1).

    entities: either ``ID`` with ``START`` and ``END`` as text, or text and perhaps vector (with an
    entity_id); of a list with ``KIND`` the rows of ``kinds`` count."""
    def done(df: DataFrame, by: str | None, score=None, flag=None) -> DataFrame:
        return df.withColumns({"matched_by": F.lit(by).cast("string"), "match_score": F.lit(None).cast("double") if score is None else score,
                               "enrolled": F.lit(None).cast("int") if flag is None else flag.cast("int")})

    def by_id(e: DataFrame) -> DataFrame:
        periods = e.select(C.zero_pad(ID, 6, drop_after_dot=True).alias("k"), C.to_date_lenient(START).alias("s"), C.to_date_lenient(END).alias("t"))
        left = panel.withColumn("ccn", C.zero_pad("ccn", 6, drop_after_dot=True))
        return done(IV.interval_overlap_flag(left, "ccn", "fy_begin", "fy_end", periods, "k", "s", "t", out="__flag"), "id", flag=F.col("__flag")).drop("__flag")

    def by_vector(e: DataFrame) -> DataFrame:
        found = S.shortlist_rerank(panel, e, "row_id", "entity_id", "text", "text", "vector", "vector", k=10, threshold=dense_threshold)
        found = panel.join(found.select("row_id", "rerank_score", "rerank_flag"), "row_id", "left")
        return done(found, "rerank", F.col("rerank_score"), F.col("rerank_flag")).drop("rerank_score", "rerank_flag")

    def by_text(e: DataFrame) -> DataFrame:
        found = S.tfidf_match(panel, e, "text", "text", tfidf_threshold, "__score", "__flag")
        return done(found, "name", F.col("__score"), F.col("__flag")).drop("__score", "__flag")

    def by_name(e: DataFrame) -> DataFrame:
        return by_text(e) if "vector" not in panel.columns else G.dispatch_by_column(e, "vector", by_vector, by_text)

    def stage(df: DataFrame, e: DataFrame) -> DataFrame:
        return G.dispatch_by_column(e, ID, by_id, by_name)

    if entities is not None and KIND in entities.columns:
        entities = entities.where(F.col(KIND).isin(*kinds))
    out = G.optional_stage(panel, entities, stage)
    return out if "matched_by" in out.columns else done(out, None)


def _inputs(t: Tables) -> tuple[DataFrame, dict[str, DataFrame]]:
    nation = t.nation.select("n_nationkey", "n_name")
    day = F.lit("1995-01-01").cast("date")
    panel = (t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .join(t.embeddings.select("vec_id", "embedding"), F.col("vec_id") == F.col("c_custkey"))
             .select(F.col("c_custkey").alias("row_id"), F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("ccn"),
                     F.when(F.col("c_custkey") % 13 != 0, F.date_add(day, (F.col("c_custkey") % 700).cast("int"))).alias("fy_begin"),
                     F.date_add(day, (F.col("c_custkey") % 700 + 60).cast("int")).alias("fy_end"),
                     TX.similarity_text("c_name", "n_name", "c_mktsegment").alias("text"), F.col("embedding").alias("vector")))
    kind = F.when(F.col("s_suppkey") % 5 == 0, "STD").when(F.col("s_suppkey") % 2 == 0, "CAH").otherwise("DSH")
    text_day = lambda n: F.date_format(F.date_add(day, n.cast("int")), "M/d/yyyy")
    listed = t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("entity_id"), kind.alias(KIND), F.col("s_suppkey").cast("string").alias(ID),
        F.when(F.col("s_suppkey") % 7 != 0, text_day(F.col("s_suppkey") * 37 % 900)).alias(START),
        F.when(F.col("s_suppkey") % 3 != 0, text_day(F.col("s_suppkey") * 37 % 900 + 100)).alias(END),
        TX.similarity_text("s_name", "n_name").alias("text"))
    named = listed.select("entity_id", KIND, "text")
    vectors = t.embeddings.select((F.col("vec_id") - 1).alias("entity_id"), F.col("embedding").alias("vector"))
    return panel, {"export": listed.select(KIND, ID, START, END), "daily": named, "vectors": named.join(vectors, "entity_id"),
                   "empty": named.where(F.col(KIND) == "none")}


def q_recipe_enroll_dispatch(spark, sf_dir):
    """Four second lists: an export with ids, a daily list, a daily list with vectors, an empty one."""
    panel, lists = _inputs(Tables(spark, sf_dir))
    panel = cut_lineage(panel)
    out = None
    for name, entities in lists.items():
        part = match_enrollment(panel, entities).select(
            F.lit(name).alias("list"), "row_id", "matched_by", r4("match_score").alias("match_score"), "enrolled")
        out = part if out is None else out.unionByName(part)
    return out


SQL = {"recipe_enroll_dispatch": f"""
WITH lsrc AS (SELECT c_custkey AS id, {_sim_text("c_name || ' ' || n_name || ' ' || c_mktsegment")} AS t, embedding AS v,
    CASE WHEN c_custkey % 13 <> 0 THEN DATE '1995-01-01' + CAST(c_custkey % 700 AS INTEGER) END AS b, DATE '1995-01-01' + CAST(c_custkey % 700 + 60 AS INTEGER) AS e
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN embeddings ON vec_id = c_custkey),
 rsrc AS (SELECT s_suppkey AS id, {_sim_text("s_name || ' ' || n_name")} AS t, embedding AS v,
    CASE WHEN s_suppkey % 7 <> 0 THEN DATE '1995-01-01' + CAST(s_suppkey * 37 % 900 AS INTEGER) END AS s,
    CASE WHEN s_suppkey % 3 <> 0 THEN DATE '1995-01-01' + CAST(s_suppkey * 37 % 900 + 100 AS INTEGER) END AS x
  FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN embeddings ON vec_id = s_suppkey + 1 WHERE s_suppkey % 5 <> 0),
 {_tfidf("lsrc", "rsrc")},
 best AS (SELECT lt, max(score) AS s FROM pairs GROUP BY lt),
 vsrc AS (SELECT id, t, v FROM rsrc WHERE v IS NOT NULL),
 {_tfidf("lsrc", "vsrc", "_v")},
 cand AS (SELECT l.id AS lid, r.id AS rid, round(coalesce(p.score, 0), 9) AS s FROM lsrc l, vsrc r LEFT JOIN pairs_v p ON p.lt = l.t AND p.rt = r.t),
 top AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY lid ORDER BY s DESC, rid) <= 10),
 dense AS (SELECT lid, max({_dense_cos("l.v", "r.v")}) AS d FROM top JOIN lsrc l ON l.id = lid JOIN vsrc r ON r.id = rid GROUP BY lid)
SELECT 'export' AS list, l.id AS row_id, 'id' AS matched_by, NULL::DOUBLE AS match_score,
  CAST(EXISTS (SELECT 1 FROM rsrc r WHERE r.id = l.id AND (b IS NULL OR e IS NULL OR s IS NULL OR (NOT coalesce(x < b, false) AND s <= e))) AS INTEGER) AS enrolled
FROM lsrc l
UNION ALL SELECT 'daily', id, 'name', CASE WHEN s >= 0.4 - 1e-9 THEN {sql_r4("s")} END, CASE WHEN s >= 0.4 - 1e-9 THEN 1 ELSE 0 END FROM lsrc LEFT JOIN best ON t = lt
UNION ALL SELECT 'vectors', id, 'rerank', {sql_r4("d")}, CASE WHEN d >= 0.82 THEN 1 ELSE 0 END FROM lsrc LEFT JOIN dense ON lid = id
UNION ALL SELECT 'empty', id, NULL, NULL, NULL FROM lsrc
"""}

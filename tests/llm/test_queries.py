"""The registered queries against their SQL, and the pipeline stage by stage."""
import re

import duckdb
import pytest

import corpus_pipeline
from quarry.llm import registry
from quarry.session import TABLES

DIR = "/root/testdata/sf0.001"


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    cur = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = sorted([dict(zip(names, map(plain, r))) for r in cur.fetchall()], key=str)
    df = registry.queries()[name](spark, DIR)
    assert sorted(df.columns) == sorted(names)
    got = sorted([{c: plain(r[c]) for c in names} for r in df.collect()], key=str)
    assert got == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    before = set(texts)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DIR)
        assert docs.columns == columns
        rows = docs.collect()
        assert {r.doc_id for r in rows} <= before and all(texts[r.doc_id] == r.text for r in rows)
        if name != "mixing":
            assert len(rows) == len({r.doc_id for r in rows})
        least = {"language_id": 0.95, "quality_rules": 0.5, "near_dedup": 0.5, "mixing": 0.3}[name]
        assert len({r.doc_id for r in rows}) >= least * len(before)
        before = {r.doc_id for r in rows}
        docs = spark.createDataFrame(rows, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DIR).collect()
    assert {r.doc_id for r in packed} == before


def test_pipeline_takes_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    good = " ".join(["the water of the river and the old house in it was on"] * 1 + [f"word{i} and the" for i in range(60)])
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, good, "en", None, 1), (4, good, "en", "s", 1), (4, good, "en", "s", 1), (5, good + " x", None, "t", 2)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, DIR)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() == 0 if not data else docs.count() >= 1


@pytest.mark.parametrize("name", ["op2_license_scan", "op3_chat_format", "op8_quality_rules", "op10_mixing"])
def test_native_queries_have_no_python(spark, name):
    plan = registry.queries()[name](spark, DIR)._jdf.queryExecution().toString()
    assert not re.search("EvalPython|MapInArrow|MapInPandas|InPandas|InArrow|ExternalRDD", plan.split("== Physical Plan ==")[1])


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_lexical_search", "op13_binary_packing"])
def test_plans_have_no_products(spark, name):
    plan = registry.queries()[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

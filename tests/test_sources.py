"""Round trips for file-level operators (S1-S10, K1-K3) in fresh temp folders."""

import json
import os

from pyspark.sql import functions as F

from quarry.sources import guards as G
from quarry.sources import readers as RD
from quarry.sources import sinks as K


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_by_name_and_yearly_stack(spark, tmpdir_path):
    a = os.path.join(tmpdir_path, "report_2020.csv")
    b = os.path.join(tmpdir_path, "report_2021.csv")
    _write(a, "Provider CCN,Beds,FY End\n10001, 12 ,2020-12-31\n10002,NA,12/31/2020\n")
    _write(b, "FY End,Provider CCN\n2021-06-30,10003.0\n")
    schema = {"CCN": "long", "Num_Beds": "double", "FY_End": "date"}
    ren = {"Provider CCN": "CCN", "Beds": "Num_Beds", "FY End": "FY_End"}
    df = RD.stack_yearly(spark, {2020: a, 2021: b}, schema, ren, "Data_Source")
    got = sorted((r.CCN, r.Num_Beds, str(r.FY_End), r.Year) for r in df.collect())
    assert got == [(10001, 12.0, "2020-12-31", 2020), (10002, None, "2020-12-31", 2020),
                   (10003, None, "2021-06-30", 2021)]
    one = RD.read_csv_by_name(spark, b, {"Provider CCN": "long", "Missing": "double"})
    assert one.collect()[0]["Missing"] is None
    yr = RD.with_year_from_path(spark.read.option("header", True).csv(tmpdir_path))
    assert sorted({r.file_year for r in yr.collect()}) == [2020, 2021]
    assert RD.latest_path([a, b]) == b


def test_preamble_skip(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "export.csv")
    _write(p, "Title line\nGenerated today\n\n,,\nEntity Type,Medicare Provider Number,Start\nCAH,010001,1/2/2020\n"
              "DSH,\"450,1\",\n")
    df = RD.read_csv_after_preamble(spark, p, 4)
    assert df.columns == ["Entity Type", "Medicare Provider Number", "Start"]
    assert [tuple(r) for r in df.collect()] == [("CAH", "010001", "1/2/2020"), ("DSH", "450,1", None)]


def test_flatten_entities(spark, tmpdir_path):
    p1 = os.path.join(tmpdir_path, "wrapped.json")
    _write(p1, json.dumps({"coveredEntities": [
        {"name": "A", "entityType": "CAH", "id340B": "X1", "streetAddress": {"addressLine1": "1 Main", "city": "Q"},
         "participatingStartDate": "2020-01-01", "medicaidNumbers": [{"medicaidNumber": "M1"}], "participating": True},
        {"name": "B", "entityType": "DSH", "id340B": "X2", "medicaidNumbers": [], "participating": False}]}))
    p2 = os.path.join(tmpdir_path, "bare.json")
    _write(p2, json.dumps([{"name": "C", "entityType": "SCH", "id340B": "X3"}]))
    r1 = {r["Entity Name"]: r for r in RD.flatten_entities(spark, p1).collect()}
    assert r1["A"]["Street City"] == "Q" and r1["A"]["Street State"] == "" and r1["A"]["Medicaid Billing Number"] == "M1"
    assert r1["B"]["Street Address 1"] == "" and r1["B"]["Medicaid Billing Number"] == ""
    r2 = RD.flatten_entities(spark, p2).collect()
    assert r2[0]["Entity Name"] == "C" and r2[0]["Medicaid Billing Number"] == ""
    assert (r2[0]["Start Date"], r2[0]["Termination Date"], r2[0]["Participating"]) == ("", "", None)
    _write(p2, json.dumps([{"participating": True}]))
    (r3,) = RD.flatten_entities(spark, p2).collect()
    assert (r3["Entity Name"], r3["Entity Type"], r3["340B ID"], r3["Participating"]) == ("", "", "", True)


def test_guards(spark):
    df = spark.createDataFrame([(1, "x")], "k int, name string")
    out = G.dispatch_by_column(df, "Medicare Provider Number", lambda d: d.withColumn("path", F.lit("ccn")),
                               lambda d: d.withColumn("path", F.lit("name")))
    assert out.collect()[0].path == "name"
    broken = G.dispatch_by_column(df, "k", lambda d: d.select("nope"), lambda d: d.withColumn("path", F.lit("fb")))
    assert broken.collect()[0].path == "fb"
    bad = spark.createDataFrame([("x",)], "oid string")
    out = G.enrich_or_null(df, bad, ["CCN", "dist"], lambda a, b: a, "dist")
    assert out.collect()[0].dist is None and dict(out.dtypes)["dist"] == "double"
    empty = spark.createDataFrame([], "k int")
    assert G.optional_stage(df, empty, lambda a, b: a.limit(0)).count() == 1
    assert G.optional_stage(df, None, lambda a, b: a.limit(0)).count() == 1


def test_pushdown_plan(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "health")
    spark.createDataFrame([(2020, "AL", "X", "A", 1.0, "junk")] * 3,
                          "year int, stateabbr string, locationname string, measure string, data_value double, "
                          "extra string").write.parquet(p)
    df = RD.pruned_scan(spark, p, "measure", ["A", "B"], ["year", "stateabbr", "locationname", "measure", "data_value"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(measure" in plan or "PushedFilters: [IsNotNull(measure), In(measure" in plan
    assert "extra" not in plan.split("ReadSchema:")[1]


def test_sinks_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, None, 0.123456789)], "k int, s string, v double")
    K.write_csv(df, os.path.join(tmpdir_path, "csv"))
    back = spark.read.option("header", True).csv(os.path.join(tmpdir_path, "csv")).collect()[0]
    assert back.k == "1" and back.s is None
    K.write_json_rows(df, os.path.join(tmpdir_path, "json"))
    line = spark.read.text(os.path.join(tmpdir_path, "json")).collect()[0].value
    assert '"s":null' in line and "0.123456789" in line
    m = K.write_snapshot({"a": df, "b": df.union(df)}, os.path.join(tmpdir_path, "snap"), "20260101")
    assert sorted((r.table, r.rows) for r in m.collect()) == [("a", 1), ("b", 2)]


def test_incremental_landing(spark, tmpdir_path):
    from quarry.streaming.landing import ingest_new_files
    land = os.path.join(tmpdir_path, "land")
    stage = os.path.join(tmpdir_path, "stage")
    _write(os.path.join(land, "cost_2020.csv"), "Provider CCN,Beds\n1,10\n2,NA\n")
    args = dict(raw_columns=["Provider CCN", "Beds"], schema={"CCN": "long", "Beds": "double"},
                renames={"Provider CCN": "CCN"}, name=f"landing-{os.path.basename(tmpdir_path)}")
    ingest_new_files(spark, land, stage, **args)
    assert spark.read.parquet(stage).count() == 2
    _write(os.path.join(land, "cost_2021.csv"), "Provider CCN,Beds\n3,7\n")
    ingest_new_files(spark, land, stage, **args)
    got = sorted((r.CCN, r.Beds, r.Year) for r in spark.read.parquet(stage).collect())
    assert got == [(1, 10.0, 2020), (2, None, 2020), (3, 7.0, 2021)]


def test_baseline_document_keeps_nulls_and_has_no_nan(spark, tmpdir_path):
    average = spark.createDataFrame([("A", 1.25, None), ("B", float("nan"), "x")], "uid string, mean double, top string")
    recent = spark.createDataFrame([("A", 0.1 + 0.2)], "uid string, v double")
    K.write_baselines(average, recent, {"generated": "2026-01-01", "hospitals": 2}, tmpdir_path)

    def read(name):
        return sorted((json.loads(r.value) for r in spark.read.text(os.path.join(tmpdir_path, name)).collect()), key=str)

    assert read("metadata") == [{"generated": "2026-01-01", "hospitals": 2}]
    assert read("baseline_average") == [{"uid": "A", "mean": 1.25, "top": None}, {"uid": "B", "mean": None, "top": "x"}]
    assert read("baseline_most_recent") == [{"uid": "A", "v": 0.30000000000000004}]


def test_report_tables(spark, tmpdir_path):
    reports = {"q1": spark.createDataFrame([(1, "a,b")], "n int, t string"), "q2": spark.createDataFrame([], "n int")}
    K.write_reports(reports, tmpdir_path)
    assert spark.read.parquet(os.path.join(tmpdir_path, "q1")).collect() == [(1, "a,b")]
    assert spark.read.option("header", True).csv(os.path.join(tmpdir_path, "q1_csv")).collect() == [("1", "a,b")]
    assert spark.read.parquet(os.path.join(tmpdir_path, "q2")).count() == 0

"""Ranges on larger data, quantiles against numpy, and cases that once gave wrong values."""
import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import coerce as C
from quarry.operators import agg as A
from quarry.operators import merge as M
from quarry.operators import quality as Q
from quarry.operators import quantiles as QT
from quarry.operators import rank as R
from quarry.operators.ordering import global_row_number
from quarry.plans.recipes import FINAL_COLUMNS, conversion_list
from quarry.session import ensure_checkpoint_dir
from quarry.sources import guards as G
from quarry.sources import readers as RD
from quarry.streaming.landing import ingest_new_files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_positions_and_percentiles_of_two_million_rows(spark, reuse):
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        n = 2_000_000
        df = spark.range(n).select(F.pmod(F.col("id") * 7919 + 13, F.lit(n)).alias("v"), F.md5(F.col("id").cast("string")).alias("wide"))
        got = global_row_number(df, [F.col("v")]).agg(F.sum(F.abs(F.col("rn") - F.col("v") - 1)), F.count("*"), F.max("rn")).first()
        assert tuple(got) == (0, n, n)
        p = R.value_percentiles(df, "v").agg(F.max(F.abs(F.col("pctl") - (F.col("v") + 1) / n * 100)), F.count("*")).first()
        assert p[0] < 1e-9 and p[1] == n
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)


def test_quantiles_equal_numpy(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([1.5, 2.0, rng.random() * 9, None, float("nan")]), rng.randint(0, 4)) for _ in range(3000)] + [("empty", None, None)]
    df = spark.createDataFrame(rows, "k string, x double, y int")
    clean = lambda k, i: [r[i] for r in rows if r[0] == k and r[i] is not None and r[i] == r[i]]
    found = QT.group_quantiles(df, ["k"], {"x": "x", "y": F.col("y") * 2}, [0.0, 0.25, 0.5, 0.9, 1.0])
    assert not any(w in found._jdf.queryExecution().toString().lower() for w in ("percentile", "collect_list"))
    got = {(r.k, r.measure, r.p): r.value for r in found.collect()}
    for k in ("hot", "a", "b", None):
        for p in (0.0, 0.25, 0.5, 0.9, 1.0):
            assert got[(k, "x", p)] == pytest.approx(np.quantile(clean(k, 1), p), abs=1e-12)
            assert got[(k, "y", p)] == pytest.approx(2 * np.quantile(clean(k, 2), p), abs=1e-12)
    assert len(got) == 40
    groups = df.groupBy("k").agg(F.count("*").alias("n"))
    med = {r.k: r.m for r in QT.with_medians(groups, df, "k", {"m": "x"}).collect()}
    assert med["empty"] is None and med[None] == pytest.approx(np.median(clean(None, 1)))
    box = Q.box_stats(df.where("k = 'hot' AND NOT isnan(x)"), "x").first()
    assert (box.q1, box.q3) == pytest.approx(tuple(np.quantile(clean("hot", 1), [0.25, 0.75])))


def test_duplicate_cells_are_an_error(spark):
    long = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0)], "k int, c string, v double")
    with pytest.raises(Exception, match="duplicate cell"):
        A.pivot_wide(long, "k", "c", "v", ["a"]).collect()
    assert A.pivot_wide(long.limit(1), "k", "c", "v", ["a", "b"]).collect() == [(1, 1.0, None)]


def test_undated_lookup_needs_an_order(spark):
    df = spark.createDataFrame([(1, 0)], "k int, v int")
    lookup = spark.createDataFrame([(1, 5, 2), (1, 6, 1)], "k int, v int, o int")
    with pytest.raises(ValueError, match="tiebreak"):
        M.replace_from_latest(df, lookup, "k", "v")
    assert M.replace_from_latest(df, lookup, "k", "v", tiebreak=[F.col("o")]).collect() == [(1, 6)]


def test_null_keys_fill_null_keys(spark):
    left = spark.createDataFrame([("x", None, None), ("y", "s", None)], "n string, st string, v int")
    right = spark.createDataFrame([("x", None, 3), ("y", "t", 4)], "n string, st string, v int")
    got = M.fill_from_right(left, right, [(F.col("n"), F.col("n")), (F.col("st"), F.col("st"))], ["v"])
    assert sorted(got.collect()) == [("x", None, 3), ("y", "s", None)]


def test_long_ids_keep_all_digits(spark):
    text = ["9007199254740993", " 12 ", "12.0", "1e5", "-7", "99999999999999999999", "x", None, "1.5"]
    df = spark.createDataFrame([(t,) for t in text], "t string").select(C.to_long_id("t"))
    assert [r[0] for r in df.collect()] == [9007199254740993, 12, 12, 100000, -7, None, None, None, None]
    long = spark.createDataFrame([("ab" + "0" * 10 + "7",)], "t string")
    assert long.select(C.id_suffix_between("t", 5, 9)).first()[0]


def test_several_files_are_read_by_name(spark, tmpdir_path):
    a, b = os.path.join(tmpdir_path, "a.csv"), os.path.join(tmpdir_path, "b.csv")
    _write(a, "id,amt\n1,10\n")
    _write(b, "amt,id\n20,2\n")
    got = RD.read_csv_by_name(spark, [a, b], {"id": "long", "amt": "double"}).collect()
    assert sorted(got) == [(1, 10.0), (2, 20.0)]
    stacked = RD.stack_yearly(spark, {2020: a, 2021: b}, {"id": "long", "none": "double"})
    assert dict(stacked.dtypes)["none"] == "double"


def test_preamble_with_quoted_header(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "one", "a.csv")
    _write(path, 'junk\n"City, State",n\n"Rome, IT",5\n')
    got = RD.read_csv_after_preamble(spark, path, 1)
    assert got.columns == ["City, State", "n"] and got.collect() == [("Rome, IT", "5")]
    _write(os.path.join(tmpdir_path, "one", "b.csv"), "junk\nx,n\n1,2\n")
    both = RD.read_csv_after_preamble(spark, os.path.dirname(path), 1)
    assert sorted(both.select("City, State", "x", "n").collect(), key=str) == [("Rome, IT", None, "5"), (None, "1", "2")]


def test_entities_without_numbers(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "e.json")
    for root in ([{"name": "A", "medicaidNumbers": [], "participating": True}, {"name": "B"}],):
        for text in (json.dumps(root), json.dumps({"coveredEntities": root})):
            _write(path, text)
            got = RD.flatten_entities(spark, path).orderBy("Entity Name").collect()
            assert [(r["Entity Name"], r["Medicaid Billing Number"], r["Street City"]) for r in got] == [("A", "", ""), ("B", "", "")]


def test_landing_refuses_another_header(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "land")
    _write(os.path.join(land, "c_2020.csv"), "b,a\n1,2\n")
    with pytest.raises(Exception):
        ingest_new_files(spark, land, os.path.join(tmpdir_path, "stage"), raw_columns=["a", "b"], schema={"a": "long", "b": "long"}, name=f"x-{os.path.basename(tmpdir_path)}")


def test_dispatch_passes_on_other_errors(spark):
    df = spark.range(1)
    assert G.dispatch_by_column(df, "id", lambda d: d.select("nope"), lambda d: d).columns == ["id"]
    with pytest.raises(ZeroDivisionError):
        G.dispatch_by_column(df, "id", lambda d: 1 / 0, lambda d: d)


def test_a_cluster_must_name_the_shared_folder():
    class Unset:
        master = "spark://host:7077"

        def get(self, key, default=None):
            return default

        def getCheckpointDir(self):
            return None

    class Session:
        conf = sparkContext = Unset()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_conversion_list_fallbacks(spark):
    base = spark.createDataFrame([("1", " Oak Hospital", "tx"), ("2", "General Hospital", None), (None, "x", "tx")], "`CCN ` string, `ORGANIZATION NAME` string, `ENROLLMENT STATE` string")
    extra = spark.createDataFrame([("OAK", "TX ", "CAH"), ("Hospital", None, "PPS"), (None, None, None)], "`Facility` string, `State` string, `Prior Type` string")
    got = {r["Post-REH CCN"]: (r["State"], r["Previous Medicare Payment Type"]) for r in conversion_list(base, extra).collect()}
    assert got == {1: ("tx", "CAH"), 2: (None, "PPS")}  # blank names and NULL states meet, as in pandas
    alone = conversion_list(base.limit(0), extra)
    assert alone.columns == FINAL_COLUMNS
    assert sorted(r["Hospital Name"] for r in alone.collect()) == ["Hospital", "OAK"]
    assert conversion_list(base.limit(0), extra.limit(0)) is None
    assert conversion_list(None, None) is None
    assert conversion_list(base, None).count() == 2

"""fan_in against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators.fanin import fan_in


def test_fan_in_against_python(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        k = rng.choice([None, "hot", "hot", "hot", "a", "b"])
        rows.append((i, k, rng.choice([None, "x", "y", "Z"]), rng.choice([None, 1.5, -2.25, 1e300, 0.1]), rng.choice([None, 10, 9, 100]),
                     rng.choice([None, True, False]), rng.randint(0, 20)))
    rows += [(1000, "empty", None, None, None, None, 3), (1001, "empty", None, None, None, None, 4)]
    df = spark.createDataFrame(rows, "i int, k string, s string, d double, n int, b boolean, day int").repartition(4)
    got = fan_in(df, "k", {"s_mode": "s", "n_mode": "n"}, {"d_first": "d", "b_first": "b"}, {"d_last": "d", "big_last": F.when(F.col("n") > 9, F.col("n"))},
                 F.struct("day", "i"), F.struct("day", "i"), "size")
    assert dict(got.dtypes) == {"k": "string", "size": "bigint", "s_mode": "string", "n_mode": "int", "d_first": "double",
                                "b_first": "boolean", "d_last": "double", "big_last": "int"}
    got = {r.k: r for r in got.collect()}
    assert set(got) == {r[1] for r in rows}
    for k, r in got.items():
        own = sorted((x for x in rows if x[1] == k), key=lambda x: (x[6], x[0]))

        def column(j, keep=lambda v: True):
            return [x[j] for x in own if x[j] is not None and keep(x[j])] or [None]

        def mode(j):
            counts = Counter(v for v in column(j) if v is not None)
            return min(counts, key=lambda v: (-counts[v], v)) if counts else None

        assert (r.size, r.s_mode, r.n_mode) == (len(own), mode(2), mode(4))
        assert (r.d_first, r.b_first, r.d_last, r.big_last) == (column(3)[0], column(5)[0], column(3)[-1], column(4, lambda v: v > 9)[-1])


def test_fan_in_reads_its_input_once(spark, tmpdir_path):
    spark.range(100).selectExpr("id % 7 k", "id a", "cast(id as string) b").write.parquet(f"{tmpdir_path}/t")
    df = spark.read.parquet(f"{tmpdir_path}/t")
    out = fan_in(df, "k", {"m": "b"}, {"f": "a"}, {"l": "a", "lb": "b"}, F.col("a"), F.col("a"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert {(r.k, r.f, r.l) for r in out.collect()} == {(k, k, max(range(k, 100, 7))) for k in range(7)}


def test_fan_in_without_order_or_rows(spark):
    df = spark.createDataFrame([], "k int, a int")
    with pytest.raises(ValueError, match="order"):
        fan_in(df, "k", firsts={"f": "a"})
    assert fan_in(df, "k", {"m": "a"}, size="n").count() == 0
    assert fan_in(spark.createDataFrame([(1, 2), (1, 3)], "k int, a int"), "k").collect() == [(1,)]

"""Places: the fan-out by year is kept, any other is an error."""

import pytest
from pyspark.sql import functions as F

from quarry.plans import enrich as EN

COLUMNS = "Year int, StateAbbr string, LocationName string, Measure string, Data_Value double"


def _panel(spark):
    return spark.createDataFrame([(1, "AL", " LEE "), (2, "AL", "Lee"), (3, "GA", "Lee"), (4, None, "Lee"), (5, "AL", None)], "id int, State string, County string")


def test_years_fan_out_and_percentiles(spark):
    places = [(2020, "AL", "Lee", "a", 1.0), (2021, "AL", "Lee", "a", 2.0), (2020, "AL", "Lee", "b", 7.0), (2021, "GA", "Lee", "a", 2.0), (2021, "GA", "Lee", "z", 9.0)]
    out = EN.enrich(_panel(spark), spark.createDataFrame(places, COLUMNS), ["a", "b"])
    assert out.columns == ["id", "State", "County", "a", "b", "a_PCTL", "b_PCTL"]
    got = sorted((r.id, r.a, r.b, r.a_PCTL, r.b_PCTL) for r in out.where("id IN (1, 3)").na.fill(-1.0).collect())
    # county 1 has two rows: a is of 2021, b of 2020
    assert got == [(1, -1.0, 7.0, -1.0, 100.0), (1, 2.0, -1.0, 75.0, -1.0), (3, 2.0, -1.0, 75.0, -1.0)]
    assert out.count() == 2 + 2 + 1 + 1 + 1 and out.where("id IN (4, 5) AND a IS NOT NULL").count() == 0


def test_another_fan_out_is_an_error(spark):
    places = spark.createDataFrame([(2021, "AL", "Lee", "a", 1.0), (2021, "AL", "lee ", "a", 2.0)], COLUMNS)
    with pytest.raises(Exception, match="places: more than one row"):
        EN.enrich(_panel(spark), places, ["a"]).count()


def test_assert_one_each_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, "b")], "k int, v string")
    assert EN.assert_one_each(df, ["k"], "x").orderBy("v", "k").collect() == df.orderBy("v", "k").collect()
    with pytest.raises(Exception, match='x: more than one row for .*"k0":"a"'):
        EN.assert_one_each(df, [F.lower("v")], "x").count()

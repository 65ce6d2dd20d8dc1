"""The region's panel: padded ids, the newest distance, lookups that are not what they should be."""

from quarry.plans import region as RG

PANEL = [("1.0", "TX", 5.0), ("000002", "TX", 6.0), ("3", "OK", None), ("4", "NY", 7.0), (None, "TX", 8.0)]


def _got(df):
    return sorted(((r.CCN, r[RG.DISTANCE]) for r in df.collect()), key=str)


def test_region_panel(spark):
    df = spark.createDataFrame(PANEL, f"CCN string, State string, {RG.DISTANCE} double")
    lookup = spark.createDataFrame([(" 1", "2020", 1.0), ("1", "2021", 2.0), ("000002", None, 3.0), ("2", "x", 3.0), ("9", "2021", 4.0)],
                                   f"CCN string, Year string, {RG.DISTANCE} double")
    assert _got(RG.region_panel(df, ["TX", "OK"], lookup)) == [("000001", 2.0), ("000002", 3.0), ("000003", None), (None, None)]
    pointer = spark.createDataFrame([("oid sha256:1",)], "`version https://git-lfs` string")
    old = [("000001", 5.0), ("000002", 6.0), ("000003", None), (None, 8.0)]
    for bad in (None, pointer):
        assert _got(RG.region_panel(df, ["TX", "OK"], bad)) == old
        assert _got(RG.region_panel(df.drop(RG.DISTANCE), ["OK"], bad)) == [("000003", None)]
    assert RG.region_panel(df, [], lookup).count() == 0

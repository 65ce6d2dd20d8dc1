"""Unit fixtures for scalar functions (FIXTURES §2: F1, F4, F6-F8, F10-F12, F17,
F19, F20, F22-F25)."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.functions import coerce as C
from quarry.functions import finance as FN
from quarry.functions import temporal as TM
from quarry.functions import text as TX


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_dominant_year_fixture(spark):
    rows = [(dt.date(2019, 4, 1), dt.date(2020, 3, 31)), (dt.date(2021, 7, 2), dt.date(2022, 7, 2)),
            (None, dt.date(2020, 1, 1)), (dt.date(2021, 5, 1), dt.date(2020, 1, 1)),
            (dt.date(2020, 10, 1), dt.date(2022, 9, 30))]
    got = one(spark, TM.dominant_year("b", "e"), rows, "b date, e date")
    assert got == [2019, 2021, None, 2021, 2021]


def test_dominant_year_matches_python(spark):
    import random
    random.seed(7)
    rows = []
    for _ in range(300):
        b = dt.date(2000, 1, 1) + dt.timedelta(days=random.randint(0, 8000))
        rows.append((b, b + dt.timedelta(days=random.randint(-30, 900))))

    def ref(b, e):
        best, bd = b.year, 0
        for y in range(b.year, e.year + 1):
            d = (min(e, dt.date(y, 12, 31)) - max(b, dt.date(y, 1, 1))).days + 1
            if d > bd:
                bd, best = d, y
        return best

    got = one(spark, TM.dominant_year("b", "e"), rows, "b date, e date")
    assert got == [ref(b, e) for b, e in rows]


def test_months_since(spark):
    rows = [(dt.date(2023, 1, 1), dt.date(2023, 12, 31), 1), (dt.date(2023, 6, 1), dt.date(2023, 1, 1), 1),
            (dt.date(2023, 1, 1), None, 1), (dt.date(2023, 1, 1), dt.date(2023, 12, 31), 0)]
    got = one(spark, TM.months_since("ev", "end", "flag"), rows, "ev date, end date, flag int")
    assert got == [12.0, 0.0, None, None]


def test_zero_pad_and_zip(spark):
    got = one(spark, C.zero_pad("s", 6, drop_after_dot=True), [("10001.0",), (" 451385 ",), ("1234567",), (None,)],
              "s string")
    assert got == ["010001", "451385", "1234567", None]
    got = one(spark, C.clean_zip("s"), [("71730-1234",), ("730",), (None,)], "s string")
    assert got == ["71730", "00730", None]


def test_numeric_coercion(spark):
    got = one(spark, C.to_number("s"), [(" 12 ",), ("1,234",), ("0x10",), ("1d",), ("",), ("NA",), ("1e5",)],
              "s string")
    assert got == [12.0, None, None, None, None, None, 100000.0]


def test_lenient_dates(spark):
    rows = [("2021-03-04",), ("3/4/2021",), ("2021-03-04 10:11:12",), ("20210304",), ("2021-02-30",),
            ("March 4",), ("",), (None,)]
    got = one(spark, C.to_date_lenient("s"), rows, "s string")
    d = dt.date(2021, 3, 4)
    assert got == [d, d, d, d, None, None, None, None]


def test_safe_div_and_clip(spark):
    rows = [(1.0, 0.0), (1.0, None), (None, 2.0), (3.0, 2.0)]
    assert one(spark, C.safe_div("a", "b"), rows, "a double, b double") == [None, None, None, 1.5]
    assert one(spark, C.clip("a", 0.0, 1.0), [(None,), (2.0,), (-1.0,)], "a double") == [None, 1.0, 0.0]


def test_text_normalise_and_noise(spark):
    got = one(spark, TX.similarity_text("s"), [("St. Mary's Regional Hospital",)], "s string")
    assert got == ["st mary s"]
    got = one(spark, TX.name_key("s"), [("Healthcare Memorial",)], "s string")
    assert got == ["care"]


def test_char_wb_ngrams(spark):
    got = one(spark, TX.char_wb_ngrams(F.col("s")), [("a ab abc",)], "s string")[0]
    assert got == [" a ", " ab", "ab ", " ab ", " ab", "abc", "bc ", " abc", "abc "]


def test_bucket(spark):
    got = one(spark, FN.bucket("s", FN.FACILITY_BUCKETS), [("Critical Access Hospitals",), (None,), ("STH",)],
              "s string")
    assert got == ["CAH", "Other", "STH"]


def test_period_label(spark):
    d = dt.date
    rows = [(d(2020, 1, 1), d(2020, 12, 31), None), (d(2020, 1, 1), d(2020, 12, 31), d(2020, 12, 31)),
            (d(2021, 1, 1), d(2021, 12, 31), d(2021, 1, 1)), (d(2020, 1, 1), d(2020, 12, 31), d(2020, 6, 1)),
            (None, None, d(2020, 6, 1))]
    got = one(spark, TM.period_label("b", "e", "ev"), rows, "b date, e date, ev date")
    assert got == ["CAH_Year", "CAH_Year", "REH_Year", "Transition", "Transition"]


def test_share_with_fallback(spark):
    rows = [(60.0, 40.0, None), (None, 10.0, 130.0), (0.0, 0.0, 40.0)]
    got = one(spark, FN.share_with_fallback("op", "ip", "pct"), rows, "op double, ip double, pct double")
    assert got == [0.6, 1.0, 0.4]


def test_solvency(spark):
    rows = [(20.0, 0.9, 0.8, -5.0), (45.0, 3.0, 0.2, 4.0), (None, None, None, None), (30.0, 1.0, 0.7, -0.10),
            (90.0, 2.0, 0.5, 0.0)]
    df = spark.createDataFrame(rows, "Days_Cash_on_Hand double, Current_Ratio double, Debt_Ratio double, "
                                     "Operating_Margin_Pct double")
    s = FN.solvency()
    got = [tuple(r) for r in df.select(s["Solvency_Score"], s["Solvency_Status"], s["Solvency_Flags"]).collect()]
    assert got[0] == (8, "Distressed", "DCOH<30, CR<1.0, DR>0.7, OM<-10%")
    assert got[1] == (1, "Stable", "DCOH<90")
    assert got[2] == (0, "Stable", "None")
    assert got[3] == (4, "Distressed", "DCOH<90, CR<2.0, DR>0.5, OM<0%")
    assert got[4] == (0, "Stable", "None")


def test_derived_financials(spark):
    df = spark.createDataFrame([(100.0, 80.0, None), (100.0, 80.0, 0.75), (0.0, 10.0, None)],
                               "rev double, exp double, share double")
    d = FN.derived_financials("rev", "exp", "share")
    got = [tuple(r) for r in df.select(d["Historical_Op_Income"], d["Historical_Op_Margin"], d["IP_Revenue"],
                                       d["OP_Revenue"], d["Swing_Bed_Risk"]).collect()]
    assert got[0] == (20.0, 0.2, 50.0, 50.0, True)
    assert got[1][4] is False
    assert got[2][1] is None


def test_flag_label_and_half_even(spark):
    got = one(spark, FN.flag_label("s"), [("y",), ("N",), ("",), (None,)], "s string")
    assert got == ["CAH", "Short-Term Hospital", None, None]
    got = one(spark, FN.report_round("x", 1), [(0.25,), (2.45,)], "x double")
    assert got == [0.2, 2.4]

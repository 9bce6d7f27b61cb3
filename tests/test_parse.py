"""C0 rules on hand-written bad values."""

import datetime as dt

from pyspark.sql import functions as F

from fieldlake.functions import parse as P
from fieldlake.functions.contact import clean_email, e164
from fieldlake.operators.conform import actual_duration, additional_techs, subscription_frequency


def _one(spark, expr, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_to_int(spark):
    got = _one(spark, lambda c: P.to_int(c, -1), [None, "", " 12 ", "+5", "1.0", "abc", "-3", "7x"])
    assert got == [-1, -1, 12, 5, -1, -1, -3, -1]


def test_to_float(spark):
    got = _one(spark, lambda c: P.to_float(c, 0), [None, "", "1d", "n/a", "2.50", "-1", ".5", "1e2"])
    assert got == [0.0, 0.0, 0.0, 0.0, 2.5, -1.0, 0.5, 100.0]


def test_dates(spark):
    got = _one(spark, P.to_date, ["0000-00-00", "", None, "2024-03-05 08:00:00", "bad"])
    assert got == [None, None, None, dt.date(2024, 3, 5), None]
    ts = _one(spark, P.to_timestamp, ["0000-00-00 00:00:00", "2024-03-05 08:01:02", "2024-03-05T08:01:02"])
    assert ts[0] is None and ts[1] == ts[2] == dt.datetime(2024, 3, 5, 8, 1, 2)


def test_strip_and_flags(spark):
    assert _one(spark, P.strip, [None, " a\t", " b　"]) == ["", "a", "b"]
    assert _one(spark, P.flag, ["1", "true", None, " 1"]) == [True, False, False, False]


def test_duration(spark):
    df = spark.createDataFrame([
        ("2024-01-01 08:00:00", "2024-01-01 08:45:30"),   # 45.5 min
        ("2024-01-01 08:00:00", "2024-01-01 07:30:00"),   # reversed
        ("2024-01-01 08:00:00", "2024-01-01 19:00:00"),   # >= 600 min
        ("0000-00-00 00:00:00", "2024-01-01 09:00:00"),
        ("garbage", "2024-01-01 09:00:00"),
        ("2024-01-01 08:00:00", "2024-01-01 08:01:01"),   # 1.0167 -> 1.02
    ], "a string, b string")
    got = [r[0] for r in df.select(actual_duration(F.col("a"), F.col("b"))).collect()]
    assert got == [45.5, None, None, None, None, 1.02]


def test_additional_techs_and_frequency(spark):
    assert _one(spark, additional_techs, ["[3,4]", "[]", "7", None, '["5", "6"]']) == ["3,4", None, "7", None, "5,6"]
    assert _one(spark, subscription_frequency, ["CUSTOM", " custom ", "", "1.0", None, "30"]) == [-2, -2, 0, 0, 0, 30]


def test_contact_fields(spark):
    phones = _one(spark, e164, ["(702) 555-0101", "1-702-555-0101", "555-0101", "", None, "+1 702 555 0101"])
    assert phones == ["+17025550101", "+17025550101", None, None, None, "+17025550101"]
    assert _one(spark, clean_email, [" A@X.com ", "", None]) == ["a@x.com", None, None]
    first = _one(spark, lambda c: clean_email(c, first_of_list=True), ["a@x.com; b@x.com", "c@x.com,d@x.com"])
    assert first == ["a@x.com", "c@x.com"]


def test_parts_of_dates_are_not_dates(spark):
    from pyspark.sql import functions as F

    from fieldlake.functions.parse import to_date, to_timestamp
    df = spark.createDataFrame([("2024",), ("2024-03",), ("08:00:00",), ("2024-03-05",), ("2024-03-05 08:00:00",)], "x string")
    got = [tuple(map(str, r)) for r in df.select(to_date(F.col("x")), to_timestamp(F.col("x"))).collect()]
    assert got[:3] == [("None", "None")] * 3
    assert got[3] == ("2024-03-05", "2024-03-05 00:00:00") and got[4] == ("2024-03-05", "2024-03-05 08:00:00")

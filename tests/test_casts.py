"""Accept/reject matrix of the typed parsers (JVM parser semantics, see FIXTURES.md section 4)."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import casts
from sparkloom.functions.strings import java_split, jtrim, strip, utf16_length

NULL = None


def parse_all(spark, type_name, values):
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    return [r.v for r in df.select(casts.parse_as(F.col("raw"), type_name).alias("v")).collect()]


def test_integer(spark):
    vals = ["12", "+5", "-7", " 12 ", "12.7", "", NULL, "9223372036854775808", "-9223372036854775808", "1e3", "0012"]
    assert parse_all(spark, "INTEGER", vals) == [12, 5, -7, None, None, None, None, None, -9223372036854775808, None, 12]
    assert parse_all(spark, "LONG", ["42"]) == [42]


def test_date(spark):
    vals = ["2022-05-23", "2022-02-30", "2022", "2022-5-3", "2022-05-23T10:00", NULL, " 2022-05-23"]
    assert parse_all(spark, "DATE", vals) == [dt.date(2022, 5, 23), None, None, None, None, None, None]


def test_datetime(spark):
    vals = ["2022-05-23T13:25", "2022-05-23t13:25:01", "2022-05-23 13:25", "2022-05-23T13:25+01:00",
            "2022-05-23T13:25:01.123456", NULL, "2022-05-23T24:00"]
    got = parse_all(spark, "DATETIME", vals)
    assert got[:2] == [dt.datetime(2022, 5, 23, 13, 25), dt.datetime(2022, 5, 23, 13, 25, 1)]
    assert got[2] is None and got[3] is None and got[5] is None and got[6] is None
    assert got[4] == dt.datetime(2022, 5, 23, 13, 25, 1, 123456)
    more = parse_all(spark, "DATETIME", ["2022-05-23T13:25:01.", "2022-05-23T13:25:01.123456789", "2022-05-23T13:25."])
    assert more == [dt.datetime(2022, 5, 23, 13, 25, 1), dt.datetime(2022, 5, 23, 13, 25, 1, 123456), None]


def test_timestamp(spark):
    vals = ["2022-05-23T13:25:34.123+05:30", "2022-05-23T13:25Z", "2022-05-23T13:25:34", "2022-05-23t13:25:34z",
            "2022-05-23T13:25:34+0530", NULL, "2022-05-23T13:25:34-01:00:30"]
    df = spark.createDataFrame([(v,) for v in vals], "raw string")
    got = [r.us for r in df.select(F.unix_micros(casts.parse_timestamp(F.col("raw"))).alias("us")).collect()]
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)

    def us(*a, **kw):
        return int((dt.datetime(*a, tzinfo=dt.timezone.utc, **kw) - epoch).total_seconds() * 1_000_000)

    assert got[0] == us(2022, 5, 23, 7, 55, 34, microsecond=123000)  # the documented value
    assert got[1] == us(2022, 5, 23, 13, 25)
    assert got[2] is None and got[4] is None and got[5] is None
    assert got[3] == us(2022, 5, 23, 13, 25, 34)
    assert got[6] == us(2022, 5, 23, 14, 26, 4)
    more = spark.createDataFrame([("2022-05-23T13:25:01.Z",), ("2022-05-23T13:25:01.+01:00",)], "raw string")
    got2 = [r.us for r in more.select(F.unix_micros(casts.parse_timestamp(F.col("raw"))).alias("us")).collect()]
    assert got2 == [us(2022, 5, 23, 13, 25, 1), us(2022, 5, 23, 12, 25, 1)]


def test_float(spark):
    vals = ["1.5", " 2 ", "1e3", "1.5d", "2F", "NaN", "Infinity", "-Infinity", "1e400", "nan", "inf", "", NULL,
            "+NaN", ".5", "5.", "0x1p3", "1,5"]
    got = parse_all(spark, "FLOAT", vals)
    assert got[:5] == [1.5, 2.0, 1000.0, 1.5, 2.0]
    assert math.isnan(got[5]) and got[6] == math.inf and got[7] == -math.inf and got[8] == math.inf
    assert got[9:13] == [None, None, None, None]
    assert math.isnan(got[13]) and got[14] == 0.5 and got[15] == 5.0 and got[16] == 8.0 and got[17] is None


def test_numeric(spark):
    vals = ["1E+3", " 1 ", "1.0000000005", "1e40", ".5", "5.", "-2.25", "abc", NULL, "1.5d"]
    got = parse_all(spark, "NUMERIC", vals)
    assert got == [Decimal("1000"), None, Decimal("1.000000001"), None, Decimal("0.5"), Decimal("5"),
                   Decimal("-2.25"), None, None, None]


def test_boolean(spark):
    assert parse_all(spark, "BOOLEAN", ["TRUE", "true", "tRuE", "yes", "1", NULL, "false"]) == [True, True, True, False,
                                                                                                False, False, False]


def test_time(spark):
    vals = ["1:2:3", "25:00:00", "10:20", "-1:00:00", "00:60:00", "1:2:3:4", NULL, "+1:2:3", "a:b:c", "12:34:56"]
    assert parse_all(spark, "TIME", vals) == ["01:02:03", "01:00:00", None, "23:00:00", "01:00:00", None, None,
                                              "01:02:03", None, "12:34:56"]


def test_string_passthrough(spark):
    assert parse_all(spark, "STRING", ["a", NULL, " b "]) == ["a", None, " b "]


def test_unknown_type():
    with pytest.raises(ValueError):
        casts.parse_as(F.col("x"), "GEOGRAPHY")


def test_java_split(spark):
    vals = ["a,b,,", ",", "", ",,b", "a", "a,,b"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.p for r in df.select(java_split(F.col("v")).alias("p")).collect()]
    assert got == [["a", "b"], [], [""], ["", "", "b"], ["a"], ["a", "", "b"]]
    multi = spark.createDataFrame([("a::b::::",), ("::",), ("",), ("a|b||",), (":::::::",)], "v string")
    got2 = [r.p for r in multi.select(java_split(F.col("v"), "::").alias("p")).collect()]
    assert got2 == [["a", "b"], [], [""], ["a|b||"], ["", "", "", ":"]]
    pipes = [r.p for r in multi.select(java_split(F.col("v"), "|").alias("p")).collect()]
    assert pipes == [["a::b::::"], ["::"], [""], ["a", "b"], [":::::::"]]


def test_strip_trim_length(spark):
    df = spark.createDataFrame([(" \t12\u2003\n",), ("\u00a012\u00a0",), ("\x0112\x01",)], "v string")
    rows = df.select(strip("v").alias("s"), jtrim("v").alias("t")).collect()
    assert [r.s for r in rows] == ["12", "\u00a012\u00a0", "\x0112\x01"]
    assert [r.t for r in rows] == ["12\u2003", "\u00a012\u00a0", "12"]
    uni = spark.createDataFrame([("\u3000 12\u2028",), ("\u00a012\u2007",), ("\u1680x\u205f",)], "v string")
    assert [r.s for r in uni.select(strip("v").alias("s")).collect()] == ["12", "\u00a012\u2007", "x"]
    emoji = spark.createDataFrame([("a\U0001F600",)], "v string")
    assert emoji.select(utf16_length("v").alias("n")).collect()[0].n == 3

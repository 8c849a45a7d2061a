import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from starflow.functions import (age_bucket, clean_number, date_columns, date_key, day_of_week0, default_code,
                                from_day_number, iso_week, join_or_unknown, to_date_col, norm_key, split_list, split_location,
                                split_once, stable_id, strip_literal, temperature_bucket, unescape_html)


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_age_bucket_edges(spark):
    ages = [None, float("nan"), -3.0, 0.0, 11.0, 12.0, 17.0, 18.0, 64.0, 65.0, 66.0, 120.0]
    got = one(spark, [(a,) for a in ages], "a double", age_bucket("a"))
    assert [g[0] for g in got] == ["UN", "UN", "CH", "CH", "CH", "TE", "TE", "AD", "AD", "AD", "OA", "OA"]


def test_temperature_bucket_edges(spark):
    temps = [None, float("nan"), -1.0, 4.99, 5.0, 14.99, 15.0, 24.99, 25.0, 34.99, 35.0, 60.0]
    got = one(spark, [(t,) for t in temps], "t double", temperature_bucket("t"))
    assert [g[0] for g in got] == ["UN", "UN", "VC", "VC", "CO", "CO", "MI", "MI", "HO", "HO", "VH", "VH"]


def test_day_number_decode(spark):
    rows = [(20545.0,), (0.0,), (None,), (float("nan"),), (1e300,)]
    got = one(spark, rows, "d double", from_day_number("d"))
    assert [g[0] for g in got] == [dt.date(2016, 4, 1), dt.date(1960, 1, 1), None, None, None]


def test_date_parts(spark):
    rows = [(dt.date(2016, 1, 1),), (dt.date(2016, 4, 3),), (None,)]
    df = spark.createDataFrame(rows, "d date").select(*[c.alias(n) for n, c in date_columns("d").items()])
    got = [tuple(r) for r in df.collect()]
    assert got[0] == (20160101, 2016, 1, 1, 5, 53)   # Friday, ISO week 53
    assert got[1] == (20160403, 2016, 4, 3, 0, 13)   # Sunday = 0
    assert got[2] == (None,) * 6
    assert dict(df.dtypes)["year"] == "smallint" and dict(df.dtypes)["date_id"] == "int"


def test_day_of_week_and_week(spark):
    got = one(spark, [(dt.date(2016, 4, 9),)], "d date", day_of_week0("d"), iso_week("d"), date_key("d"))
    assert got == [(6, 14, 20160409)]


def test_split_location(spark):
    rows = [("New York, NY",), ("Agana",), ("A, B, C",), (None,), ("  Miami ,FL ",)]
    city, state = split_location("s")
    got = one(spark, rows, "s string", city, state)
    assert got == [("New York", "NY"), (None, None), ("A", "B"), (None, None), ("Miami", "FL")]


def test_split_once(spark):
    head, rest = split_once("s")
    got = one(spark, [("A, B, C",), ("Agana",)], "s string", head, rest)
    assert got == [("A", "B, C"), ("Agana", None)]


def test_text_cleaning(spark):
    rows = [("US-NY", "10,000", " X ", "a &amp;lt; b&nbsp;&amp; c")]
    got = one(spark, rows, "r string, v string, g string, h string", strip_literal("r", "US-"), clean_number("v"),
              norm_key("g"), unescape_html("h"))
    assert got == [("NY", 10000.0, "x", "a &lt; b & c")]
    junk = one(spark, [("n/a",), (None,), ("1,158,000.5",)], "v string", clean_number("v"))
    assert [j[0] for j in junk] == [None, None, 1158000.5]


def test_default_code(spark):
    got = one(spark, [("M",), (None,), ("",), ("  ",)], "g string", default_code("g", "U"))
    assert [g[0] for g in got] == ["M", "U", "U", "U"]


def test_list_and_join(spark):
    rows = [("spa,eng",), (None,), ("",)]
    got = one(spark, rows, "l string", split_list("l"), join_or_unknown(split_list("l")))
    assert got[0] == (["spa", "eng"], "spa,eng")
    assert got[1] == (None, "Unknown")
    assert got[2] == ([""], "Unknown")


def test_stable_id(spark):
    rows = [(1, "a"), (1, "a"), (2, None)]
    got = [g[0] for g in one(spark, rows, "k long, v string", stable_id("k", "v"))]
    assert got[0] == got[1] != got[2]
    assert all(len(g) == 36 and [len(p) for p in g.split("-")] == [8, 4, 4, 4, 12] for g in got)
    import hashlib
    h = hashlib.md5(b"1|a").hexdigest()
    assert got[0] == f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def test_to_date_col(spark):
    rows = [("2016-04-01",), ("01/04/2016",), ("junk",), (None,)]
    got = one(spark, rows, "s string", to_date_col("s", "dd/MM/yyyy"), to_date_col("s"))
    assert got == [(None, dt.date(2016, 4, 1)), (dt.date(2016, 4, 1), None), (None, None), (None, None)]
    ts = one(spark, [(dt.datetime(2016, 4, 1, 23, 59),)], "t timestamp_ntz", to_date_col("t"))
    assert ts == [(dt.date(2016, 4, 1),)]

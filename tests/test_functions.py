"""Scalar functions: packing, parsing, dates."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolap.functions.parse import (
    dep_label, flight_date, ntz_from_instant, pack_min_key, parse_int, trunc_minutes,
    unpack_hi, unpack_lo)

i32 = st.integers(min_value=-(2 ** 31), max_value=2 ** 31 - 1)


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=st.lists(st.tuples(i32, i32), min_size=1, max_size=30))
def test_packed_minimum_orders_lexicographically_and_roundtrips(spark, pairs):
    df = spark.createDataFrame(pairs, "hi int, lo int").select(
        "hi", "lo", pack_min_key("hi", "lo").alias("p"))
    rows = df.select("hi", "lo", "p", unpack_hi("p").alias("h2"),
                     unpack_lo("p").alias("l2")).collect()
    assert all((r.hi, r.lo) == (r.h2, r.l2) for r in rows)
    assert [(r.hi, r.lo) for r in sorted(rows, key=lambda r: r.p)] == sorted(pairs)


def test_text_parsing(spark):
    df = spark.createDataFrame(
        [("12.99", "0930", "2008", "2", "29"), ("-3.7", " 45", "2007", "2", "29"),
         ("abc", "", "2008", "13", "1"), ("NaN", "x", "2008", "1", "05")],
        "d string, t string, y string, m string, dd string")
    got = [tuple(r) for r in df.select(
        trunc_minutes("d"), parse_int("t"), flight_date("y", "m", "dd").cast("string"),
        dep_label(F.lit("ORD"), parse_int("t"))).collect()]
    assert got == [(12, 930, "2008-02-29", "ORD@0930"), (-3, 45, None, "ORD@0045"),
                   (None, None, None, None), (None, None, "2008-01-05", None)]


def test_ntz_from_instant_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        out = set()
        for tz in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            out.add(spark.range(1).select(ntz_from_instant(
                F.timestamp_seconds(F.lit(1_000_000_000))).cast("string")).first()[0])
        assert out == {"2001-09-09 01:46:40"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


text = st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc")), min_size=1,
               max_size=8)


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(text, text, text), min_size=1, max_size=20))
def test_concise_line_roundtrip(spark, rows):
    """Any carrier/airport text survives writing and parsing a concise line."""
    from aerolap.schema import CONCISE_FIELDS
    from aerolap.sources.csv import parse_concise, to_concise_line

    df = spark.createDataFrame(rows, "carrier string, origin string, dest string")
    cols = [F.col(c) if c in ("carrier", "origin", "dest") else F.lit("1").alias(c)
            for c in CONCISE_FIELDS]
    lines = df.select(to_concise_line(*cols).alias("value"))
    back = parse_concise(lines).select("carrier", "origin", "dest", "reject_reason").collect()
    assert sorted((r.carrier, r.origin, r.dest) for r in back) == sorted(rows)
    assert all(r.reject_reason is None or r.reject_reason == "invalid date" for r in back)


def test_date_of_parts_makes_the_days_that_text_makes(spark):
    """All months' ends, missing and impossible parts: the same day as through text."""
    from aerolap.functions.parse import date_of_parts
    odd = [None, -1, 0, 1, 2, 4, 12, 13, 28, 29, 30, 31, 32, 999, 1000, 1900, 2000, 2008, 9999, 10000, 123456]
    n = spark.createDataFrame([(v,) for v in odd], "n int")
    rows = n.toDF("y").crossJoin(n.toDF("m")).crossJoin(n.toDF("d"))
    text = F.concat_ws("-", "y", "m", "d").try_cast("date")
    got = rows.where(~date_of_parts(F.col("y"), F.col("m"), F.col("d")).eqNullSafe(text))
    assert got.count() == 0
    assert rows.where(text.isNotNull()).count() > 100


def test_usual_days_are_made_without_text(spark):
    from aerolap.functions.parse import date_of_parts
    rows = spark.createDataFrame([(2008, 5, 6)], "y int, m int, d int")
    plan = rows.select(date_of_parts(F.col("y"), F.col("m"), F.col("d")))._jdf.queryExecution().analyzed().toString()
    assert "make_date(" in plan

"""Hand-written edge rows (concise lines) through parsing and the jobs."""

from __future__ import annotations

import datetime as dt

from conftest import flights, parse

from aerolap.operators.itinerary import best_itineraries, leg_candidates
from aerolap.plans import jobs


def test_truncation_and_time(spark):
    r = parse(spark, ["AA,ORD,LAX,12.99,3.7,0930,2008,1,5,6,19805"]).collect()[0]
    assert (r.dep_delay_min, r.arr_delay_min, r.dep_time) == (12, 3, 930)
    assert r.flight_date == dt.date(2008, 1, 5)
    assert r.reject_reason is None


def test_negative_delay_truncates_toward_zero(spark):
    r = parse(spark, ["AA,ORD,LAX,-3.7,-0.5,0930,2008,1,5,6,1"]).collect()[0]
    assert (r.dep_delay_min, r.arr_delay_min) == (-3, 0)


def test_missing_delays_batch_drops_stream_counts_zero(spark):
    f = flights(spark, ["AA,ORD,LAX,,,,2008,1,5,6,19805"])
    assert jobs.top_carriers_per_airport(f).count() == 0
    rows = jobs.top_carriers_per_airport(f, missing="zero").collect()
    assert [(r.origin, r.carrier, r.total_dep_delay) for r in rows] == [("ORD", "AA", 0)]


def test_popularity_counts_both_ends_and_empty_airport(spark):
    f = flights(spark, ["AA,ORD,ORD,1,1,0800,2008,1,5,6,19805",
                        "AA,,LAX,1,1,0800,2008,1,5,6,19805"])
    got = {r.airport: r.flights for r in jobs.top_airports(f).collect()}
    assert got == {"ORD": 2, "LAX": 1, None: 1}
    # per-airport batch ranking drops the row without an origin
    per = jobs.top_carriers_per_airport(f).collect()
    assert [r.origin for r in per] == ["ORD"]


def _best(spark, lines, **kw):
    return best_itineraries(leg_candidates(flights(spark, lines), **kw)).collect()


def test_one_itinerary(spark):
    rows = _best(spark, ["AA,X,Y,0,5,1159,2008,1,5,6,1", "AA,Y,Z,0,2,1201,2008,1,7,1,1"])
    assert len(rows) == 1
    r = rows[0]
    assert (r.start_date, r.src, r.mid, r.dst, r.total_delay) == (
        dt.date(2008, 1, 5), "X", "Y", "Z", 7)


def test_noon_batch_vs_stream_rule(spark):
    lines = ["AA,X,Y,0,5,1159,2008,1,5,6,1", "AA,Y,Z,0,2,1200,2008,1,7,1,1"]
    assert _best(spark, lines) == []
    assert len(_best(spark, lines, noon_inclusive=True)) == 1


def test_leap_year_and_year_end(spark):
    leap = ["AA,X,Y,0,1,0900,2008,2,28,4,1", "AA,Y,Z,0,1,1500,2008,3,1,6,1"]
    assert len(_best(spark, leap)) == 1
    year_end = ["AA,X,Y,0,1,0900,2007,12,30,7,1", "AA,Y,Z,0,1,1500,2008,1,1,2,1"]
    rows = _best(spark, year_end)
    assert len(rows) == 1 and rows[0].start_date == dt.date(2007, 12, 30)


def test_wrong_gap_does_not_match(spark):
    for day in (6, 8):
        lines = ["AA,X,Y,0,5,1159,2008,1,5,6,1", f"AA,Y,Z,0,2,1201,2008,1,{day},1,1"]
        assert _best(spark, lines) == []


def test_best_pair_is_chosen(spark):
    lines = ["AA,X,Y,0,9,0700,2008,1,5,6,1", "BB,X,Y,0,4,0800,2008,1,5,6,1",
             "AA,Y,Z,0,6,1300,2008,1,7,1,1", "BB,Y,Z,0,1,1400,2008,1,7,1,1",
             "CC,Y,Z,0,1,1330,2008,1,7,1,1"]
    r = _best(spark, lines)[0]
    assert (r.dep1, r.dep2, r.delay1, r.delay2, r.total_delay) == (800, 1330, 4, 1, 5)


def test_rejected_rows(spark):
    reasons = [r.reject_reason for r in parse(spark, [
        "AA,Y,Z,0,2,1300,2008,2,30,6,1",
        "AA,ORD",
        "AA,ORD,LAX,abc,1,0800,2008,1,5,6,1",
        "",
    ]).collect()]
    assert sorted(reasons) == sorted(
        ["invalid date", "too few fields", "bad number", "empty message"])


def test_quoted_carrier(spark):
    r = parse(spark, ['"A""B",ORD,LAX,5,5,0800,2008,1,5,6,1']).collect()[0]
    assert r.carrier == 'A"B' and r.reject_reason is None


def test_ties_rows_vs_distinct(spark):
    f = flights(spark, ["BB,ORD,LAX,5,5,0800,2008,1,5,6,1",
                        "AA,ORD,LAX,5,5,0800,2008,1,5,6,1",
                        "CC,ORD,LAX,7,5,0800,2008,1,5,6,1"])
    rows = jobs.top_carriers_per_airport(f, k=2).orderBy("rank").collect()
    assert [r.carrier for r in rows] == ["AA", "BB"]
    dist = jobs.top_carriers_per_airport(f, k=2, ties="distinct").orderBy("rank").collect()
    assert [(r.carrier, r.total_dep_delay) for r in dist] == [("AA", 5), ("CC", 7)]


def test_strict_mode_raises(spark):
    import pytest
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    from aerolap.sources.csv import parse_concise
    from conftest import lines_df

    df = parse_concise(lines_df(spark, ["AA,ORD"]), strict=True)
    with pytest.raises((PySparkException, Py4JJavaError)):
        df.collect()


def test_numbers_with_blanks_and_garbled_lines_are_read_as_before(spark):
    """Blanks around numbers do not count; undecodable bytes are reported for
    the field that holds them, quoted or not."""
    from aerolap.sources.csv import parse_concise
    lines = [b"AA,ORD,LAX, 12.9 , -3.7, 0930 , 2008, 05 ,29 , 4 ,1", b"AA,ORD,LAX,  ,x, ,2008,2,30,4,1",
             b"AA,\xff,LAX,1,2,0930,2008,5,6,1,1", b'"A,A",ORD,"\xfe",1,2,0930,2008,5,6,1,1']
    df = spark.createDataFrame([(bytearray(x),) for x in lines], "b binary").selectExpr("CAST(b AS STRING) AS value")
    a, b, c, d = parse_concise(df).collect()
    assert (a.dep_delay_min, a.arr_delay_min, a.dep_time, str(a.flight_date), a.day_of_week) == (12, -3, 930, "2008-05-29", 4)
    assert a.reject_reason is None and a.bad_fields == []
    assert b.bad_fields == ["dep_delay_min", "arr_delay_min", "dep_time", "flight_date"] and b.reject_reason == "bad number"
    assert (c.bad_fields, c.reject_reason) == (["origin"], "bad encoding")
    assert (d.carrier, d.bad_fields, d.reject_reason) == ("A,A", ["dest"], "bad encoding")

"""Rejection by field: a fault costs only the jobs that need its column."""

from __future__ import annotations

import os
import subprocess
import sys
import zipfile

import pytest
from conftest import parse

from aerolap.plans import jobs
from aerolap.schema import RAW_HEADER_NAMES
from aerolap.session import local_path
from aerolap.sources import csv as C
from aerolap.sources.files import arrow_uri, read_zipped
from aerolap.sources.ingest import ingest, read_ingested, read_rejected
from aerolap.sources.kv_text import read_kv_text, write_kv_text

FAULTY = [
    "AA,ORD,LAX,12.9,abc,0930,2008,1,5,6,19805",      # arrival delay
    "BB,ORD,LAX,1,1,0800,2008,1,5,x,19806",           # day of week
    "CC,ORD,LAX,5,2,1300,2008,2,30,1,19807",          # no such day
    "DD,ORD,LAX,7,2,1300,2008,1,5,1,19808",
]


def test_unrelated_faults_cost_no_row(spark):
    p = parse(spark, FAULTY)
    assert {r.carrier: r.bad_fields for r in p.collect()} == {
        "AA": ["arr_delay_min"], "BB": ["day_of_week"], "CC": ["flight_date"], "DD": []}
    airports = jobs.top_airports(C.accepted(p, jobs.needs("top-airports"))).collect()
    assert {r.airport: r.flights for r in airports} == {"ORD": 4, "LAX": 4}
    q3 = jobs.top_carriers_per_airport(C.accepted(p, jobs.needs("carriers-per-airport"))).collect()
    assert [r.carrier for r in q3] == ["BB", "CC", "DD", "AA"]
    q2 = jobs.top_airlines(C.accepted(p, jobs.needs("top-airlines"))).collect()
    assert {r.airline_id for r in q2} == {"19806", "19807", "19808"}
    assert C.accepted(p).count() == 1


def test_short_line_keeps_the_fields_it_has(spark):
    r = parse(spark, ["AA,ORD,LAX"]).first()
    assert r.reject_reason == "too few fields" and r.raw_line == "AA,ORD,LAX"
    assert r.bad_fields == ["dep_delay_min", "arr_delay_min", "dep_time", "flight_date", "day_of_week", "airline_id"]
    assert C.accepted(parse(spark, ["AA,ORD,LAX"]), ["origin", "dest"]).count() == 1
    assert C.accepted(parse(spark, ["AA,ORD", "  ", ""]), ["origin", "dest"]).count() == 0


def test_ingest_writes_once_and_keeps_raw_lines(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/f.csv", "w") as fh:
        fh.write("\n".join([*FAULTY, "AA,ORD"]) + "\n")
    ingest(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")
    assert read_ingested(spark, f"{tmp_dir}/out").count() == 1
    assert read_ingested(spark, f"{tmp_dir}/out", ["origin", "dest"]).count() == 4
    bad = {r.raw_line: r.reject_reason for r in read_rejected(spark, f"{tmp_dir}/out").collect()}
    assert bad == {FAULTY[0]: "bad number", FAULTY[1]: "bad number", FAULTY[2]: "invalid date",
                   "AA,ORD": "too few fields"}


def test_year_prunes_ingested_folders(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/f.csv", "w") as fh:
        fh.write("".join(f"AA,X,Y,0,1,0900,{y},12,30,6,1\nAA,Y,Z,0,1,1500,{y + 1},1,1,6,1\n" for y in range(2000, 2010)))
    ingest(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")
    best = jobs.itinerary_best(read_ingested(spark, f"{tmp_dir}/out", jobs.needs("itineraries")), year=2005)
    assert [(r.start_date.year, r.dst) for r in best.collect()] == [(2005, "Z")]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PartitionFilters: []" not in plan


def _raw(path, header, rows, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding=encoding) as fh:
        fh.write("\r\n".join([",".join(header), *rows]) + "\r\n")


ROW = "AA,ORD,LAX,12.99,3.70,0930,2008,1,5,6,19805"


def test_raw_short_rows_encoding_and_blank_lines(spark, tmp_dir):
    back = list(reversed(RAW_HEADER_NAMES))
    _raw(f"{tmp_dir}/r/a.csv", RAW_HEADER_NAMES, [ROW, "", "AA,ORD", "\xe9\xe9,ORD,LAX,1,1,0900,2008,1,5,6,1"], "latin-1")
    _raw(f"{tmp_dir}/r/b/a.csv", ["Extra", *back], ["x," + ",".join(reversed(ROW.split(",")))])
    os.makedirs(f"{tmp_dir}/z")
    with zipfile.ZipFile(f"{tmp_dir}/z/one.zip", "w") as zf:
        zf.write(f"{tmp_dir}/r/a.csv", "x/a.csv")
        zf.write(f"{tmp_dir}/r/b/a.csv", "y/a.csv")
    for fields in (C.read_raw(spark, f"{tmp_dir}/r"), read_zipped(spark, f"{tmp_dir}/z")):
        rows = C.typed_from_fields(fields).collect()
        assert sorted(str(r.reject_reason) for r in rows) == ["None", "None", "bad encoding", "too few fields"]
        good = [r for r in rows if r.reject_reason is None]
        assert {(r.carrier, r.dep_delay_min, r.dep_time, r.raw_line) for r in good} == {("AA", 12, 930, None)}
        odd = next(r for r in rows if r.reject_reason == "bad encoding")
        assert odd.bad_fields == ["carrier"] and odd.raw_line.endswith("2008,1,5,6,1")


def test_schemes():
    assert arrow_uri("s3a://b/k") == "s3://b/k" and arrow_uri("gs://b/k") == "gs://b/k"
    assert arrow_uri("hdfs:/x") == "hdfs:/x" and arrow_uri("/plain/path") == "/plain/path"
    with pytest.raises(ValueError, match="scheme"):
        arrow_uri("odd:/x/y")
    assert local_path("odd:/x/y") is None and local_path("s3a://b") is None
    assert local_path("file:///a/b") == "/a/b" and local_path("file:/a/b") == "/a/b"


def test_workers_import_the_package_from_any_folder(tmp_dir):
    """A driver started elsewhere: its workers get the package with the application."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    _raw(f"{tmp_dir}/r/a.csv", RAW_HEADER_NAMES, [ROW])
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from aerolap.session import build_session\n"
            "s = build_session('local[2]', shuffle_partitions=2)\n"
            "from aerolap.sources import csv as C\n"
            f"print('ROWS', C.typed_from_fields(C.read_raw(s, {tmp_dir + '/r'!r})).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, capture_output=True, text=True,
                         timeout=200)
    assert "ROWS 1" in run.stdout, run.stderr[-2000:]


def test_key_value_parts_survive(spark, tmp_dir):
    odd = [None, "", "a,b", "a\tb", "\\", "\\N", "\\c", "x\ny", "x\ry", " é "]
    rows = [(a, b, i, None if i % 3 else i) for i, (a, b) in enumerate((a, b) for a in odd for b in odd)]
    df = spark.createDataFrame(rows, "a string, b string, n int, v int")
    write_kv_text(df, f"{tmp_dir}/kv", ["a", "b"], ["n", "v"])
    back = read_kv_text(spark, f"{tmp_dir}/kv", ["a", "b"], ["n", "v"], types={"n": "int", "v": "int"})
    assert sorted(map(tuple, back.collect()), key=lambda r: r[2]) == rows
    with open(f"{tmp_dir}/short.txt", "w") as fh:
        fh.write("only\n")
    assert tuple(read_kv_text(spark, f"{tmp_dir}/short.txt", ["a", "b"], ["n"]).first()) == ("only", None, None)


def test_split_lines_are_what_the_csv_parser_reads(spark):
    """Lines that are split at their commas against the parser's fields."""
    from pyspark.sql import functions as F

    from aerolap.schema import CONCISE_DDL, CONCISE_FIELDS
    from aerolap.sources.csv import CSV_OPTIONS, field_at, field_count, split_line

    row = "AA,ORD,LAX,5.00,7.00,0930,2008,1,2,3,19805"
    lines = [row, row + ",x,", row[:9], "a", ",", ",,,", "\t", " a ,\t, b", "é�,\\,'", 'a,"b,c",d', 'a"b,c', '"open,',
             "a,b\nc,d", "a\rb,c", "\0a,b", "#a,b", ",".join("ab" * 30), "x" * 25_000 + ",b", "", "  "]
    df = split_line(spark.createDataFrame([(x,) for x in lines], "v string"), "v", CONCISE_DDL, CSV_OPTIONS)
    both = df.select(
        "v", "_n", field_count(F.col("v")).alias("count"), F.col("_parts").isNotNull().alias("split"),
        F.struct(*(F.nullif(field_at(i, n), F.lit("")).alias(n) for i, n in enumerate(CONCISE_FIELDS))).alias("got"),
        F.from_csv("v", CONCISE_DDL, CSV_OPTIONS).alias("want")).collect()
    assert sum(r.split for r in both) == 11
    for r in both:
        assert tuple(r.got) == tuple(x or None for x in r.want) and r._n == r["count"], r.v

"""The command line runs the jobs end to end on files."""

from __future__ import annotations

import os

import pytest

from aerolap.__main__ import main

LINES = [
    "AA,ORD,LAX,12.99,3.7,0930,2008,1,5,6,19805",
    "BB,ORD,LAX,1,1,0800,2008,1,5,6,19806",
    "AA,LAX,SFO,5,2,1300,2008,1,7,1,19805",
    "AA,ORD",
]


def _read_text(path):
    out = []
    for f in sorted(os.listdir(path)):
        if f.startswith("part-"):
            with open(os.path.join(path, f)) as fh:
                out.extend(line.rstrip("\n") for line in fh if line.strip())
    return out


def test_cli_batch_jobs(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    with open(f"{src}/flights.csv", "w") as fh:
        fh.write("\r\n".join(LINES) + "\r\n")
    main(["carriers-per-airport", "--input", src, "--output", f"{tmp_dir}/q3",
          "--format", "text"])
    assert _read_text(f"{tmp_dir}/q3") == ["LAX\tAA,5", "ORD\tBB,1", "ORD\tAA,12"]
    main(["top-airports", "--input", src, "--output", f"{tmp_dir}/q1", "--format", "text",
          "--top", "1"])
    assert _read_text(f"{tmp_dir}/q1") == ["LAX\t3"]
    main(["itineraries", "--input", src, "--output", f"{tmp_dir}/q6", "--format", "text"])
    # best pair: the 08:00 first leg (arrival delay 1) beats 09:30 (3)
    assert _read_text(f"{tmp_dir}/q6") == ["2008-01-05,ORD@0800,LAX@1300,SFO\t3"]
    main(["ingest", "--input", src, "--output", f"{tmp_dir}/pq"])
    main(["top-airlines", "--input", f"{tmp_dir}/pq", "--input-format", "parquet",
          "--output", f"{tmp_dir}/q2"])
    rows = spark.read.parquet(f"{tmp_dir}/q2").orderBy("rank").collect()
    assert [(r.airline_id, r.total_arr_delay) for r in rows] == [("19806", 1), ("19805", 5)]


def test_cli_options_and_names(spark, tmp_dir, capsys):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    with open(f"{src}/flights.csv", "w") as fh:
        fh.write("\n".join([*LINES, "CC,ORD,LAX,abc,1,0800,2008,1,5,6,1"]) + "\n")
    main(["itineraries", "--pairs", "summary", "--input", src, "--output", f"{tmp_dir}/s", "--format", "text"])
    assert _read_text(f"{tmp_dir}/s") == ["2008-01-05,ORD,LAX,SFO\t3,3,5,11"]
    main(["itineraries", "--pairs", "k-best", "--k", "1", "--input", src, "--output", f"{tmp_dir}/k"])
    assert spark.read.parquet(f"{tmp_dir}/k").first().n_pairs == 3
    with pytest.raises(SystemExit):
        main(["itineraries", "--pairs", "k-best", "--input", src, "--output", f"{tmp_dir}/x"])
    main(["top-airlines", "--input", src, "--output", f"{tmp_dir}/m", "--metric", "mean", "--delay", "dep_delay_min"])
    assert "mean_dep_delay" in spark.read.parquet(f"{tmp_dir}/m").columns
    with pytest.raises(Exception, match="rejected flight row"):
        main(["top-airports", "--input", src, "--output", f"{tmp_dir}/y", "--strict"])


def test_cli_stream_windows(spark, tmp_dir):
    src = f"{tmp_dir}/msgs"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as fh:
        fh.write("\n".join([*LINES, "FLUSH,X,Y,0,0,0900,2999,1,1,2,0"]) + "\n")
    main(["stream-carriers-per-airport", "--path", src, "--output", f"{tmp_dir}/w", "--checkpoint", f"{tmp_dir}/ck",
          "--trigger", "available_now", "--mode", "window", "--window", "1 hour", "--watermark", "0 seconds",
          "--state-partitions", "2", "--max-files-per-trigger", "1"])
    hours = {(r.airport, r.window_start.hour) for r in spark.read.parquet(f"{tmp_dir}/w").collect()}
    assert hours == {("ORD", 9), ("ORD", 8), ("LAX", 13)}


def test_cli_stream_job(spark, tmp_dir):
    from aerolap.streaming.upsert import latest_per_key

    src = f"{tmp_dir}/msgs"
    os.makedirs(src)
    with open(f"{src}/batch0.txt", "w") as fh:
        fh.write("\n".join(LINES + ["AA,ORD,LAX,,,,2008,1,5,6,19805"]) + "\n")
    main(["stream-carriers-per-airport", "--path", src, "--output", f"{tmp_dir}/q7",
          "--checkpoint", f"{tmp_dir}/ck7", "--trigger", "available_now"])
    rows = {r.airport: (list(r.top_carriers), list(r.top_carriers_depdelay))
            for r in latest_per_key(spark, f"{tmp_dir}/q7", ["airport"]).collect()}
    # the stream rule counts the missing delay as 0; the short line is rejected
    assert rows == {"ORD": (["BB", "AA"], [1, 12]), "LAX": (["AA"], [5])}

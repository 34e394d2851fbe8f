"""Streams: the same rows through a file stream give the batch result."""

from __future__ import annotations

import duckdb
from conftest import SF_SMALL

import __spark_entry__ as E
from aerolap.sources.tables import TABLES
from tools.check_oracle import digest


def _oracle(name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = c.sql(E.oracle_sql()[name])
    return rel.columns, rel.fetchall()


def _check(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    ocols, orows = _oracle(name)
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


def test_per_batch_upsert_equals_latest_bucket(spark):
    _check(spark, "stream_top_carriers_per_route")


def test_running_totals_equal_batch(spark):
    _check(spark, "stream_running_topk")


def test_event_time_windows(spark):
    _check(spark, "stream_window_topk")


def test_stream_itinerary_per_batch(spark):
    _check(spark, "stream_itinerary")


def test_running_itinerary_equals_batch_best(spark):
    _check(spark, "stream_itinerary_running")


def test_cluster_conf_scales_with_input():
    from aerolap.session import cluster_conf

    small = cluster_conf(10 << 30)
    big = cluster_conf(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)


def test_kafka_source_needs_its_connector(spark):
    import pytest

    from aerolap.streaming.source import message_stream

    with pytest.raises(ValueError):
        message_stream(spark, "kafka")  # topics and servers are required
    with pytest.raises(Exception, match="(?i)kafka"):
        message_stream(spark, "kafka", topics="flights", bootstrap="localhost:9")


def test_windowed_itinerary_equals_batch_best(spark):
    _check(spark, "stream_itinerary_window")


def test_state_partitions_leave_session_setting_alone(spark, tmp_dir):
    from aerolap.streaming import rankings as R
    from aerolap.streaming.replay import run_until_done
    from aerolap.streaming.source import message_stream, parsed_stream

    import os
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.txt", "w") as fh:
        fh.write("AA,ORD,LAX,5,5,0800,2008,1,5,6,1\n")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    parsed = parsed_stream(message_stream(spark, "files", f"{tmp_dir}/in"))
    q = R.start_ranking(parsed, R.CARRIERS_PER_AIRPORT, f"{tmp_dir}/out", f"{tmp_dir}/ck",
                        mode="running", trigger="available_now", state_partitions=3)
    run_until_done(q)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    state = os.listdir(f"{tmp_dir}/ck/state/0")
    assert len([s for s in state if s.isdigit()]) == 3  # one folder per state partition

"""Recorded messages replayed by a clock: order, restart, pace, pruning."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from aerolap.sources.recording import RecordingReader, paced_stream, record, span

DAY = 86_400


def put(spark, path, times, **kw):
    """Messages ``m<i>`` at ``times[i]`` seconds, None for no time."""
    rows = spark.createDataFrame([(f"m{i}", t) for i, t in enumerate(times)], "value string, t bigint").repartition(4)
    return record(rows, F.timestamp_seconds("t"), path, **kw)


def start(spark, path, out, ckpt, speed):
    def write(df, batch_id):
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    return (paced_stream(spark, path, speed, "test").writeStream.foreachBatch(write)
            .option("checkpointLocation", ckpt).trigger(processingTime="0 seconds").start())


def test_times_never_fall_and_a_restart_loses_nothing(spark, tmp_dir):
    path, out, ckpt = (f"{tmp_dir}/{x}" for x in ("rec", "out", "ckpt"))
    # no order in time, a third at one time, two without any
    times = [(i * 7919) % 1000 * DAY for i in range(600)] + [500 * DAY] * 300 + [None, None]
    whole = put(spark, path, times)
    assert whole == {"messages": 902, "first": 0, "last": 999 * DAY * 1_000_000} == span(path)
    q = start(spark, path, out, ckpt, 100 * DAY)             # ten seconds in all
    while q.isActive and (q.lastProgress is None or q.lastProgress["batchId"] < 2):
        time.sleep(0.1)
    assert q.exception() is None
    q.stop()
    assert 0 < spark.read.parquet(out).count() < 902
    q = start(spark, path, out, ckpt, 100 * DAY)
    q.processAllAvailable()
    q.stop()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.value for r in rows) == sorted(f"m{i}" for i in range(902))
    batches = {}
    for r in rows:
        assert r["at"] == (times[int(r.value[1:])] or 0) * 1_000_000
        batches.setdefault(r.batch_id, []).append(r["at"])
    spans = [(min(a), max(a)) for _, a in sorted(batches.items())]
    assert len(spans) >= 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_the_clock_sets_the_pace_and_stands_still_while_stopped(spark, tmp_dir):
    path = f"{tmp_dir}/rec"
    put(spark, path, [10, 20, 100_000])
    options = {"path": path, "reader": "r", "speed": "50"}
    one = RecordingReader(options)
    assert one.initialOffset() == {"at": 10_000_000 - 1}
    a, t = one.latestOffset()["at"], time.monotonic()
    time.sleep(0.4)
    b = one.latestOffset()["at"]
    assert 0.3 * 50e6 < b - a < (time.monotonic() - t + 0.1) * 50e6
    time.sleep(0.3)
    again = RecordingReader(options).latestOffset()["at"]
    assert b <= again < b + 0.2 * 50e6                       # a query that is started again
    assert RecordingReader(options | {"speed": "1e9"}).latestOffset()["at"] <= 100_000_000_000
    with pytest.raises(ValueError):
        one.partitions({"at": b}, {"at": a})


def test_a_batch_opens_only_files_of_its_times(spark, tmp_dir):
    path = f"{tmp_dir}/rec"
    put(spark, path, list(range(2000)) + [None], rows_per_file=100)
    reader = RecordingReader({"path": path, "reader": "r"})
    assert len(reader.index["files"]) >= 20
    pieces = reader.partitions({"at": 500_000_000}, {"at": 510_000_000})
    assert 1 <= len(pieces) <= 2
    values = [v for p in pieces for b in reader.read(p) for v in b.column("value").to_pylist()]
    assert sorted(values) == sorted(f"m{i}" for i in range(501, 511))
    first = [v for p in reader.partitions({"at": -1}, {"at": 0}) for b in reader.read(p) for v in b.column(0).to_pylist()]
    assert sorted(first) == ["m0", "m2000"]                  # the undated one comes first


def test_empty_recordings_and_wrong_use(spark, tmp_dir):
    path = f"{tmp_dir}/rec"
    assert put(spark, path, [])["messages"] == 0
    with pytest.raises(ValueError):
        put(spark, path, [1])                                # a path takes one recording
    reader = RecordingReader({"path": path, "reader": "r"})
    end = reader.initialOffset() | reader.latestOffset()
    assert [list(reader.read(p)) for p in reader.partitions({"at": -1}, end)] == [[]]
    put(spark, f"{tmp_dir}/undated", [None, None, None])
    q = start(spark, f"{tmp_dir}/undated", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", 1)
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 3
    for wrong in ({"reader": ""}, {"reader": "r", "speed": "0"}):
        with pytest.raises(ValueError):
            RecordingReader({"path": path} | wrong)


def test_messages_of_a_recording_are_made_once(spark, tmp_dir):
    from pyspark.sql import functions as F

    from aerolap.sources.recording import record

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    messages = spark.range(500).select(F.col("id").cast("string").alias("value")).mapInArrow(count, "value string")
    whole = record(messages, F.timestamp_seconds(F.col("value").cast("bigint")), f"{tmp_dir}/r")
    assert whole["messages"] == 500 and made.value == 500

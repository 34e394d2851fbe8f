"""The message log as a stream: offsets, restarts, limits, commits."""

from __future__ import annotations

import json
import time

import pytest

from aerolap.sources import commits
from aerolap.sources.log import LogReader, append, log_stream
from aerolap.streaming.replay import run_until_done


def put(spark, log, texts, **kw):
    return append(spark.createDataFrame([(t,) for t in texts], "value string"), log, **kw)


def start(spark, log, out, ckpt, **kw):
    return (log_stream(spark, log, **kw).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", ckpt))


def test_restart_finds_every_message_once(spark, tmp_dir):
    log, out, ckpt = (f"{tmp_dir}/{x}" for x in ("log", "out", "ckpt"))
    put(spark, log, [f"a{i}" for i in range(500)], partitions=3)
    run_until_done(start(spark, log, out, ckpt, starting_offsets="earliest").trigger(availableNow=True).start())
    ends = put(spark, log, [f"b{i}" for i in range(300)])
    assert sum(ends.values()) == 800 and len(ends) == 3          # the topic keeps its partitions
    run_until_done(start(spark, log, out, ckpt, starting_offsets="earliest").trigger(availableNow=True).start())
    rows = spark.read.parquet(out).collect()
    assert sorted(r.value for r in rows) == sorted([f"a{i}" for i in range(500)] + [f"b{i}" for i in range(300)])
    assert sorted((r.partition, r.offset) for r in rows) == sorted((int(p), o) for p, n in ends.items() for o in range(n))


def test_stop_in_the_middle_of_the_log(spark, tmp_dir):
    """Batches of at most 40; stopped after a few, and started again."""
    log, out, ckpt = (f"{tmp_dir}/{x}" for x in ("log", "out", "ckpt"))
    put(spark, log, [f"m{i}" for i in range(400)], partitions=4)
    kw = {"starting_offsets": "earliest", "max_offsets_per_trigger": 40, "reader": "test"}
    q = start(spark, log, out, ckpt, **kw).trigger(processingTime="0 seconds").start()
    while q.lastProgress is None or q.lastProgress["batchId"] < 2:
        time.sleep(0.2)
    assert all(p["numInputRows"] <= 40 for p in q.recentProgress)
    q.stop()
    seen = spark.read.parquet(out).count()
    assert 0 < seen < 400
    q = start(spark, log, out, ckpt, **kw).trigger(processingTime="0 seconds").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == sorted(f"m{i}" for i in range(400))


def test_where_a_new_stream_starts(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    ends = put(spark, log, [f"m{i}" for i in range(50)], partitions=2)
    assert LogReader({"path": log}).initialOffset() == ends
    assert LogReader({"path": log, "startingOffsets": "earliest"}).initialOffset() == {"0": 0, "1": 0}
    asked = json.dumps({"1": ends["1"] - 1})
    assert LogReader({"path": log, "startingOffsets": asked}).initialOffset() == {"0": 0, "1": ends["1"] - 1}
    with pytest.raises(ValueError):
        LogReader({"path": log, "startingOffsets": json.dumps({"1": 10_000})}).initialOffset()


def test_a_batch_opens_only_the_folders_it_needs(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    steps = [put(spark, log, [f"{n}-{i}" for i in range(30)], partitions=2) for n in range(4)]
    reader = LogReader({"path": log, "startingOffsets": "earliest"})
    assert len({p.folder.rsplit("/", 2)[1] for p in reader.partitions(steps[1], steps[2])}) == 1
    assert len({p.folder.rsplit("/", 2)[1] for p in reader.partitions({"0": 0, "1": 0}, steps[3])}) == 4


def test_limit_is_shared_and_used_up(tmp_dir):
    options = {"path": tmp_dir, "maxOffsetsPerTrigger": "10", "reader": "r", "startingOffsets": "earliest"}
    reader = LogReader(options)
    reader._ends = lambda: {"0": 100, "1": 1, "2": 0}
    assert reader.latestOffset() == {"0": 9, "1": 1, "2": 0}
    assert reader.latestOffset() == {"0": 19, "1": 1, "2": 0}
    reader = LogReader(options)                                  # another process goes on
    reader._ends = lambda: {"0": 100, "1": 1, "2": 0}
    assert reader.latestOffset() == {"0": 29, "1": 1, "2": 0}
    with pytest.raises(ValueError):
        LogReader({"path": tmp_dir, "maxOffsetsPerTrigger": "10"})


def test_a_number_is_published_once(spark, tmp_dir):
    assert commits.publish(spark, f"{tmp_dir}/c", 0, {"by": 1})
    assert not commits.publish(spark, f"{tmp_dir}/c", 0, {"by": 2})
    assert commits.numbers(f"{tmp_dir}/c") == [0] and commits.read(f"{tmp_dir}/c", 0) == {"by": 1}


def test_a_commit_that_comes_first_moves_the_offsets(spark, tmp_dir, monkeypatch):
    """Another writer takes the number between numbering and publishing."""
    log = f"{tmp_dir}/log"
    put(spark, log, ["x"] * 4, partitions=1)
    real, calls = commits.publish, []

    def contended(spark_, folder, number, doc):
        if not calls:
            calls.append(number)
            other = {"folder": commits.read(folder, 0)["folder"], "starts": {"0": 4}, "ends": {"0": 8}}
            assert real(spark_, folder, number, other)
        return real(spark_, folder, number, doc)

    monkeypatch.setattr(commits, "publish", contended)
    assert put(spark, log, ["y"] * 2) == {"0": 10}
    assert commits.read(f"{log}/_commits", 2)["starts"] == {"0": 8}

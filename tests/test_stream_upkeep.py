"""Streams that run for long: one evaluation per batch, bounded folders, late
rows, sub-day windows, console output and Kafka options."""

from __future__ import annotations

import os

import pytest

from aerolap.streaming import rankings as R
from aerolap.streaming.itinerary import start_itinerary, start_itinerary_lists, start_itinerary_running
from aerolap.streaming.replay import run_until_done
from aerolap.streaming.source import kafka_options, message_stream, parsed_stream
from aerolap.streaming.upsert import fold_batches, latest_per_key, newest_batch, read_batches


def feed(tmp_dir, name, lines):
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    with open(f"{tmp_dir}/in/{name}", "w") as fh:
        fh.write("\n".join(lines) + "\n")


def stream(spark, tmp_dir, **kw):
    return parsed_stream(message_stream(spark, "files", f"{tmp_dir}/in", **kw))


LEGS = ["AA,X,Y,1,1,0900,2008,1,5,6,1", "BB,X,Y,2,2,1000,2008,1,5,6,1", "AA,Y,Z,3,3,1500,2008,1,7,1,1"]


def test_state_operator_runs_once_per_batch(spark, tmp_dir):
    feed(tmp_dir, "a", LEGS)
    q = start_itinerary_running(stream(spark, tmp_dir), f"{tmp_dir}/out", f"{tmp_dir}/ck", "available_now", 2)
    run_until_done(q)
    state = q.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 2 and state["numRowsUpdated"] == 2      # one per leg key
    assert [r.total_delay for r in newest_batch(spark, f"{tmp_dir}/out").collect()] == [4]


def test_complete_streams_keep_few_folders(spark, tmp_dir):
    for i in range(5):
        feed(tmp_dir, f"f{i}", [f"AA,ORD,LAX,{i},1,0900,2008,1,5,6,1"])
        run_until_done(R.start_ranking(stream(spark, tmp_dir), R.CARRIERS_PER_AIRPORT, f"{tmp_dir}/out",
                                       f"{tmp_dir}/ck", mode="running", trigger="available_now", state_partitions=2))
    folders = [f for f in os.listdir(f"{tmp_dir}/out") if f.startswith("batch_id=")]
    assert len(folders) <= 2
    assert newest_batch(spark, f"{tmp_dir}/out").first().top_carriers_depdelay == [10]


def test_changes_write_only_the_groups_that_changed(spark, tmp_dir):
    """Rows and bytes of a trigger follow from its groups, not from all groups;
    the table equals running totals, through folds and an idle trigger."""
    totals, sizes = {}, {}

    def run(i, lines):
        feed(tmp_dir, f"f{i}", lines)
        run_until_done(R.start_ranking(stream(spark, tmp_dir), R.CARRIERS_PER_AIRPORT, f"{tmp_dir}/out", f"{tmp_dir}/ck",
                                       mode="changes", k=2, trigger="available_now", state_partitions=2, fold_every=2))
        for line in lines:
            c, o, _, d = line.split(",")[:4]
            totals.setdefault(o, {}).setdefault(c, 0)
            totals[o][c] += int(d)
        want = {o: sorted(((v, c) for c, v in cs.items()))[:2] for o, cs in totals.items()}
        got = {r.airport: list(zip(r.top_carriers_depdelay, r.top_carriers))
               for r in latest_per_key(spark, f"{tmp_dir}/out", ["airport"]).collect()}
        assert got == want

    def flight(c, o, d):
        return f"{c},{o},LAX,{d},1,0900,2008,1,5,6,1"

    def written(table, i):
        folder = f"{tmp_dir}/{table}/batch_id={i}"
        files = [os.path.join(r, f) for r, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")]
        return spark.read.parquet(folder).count(), sum(map(os.path.getsize, files))

    run(0, [flight(c, f"P{i}", i) for i in range(300) for c in ("AA", "BB", "CC")])
    sizes[0] = written("out", 0), written("out_totals", 0)
    run(1, [flight("AA", "P7", 500), flight("DD", "P8", -3)])
    sizes[1] = written("out", 1), written("out_totals", 1)
    assert [n for n, _ in sizes[0]] == [300, 900] and [n for n, _ in sizes[1]] == [2, 2]
    assert sizes[1][1][1] * 10 < sizes[0][1][1]
    for i in range(2, 6):
        run(i, [flight("BB", f"P{i}", -i), flight("EE", "NEW", i)])
    folders = [f for f in os.listdir(f"{tmp_dir}/out_totals") if f.startswith("_snapshot")]
    assert folders == ["_snapshot"]
    run(6, [])
    run(7, [flight("AA", "P7", -1000)])


def test_changes_begin_with_an_empty_batch(spark, tmp_dir):
    def run(name, *lines):
        feed(tmp_dir, name, lines)
        run_until_done(R.start_ranking(stream(spark, tmp_dir), R.CARRIERS_PER_AIRPORT, f"{tmp_dir}/out", f"{tmp_dir}/ck",
                                       mode="changes", trigger="available_now", state_partitions=2))

    run("a", "too,few")
    run("b", *LEGS)
    assert {r.airport: r.top_carriers for r in latest_per_key(spark, f"{tmp_dir}/out", ["airport"]).collect()} == {
        "X": ["AA", "BB"], "Y": ["AA"]}


def test_folding_bounds_what_a_reader_touches(spark, tmp_dir):
    def run(i):
        feed(tmp_dir, f"f{i}", [f"AA,P{i % 3},LAX,{i},1,0900,2008,1,5,6,1"])
        run_until_done(R.start_ranking(stream(spark, tmp_dir), R.CARRIERS_PER_AIRPORT, f"{tmp_dir}/out",
                                       f"{tmp_dir}/ck", trigger="available_now"))

    def table():
        return {r.airport: r.top_carriers_depdelay for r in latest_per_key(spark, f"{tmp_dir}/out", ["airport"]).collect()}

    for i in range(5):
        run(i)
    before = table()
    assert before == {"P0": [3], "P1": [4], "P2": [2]}
    upto = fold_batches(spark, f"{tmp_dir}/out", ["airport"])
    assert upto == 3 and table() == before
    assert sorted(f for f in os.listdir(f"{tmp_dir}/out") if f.startswith("batch_id=")) == ["batch_id=4"]
    assert fold_batches(spark, f"{tmp_dir}/out", ["airport"]) == upto          # nothing new
    run(5)
    assert table() == before | {"P2": [5]}
    assert fold_batches(spark, f"{tmp_dir}/out", ["airport"]) == 4 and table() == before | {"P2": [5]}
    assert len(os.listdir(f"{tmp_dir}/out/_snapshot")) == 1


def test_late_rows_inside_and_beyond_the_watermark(spark, tmp_dir):
    def run(name, *lines):
        feed(tmp_dir, name, lines)
        run_until_done(R.start_ranking(
            stream(spark, tmp_dir), R.CARRIERS_PER_AIRPORT, f"{tmp_dir}/out", f"{tmp_dir}/ck", mode="window",
            window="1 hour", watermark="2 hours", trigger="available_now", state_partitions=2))

    run("a", "AA,ORD,LAX,1,1,0910,2008,1,5,6,1", "AA,ORD,LAX,1,1,1130,2008,1,5,6,1")   # watermark 09:30
    run("b", "AA,ORD,LAX,10,1,0950,2008,1,5,6,1",      # late, its window is still open
        "AA,ORD,LAX,100,1,0840,2008,1,5,6,1")          # beyond: its window closed at 09:00
    run("c", "AA,ORD,LAX,1,1,2330,2008,1,5,6,1")
    run("d", "FLUSH,X,Y,0,0,0900,2999,1,1,2,0")
    got = {r.window_start.hour: r.top_carriers_depdelay for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got == {9: [11], 11: [1], 23: [1]}


def test_lists_over_legs_from_different_batches(spark, tmp_dir):
    """Each list comes once, when its start day is closed, and its rows leave
    the state; a leg that comes after that is dropped."""
    def run(name, *lines):
        feed(tmp_dir, name, lines)
        q = start_itinerary_lists(stream(spark, tmp_dir), f"{tmp_dir}/out", f"{tmp_dir}/ck", k=2, lateness="1 day",
                                  trigger="available_now", state_partitions=2)
        run_until_done(q)
        state = q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
        rows = read_batches(spark, f"{tmp_dir}/out").collect()
        return state, {(str(r.start_date), r.src, r.mid, r.dst):
                       (r.n_pairs, [(p.total, p.dep1, p.dep2) for p in r.pairs]) for r in rows}, len(rows)

    first = ["AA,X,Y,4,1,0900,2008,1,5,6,1", "BB,X,Y,2,1,1000,2008,1,5,6,1", "BB,X,Y,2,1,1000,2008,1,5,6,1"]
    second = ["AA,Y,Z,1,1,1500,2008,1,7,1,1", "CC,Y,Z,0,1,1300,2008,1,7,1,1"]
    assert run("a", *first) == (2, {}, 0)                  # equal flights are one row of state
    assert run("b", *second) == (4, {}, 0)
    trip = {("2008-01-05", "X", "Y", "Z"): (6, [(2, 1000, 1300), (2, 1000, 1300)])}
    assert run("c", "AA,U,V,0,0,0900,2008,1,10,1,1") == (1, trip, 1)
    assert run("d", "AA,X,Y,-50,1,0900,2008,1,5,6,1") == (1, trip, 1)
    assert run("e", "FLUSH,S,T,0,0,0900,2999,1,1,2,0") == (1, trip, 1)


def test_flights_of_open_days_are_kept_on_disk(spark, tmp_dir):
    """The lists' state has a row per flight: it is not held in the heap, and the
    session's own settings are as before."""
    names = ("spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions",
             "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled")
    before = [spark.conf.get(n, None) for n in names]
    feed(tmp_dir, "a", LEGS)
    q = start_itinerary_lists(stream(spark, tmp_dir), f"{tmp_dir}/out", f"{tmp_dir}/ck", k=2,
                              trigger="available_now", state_partitions=2)
    assert [spark.conf.get(n, None) for n in names] == before
    run_until_done(q)
    state = q.recentProgress[0]["stateOperators"][0]
    assert state["numShufflePartitions"] == 2 and any(m.startswith("rocksdb") for m in state["customMetrics"])


def test_console_shows_rows_of_one_evaluation(spark, tmp_dir, capsys):
    feed(tmp_dir, "a", [*(f"AA,X{i},Y,1,1,0900,2008,1,5,6,1" for i in range(50)), LEGS[2]])
    run_until_done(start_itinerary(stream(spark, tmp_dir), f"{tmp_dir}/out", f"{tmp_dir}/ck", k=3,
                                   trigger="available_now", print_rows=40))
    shown = capsys.readouterr().out
    assert "batch 0" in shown and shown.count("2008-01-05") == 40 and "only showing top 40 rows" in shown
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 50


def test_kafka_options(spark):
    assert kafka_options("a,b", "h:1") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "latest", "failOnDataLoss": "true"}
    got = kafka_options("a", "h:1", "earliest", 500, False, {"kafka.security.protocol": "SSL", "minPartitions": 8})
    assert got["startingOffsets"] == "earliest" and got["maxOffsetsPerTrigger"] == "500"
    assert got["failOnDataLoss"] == "false" and got["minPartitions"] == "8"
    with pytest.raises(ValueError):
        message_stream(spark, "kafka")


def test_replay_takes_every_staged_part(spark, tmp_dir):
    from aerolap.streaming.replay import parts_of, replay, stage

    lines = spark.createDataFrame([("AA,ORD,LAX,1,1,0900,2008,1,5,6,1", p) for p in (None, -1, 7)],
                                  "value string, bucket int")
    staged = stage(lines, f"{tmp_dir}/staged")
    assert parts_of(spark, staged) == [None, -1, 7]

    def start():
        return (stream(spark, tmp_dir).writeStream.format("parquet").option("path", f"{tmp_dir}/out")
                .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())

    replay(spark, staged, f"{tmp_dir}/in", start)
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 3


def test_parts_are_found_without_a_look_at_their_lines(spark, tmp_dir):
    """The folders name the parts: files that cannot be read still tell them."""
    import glob

    from aerolap.streaming.replay import parts_of, stage

    lines = spark.createDataFrame([(f"line {i}", i % 3) for i in range(30)], "value string, bucket int").coalesce(1)
    staged = stage(lines, f"{tmp_dir}/staged")
    for path in glob.glob(f"{staged}/bucket=*/*.parquet"):
        with open(path, "wb") as f:
            f.write(b"no parquet")
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    assert parts_of(spark, staged) == [0, 1, 2]

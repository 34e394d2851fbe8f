"""Windows with a ledger of late rows: nothing is lost over many batches."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest

from aerolap.sources import commits
from aerolap.streaming import rankings as R
from aerolap.streaming.ledger import clock, counts, ledger_writer, seconds, start_ledger_ranking
from aerolap.streaming.replay import run_until_done
from aerolap.streaming.source import message_stream, parsed_stream
from aerolap.streaming.upsert import read_batches

EPOCH = dt.datetime(1970, 1, 1)


def run(spark, tmp_dir, i, lines, **kw):
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    with open(f"{tmp_dir}/in/f{i:03}", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    run_until_done(start_ledger_ranking(
        parsed_stream(message_stream(spark, "files", f"{tmp_dir}/in")), R.CARRIERS_PER_AIRPORT, f"{tmp_dir}/out",
        f"{tmp_dir}/ck", trigger="available_now", **kw))


def line(carrier, origin, delay, day, hhmm="0900"):
    d = EPOCH + dt.timedelta(days=day)
    return f"{carrier},{origin},LAX,{delay},0,{hhmm},{d.year},{d.month},{d.day},1,7"


def model(batches, width, lateness):
    """(closed totals, open rows, late rows, undated rows) of batches of
    (carrier, origin, delay, second or None)."""
    mark, totals, open_, late, undated = None, {}, [], [], 0
    for batch in batches:
        latest = max((s for *_, s in batch if s is not None), default=None)
        for c, o, delay, s in batch:
            if s is None:
                undated += 1
            elif mark is not None and (s // width + 1) * width <= mark:
                late.append((c, o, delay, s))
            else:
                open_.append((c, o, delay, s))
        if latest is not None:
            mark = latest - lateness if mark is None else max(mark, latest - lateness)
        for row in [r for r in open_ if mark is not None and (r[3] // width + 1) * width <= mark]:
            open_.remove(row)
            c, o, delay, s = row
            group = totals.setdefault((s // width * width, o), {})
            group[c] = group.get(c, 0) + delay
    return totals, open_, late, undated


@pytest.mark.parametrize("window, by_day", [("1 day", True), ("6 hours", False)])
def test_batches_against_a_model(spark, tmp_dir, window, by_day):
    """On-time, open, late and undated rows add up to the input, with folding."""
    rng, batches = random.Random(5), []
    for i in range(6):
        rows, lines = [], []
        for _ in range(40):
            day, hour = i * 2 + rng.choice([-6, -3, -1, 0, 0, 1, 2]) + 14_000, rng.randrange(24)
            c, o, delay = rng.choice("ABC"), rng.choice(["ORD", "ATL"]), rng.randrange(-5, 50)
            if rng.random() < 0.1:
                rows.append((c, o, delay, None))
                lines.append(f"{c},{o},LAX,{delay},0,0900,2008,2,30,1,7")      # no such day
            else:
                rows.append((c, o, delay, day * 86400 + (0 if by_day else hour * 3600)))
                lines.append(line(c, o, delay, day, f"{hour:02}00"))
        batches.append(rows)
        run(spark, tmp_dir, i, lines, window=window, lateness="2 days", k=10, fold_every=1)
    totals, still, late, undated = model(batches, seconds(window), 2 * 86400)
    assert late and still and undated and totals
    out = f"{tmp_dir}/out"
    got = {(int((r.window_start - EPOCH).total_seconds()), r.airport): dict(zip(r.top_carriers, r.top_carriers_depdelay))
           for r in read_batches(spark, out).collect()}
    assert got == totals
    ledger = read_batches(spark, f"{out}_late").collect()
    width = seconds(window)
    assert (sorted((r.carrier, r.origin, r.dep_delay_min, int((r.window_start - EPOCH).total_seconds()))
                   for r in ledger if r.reason == "late")
            == sorted((c, o, d, s // width * width) for c, o, d, s in late))
    assert sum(r.reason == "undated" and r.window_start is None for r in ledger) == undated
    on_time = 240 - len(late) - undated
    assert counts(out) == {"input": 240, "on_time": on_time, "late": len(late), "undated": undated}
    # open sums are those of the open rows, in few folders
    kept = clock(out)["open"]
    assert len(kept) <= 2
    rows = spark.read.parquet(*[f"{out}_open/{f}" for f in kept]).where(f"window_ends > {clock(out)['watermark']}")
    assert rows.groupBy().sum("total").first()[0] == sum(r[2] for r in still)
    assert len(os.listdir(f"{out}_open")) <= 5               # spent folders go
    assert len(commits.numbers(f"{out}_clock")) <= 2


def test_a_batch_replayed_before_its_commit_writes_the_same(spark, tmp_dir, monkeypatch):
    """The commit of the second batch fails once; the restarted query repeats it."""
    from aerolap.streaming import ledger as L

    run(spark, tmp_dir, 0, [line("A", "ORD", 3, 100), line("A", "ORD", 4, 110)])
    published = commits.publish

    def fail(spark, folder, *rest):
        if folder.endswith("_clock"):
            raise OSError("lost")
        return published(spark, folder, *rest)

    monkeypatch.setattr(L.commits, "publish", fail)
    late = [line("B", "ORD", 5, 101), line("A", "ORD", 6, 109), line("C", "ORD", 7, 130)]
    with pytest.raises(Exception):
        run(spark, tmp_dir, 1, late)
    monkeypatch.undo()
    run(spark, tmp_dir, 2, [line("A", "ORD", 8, 131)])
    out = f"{tmp_dir}/out"
    assert counts(out) == {"input": 6, "on_time": 5, "late": 1, "undated": 0}
    assert [(r.carrier, r.batch_id) for r in read_batches(spark, f"{out}_late").collect()] == [("B", 1)]
    closed = {(r.window_start - EPOCH).days: r.top_carriers_depdelay for r in read_batches(spark, out).collect()}
    assert closed == {100: [3], 109: [6], 110: [4]}          # 130 and 131 are open


def test_empty_and_undated_batches(spark, tmp_dir):
    run(spark, tmp_dir, 0, ["A,ORD,LAX,1,0,0900,2008,2,30,1,7"])
    run(spark, tmp_dir, 1, [""])
    out = f"{tmp_dir}/out"
    assert counts(out) == {"input": 1, "on_time": 0, "late": 0, "undated": 1}
    assert clock(out)["watermark"] is None and read_batches(spark, out).count() == 0
    run(spark, tmp_dir, 2, [line("A", "ORD", "", 100), line("A", "ORD", 1, 200)])
    assert [r.top_carriers_depdelay for r in read_batches(spark, out).collect()] == [[0]]
    for wrong in ("2 moons", "day", "-1 days"):
        with pytest.raises(ValueError):
            seconds(wrong)
    with pytest.raises(ValueError):                          # batches of another query
        ledger_writer(R.CARRIERS_PER_AIRPORT, out, 10, 86400, 0, 10)(spark.range(0), 3)

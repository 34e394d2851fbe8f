"""ST-5: event-time windows that account for every row.

An event-time aggregate of Spark drops rows beyond the watermark. Here such rows
go to a ledger, so that a job can report or add them later:

    input = rows of closed windows + rows of open windows + ledger

* The watermark of a batch is the latest event time of all batches before it,
  less ``lateness``. A row is late if its window ended by then.
* On-time rows of a batch become partial sums per (window, group, item), one
  folder a batch; a window closes with the batch whose event times move the
  watermark past its end. Only then are the folders that reach into it read,
  added up and ranked. When ``fold_every`` folders are open they become one.
* Late rows, and rows without an event time, are written whole with their
  window and the reason.
* Each batch ends with one commit file (``_clock``): watermark, open folders and
  counts. A batch that is replayed starts from the commit before it and so
  writes the same rows again; folders go one commit after their last use.

Read ``<out>`` and ``<out>_late`` with ``upsert.read_batches``, the counts with
``counts``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolap.functions.parse import event_time, fill_zero, ntz_from_instant
from aerolap.schema import FLIGHT_COLUMNS
from aerolap.sources import commits
from aerolap.sources.csv import accepted
from aerolap.streaming.rankings import DELAY, RankingJob, _trigger, rank_totals
from aerolap.streaming.upsert import _remove, batch_writer

# Seconds of the units of time.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}

NO_CLOCK = {"watermark": None, "open": {}, "spent": [], "run": None,
            "counts": {"input": 0, "on_time": 0, "late": 0, "undated": 0}}


def seconds(text: str) -> int:
    """``"2 days"`` -> 172800."""
    m = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text)
    if m is None or m[2] not in UNIT_SECONDS:
        raise ValueError(f"{text!r} is not a number of {', '.join(UNIT_SECONDS)}s")
    return int(m[1]) * UNIT_SECONDS[m[2]]


def clock(out_path: str) -> dict:
    """The commit of the last batch: ``watermark`` in seconds, ``counts``, ``open`` folders."""
    folder = f"{out_path.rstrip('/')}_clock"
    done = commits.numbers(folder)
    return commits.read(folder, done[-1]) if done else NO_CLOCK


def counts(out_path: str) -> dict[str, int]:
    """Rows so far: ``input`` = ``on_time`` + ``late`` + ``undated``."""
    return clock(out_path)["counts"]


def _window_columns(width: int) -> list:
    return [ntz_from_instant(F.timestamp_seconds(F.col("window_ends") - width)).alias("window_start"),
            ntz_from_instant(F.timestamp_seconds("window_ends")).alias("window_end")]


def ledger_writer(job: RankingJob, out_path: str, k: int, width: int, lateness: int, fold_every: int):
    """``foreachBatch`` over flights with ``event_s`` and ``window_ends`` (seconds)."""
    base = out_path.rstrip("/")
    keys = ["window_ends", *job.group, job.item]

    def open_rows(spark: SparkSession, folders) -> DataFrame:
        return spark.read.parquet(*[f"{base}_open/{f}" for f in sorted(folders)])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        last = commits.numbers(f"{base}_clock")
        before = commits.read(f"{base}_clock", last[-1]) if last else NO_CLOCK
        if last and before["run"] != run:
            raise ValueError(f"{out_path} holds batches of another query; give this one its own folder")
        if last and last[-1] >= batch_id:
            return                                           # replayed after its commit
        batch = batch.persist()
        try:
            mark = before["watermark"]
            undated = F.isnull("event_s")
            late = ~undated & (F.col("window_ends") <= mark) if mark is not None else F.lit(False)
            n = batch.agg(F.max("event_s").alias("latest"), F.count("*").alias("input"), F.count_if(late).alias("late"),
                          F.count_if(undated).alias("undated")).first()
            after = mark if n["latest"] is None else max(n["latest"] - lateness, n["latest"] - lateness if mark is None else mark)
            reason = F.when(undated, "undated").when(late, "late")
            batch_writer(f"{base}_late", lambda df, _id: (
                df.withColumn("reason", reason).where("reason is not null")
                .select(*FLIGHT_COLUMNS, *_window_columns(width), "reason")))(batch, batch_id)

            now = f"batch={batch_id}"
            (batch.where(~undated & ~late).groupBy(*keys).agg(F.sum(fill_zero(DELAY)).cast("bigint").alias("total"))
             .write.mode("overwrite").parquet(f"{base}_open/{now}"))
        finally:
            batch.unpersist()
        reach = open_rows(spark, [now]).agg(F.min("window_ends"), F.max("window_ends")).first()
        live = before["open"] | ({now: list(reach)} if reach[0] is not None else {})
        closes = [f for f, (lo, _) in live.items() if after is not None and lo <= after]

        def rank(_df: DataFrame, _id: int) -> DataFrame:
            # folders may still hold windows that closed before
            of = (F.col("window_ends") <= after) & (F.col("window_ends") > mark if mark is not None else F.lit(True)) \
                if closes else F.lit(False)
            totals = (open_rows(spark, closes or [now]).where(of).groupBy(*keys).agg(F.sum("total").alias("total"))
                      .select(*_window_columns(width), *keys[1:], "total"))
            return rank_totals(totals, job, k, extra_group=("window_start", "window_end"))

        batch_writer(base, rank)(batch, batch_id)
        still = {f: span for f, span in live.items() if after is None or span[1] > after}
        if len(still) > fold_every:
            folded = f"fold={batch_id}"
            (open_rows(spark, still).where(F.col("window_ends") > after).groupBy(*keys).agg(F.sum("total").alias("total"))
             .write.mode("overwrite").parquet(f"{base}_open/{folded}"))
            still = {folded: [min(max(lo, after + 1) for lo, _ in still.values()), max(hi for _, hi in still.values())]}
        sums = {c: before["counts"][c] + n[c] for c in ("input", "late", "undated")}
        doc = {"watermark": after, "open": still, "run": run,
               "spent": sorted({*before["open"], now} - still.keys()),
               "counts": sums | {"on_time": sums["input"] - sums["late"] - sums["undated"]}}
        commits.publish(spark, f"{base}_clock", batch_id, doc)
        for f in before["spent"]:
            _remove(spark, f"{base}_open/{f}")
        for number in last[:-1]:
            _remove(spark, f"{base}_clock/{number}.json")

    return write


def start_ledger_ranking(parsed: DataFrame, job: RankingJob, out_path: str, checkpoint: str, k: int = 10,
                         window: str = "1 day", lateness: str = "2 days", trigger: str | None = None,
                         query_name: str | None = None, fold_every: int = 100) -> StreamingQuery:
    """Rank closed windows of ``parsed`` (``source.parsed_stream``) under
    ``out_path``; late and undated rows go to ``<out_path>_late``.

    ``window`` and ``lateness``: whole seconds to weeks; windows start at
    multiples of their width since 1970. Windows that are no multiple of a day
    take the departure time into the event time (a missing one counts as 00:00).
    Rows whose group, item or delay could not be read belong to the parse
    report (``ingest``) and are no input here; one without a readable date is.
    """
    width = seconds(window)
    by_day = width % UNIT_SECONDS["day"] == 0
    flights = accepted(parsed, [*job.group, job.item, DELAY, *([] if by_day else ["dep_time"])])
    at = F.unix_seconds(event_time("flight_date", None if by_day else "dep_time"))
    timed = (flights.select(*FLIGHT_COLUMNS).withColumn("event_s", at)
             .withColumn("window_ends", (F.floor(F.col("event_s") / width) + 1) * width))
    writer = (timed.writeStream.foreachBatch(ledger_writer(job, out_path, k, width, seconds(lateness), fold_every))
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start()

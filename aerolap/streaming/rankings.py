"""Q7-Q9: streaming top-k rankings, in four modes (ST-1..ST-6).

* ``mode="batch"`` (the reference's behaviour, D18): every micro-batch is
  ranked on its own rows only; ``foreachBatch`` calls the *batch* ranking
  code unchanged and writes the batch's rows keyed by ``batch_id``; readers
  see the latest row per key (``upsert.latest_per_key``).
* ``mode="running"``: running totals over the whole stream. The stateful
  part is one streaming ``groupBy(group, item).sum`` (state = one row per
  key pair, partial aggregation before the shuffle); with ``complete``
  output each trigger ranks the full, bounded table of totals; read it with
  ``upsert.newest_batch``.
* ``mode="changes"``: running totals as well, in ``update`` output: a trigger
  receives the totals that changed, merges them into a keyed table beside the
  result (``<out>_totals``, its files in folders by a hash of the group), reads
  back the groups they belong to and writes the ranking of those groups only.
  What a trigger writes, and the folders it reads, follow from the groups that
  changed and not from all groups seen; read it with ``upsert.latest_per_key``.
  Totals never go away, so no group ever has to be taken out.
* ``mode="window"``: tumbling event-time windows with a watermark. The
  streaming aggregate emits a (window, group, item) total once, when the
  watermark passes the window end (append); the ranking of the emitted,
  final windows runs in ``foreachBatch``. Late rows beyond the watermark
  are dropped by Spark, as usual for event-time aggregation.

Missing delays count as 0 (FLT-2). Ties are broken by the item name (D2).
Rows whose needed fields are bad (numbers, dates, short lines) never reach an
aggregate; a fault in another field costs no row. Windows shorter than a day
take the departure time into the event time (a missing one counts as 00:00).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolap.functions.parse import event_time, fill_zero, ntz_from_instant
from aerolap.operators.aggregate import sum_by
from aerolap.operators.topk import ranked_arrays, top_k
from aerolap.sources.csv import accepted
from aerolap.streaming.upsert import batch_writer, latest_per_key, read_batches, version


@dataclass(frozen=True)
class RankingJob:
    group: tuple[str, ...]        # flight columns that form the group
    item: str                     # flight column that is ranked
    group_out: tuple[str, ...]    # output names of the group columns
    names_out: str                # ARRAY<STRING> of ranked items
    values_out: str               # ARRAY<BIGINT> of their totals


# The output column names of the three stream jobs' tables.
CARRIERS_PER_AIRPORT = RankingJob(("origin",), "carrier", ("airport",),
                                  "top_carriers", "top_carriers_depdelay")
DESTS_PER_AIRPORT = RankingJob(("origin",), "dest", ("source_airport",),
                               "top_dst_airports", "top_dst_airports_depdelay")
CARRIERS_PER_ROUTE = RankingJob(("origin", "dest"), "carrier", ("source", "destination"),
                                "top_carriers", "top_carriers_depdelay")

DELAY = "dep_delay_min"


def rank_totals(totals: DataFrame, job: RankingJob, k: int = 10,
                extra_group: tuple[str, ...] = ()) -> DataFrame:
    """(extra, group, item, total) rows -> one row per group with two arrays."""
    group = [*extra_group, *job.group]
    ranked = top_k(totals, k, by="total", group=group, item=[job.item])
    arrays = ranked_arrays(ranked, group, job.item, "total", job.names_out, job.values_out)
    return arrays.select(*extra_group,
                         *[F.col(g).alias(o) for g, o in zip(job.group, job.group_out)],
                         job.names_out, job.values_out)


def rank_flights(flights: DataFrame, job: RankingJob, k: int = 10,
                 extra_group: tuple[str, ...] = ()) -> DataFrame:
    """The batch ranking of one set of flights (missing delay = 0)."""
    keys = [*extra_group, *job.group, job.item]
    f = flights.select(*keys, fill_zero(DELAY).alias(DELAY))
    return rank_totals(sum_by(f, keys, DELAY, "total"), job, k, extra_group)


#: Folders of the table of totals, by hash of the group.
TOTALS_FOLDERS = 64


def _changes_writer(job: RankingJob, out_path: str, k: int, fold_every: int):
    """``foreachBatch`` of mode "changes". Totals are published before the
    ranking made of them: a batch that is replayed after either finds it."""
    totals_path = f"{out_path.rstrip('/')}_totals"
    group = list(job.group)
    keys = ["folder", *group, job.item]
    keep = batch_writer(
        totals_path, lambda df, _id: df.withColumn("folder", F.pmod(F.xxhash64(*group), F.lit(TOTALS_FOLDERS)).cast("int"))
        .repartition("folder"),              # one file a folder and trigger
        keys=keys, fold_every=fold_every, folders=["folder"])

    def rank_changed(stored: DataFrame, batch_id: int) -> DataFrame:
        spark, changed = stored.sparkSession, stored.select("folder", *group).distinct()
        touched = [r[0] for r in changed.select("folder").distinct().collect()]
        totals = latest_per_key(spark, totals_path, keys, only=lambda rows: (
            rows.where(F.col("folder").isin(touched)).join(changed, ["folder", *group], "left_semi")))
        return rank_totals(totals, job, k)

    rank = batch_writer(out_path, rank_changed, keys=job.group_out, fold_every=fold_every)

    def write(df: DataFrame, batch_id: int) -> None:
        keep(df, batch_id)
        now = version(df.sparkSession, totals_path)
        batch = {str(batch_id): now["batches"][str(batch_id)]}
        stored = read_batches(df.sparkSession, totals_path, now | {"batches": batch}).drop("batch_id")
        if not stored.isEmpty():                             # else nothing changed
            rank(stored, batch_id)

    return write


def _trigger(writer, trigger):
    if trigger == "available_now":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger or "10 seconds")


# State in RocksDB, each commit as a log of its changes.
_STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def start_stream(writer, spark, state_partitions: int | None = None, state_on_disk: bool = False) -> StreamingQuery:
    """Start ``writer``; ``state_partitions`` sets the state store width.

    A stateful query fixes its number of state partitions from
    ``spark.sql.shuffle.partitions`` when it first starts (and keeps it in
    its checkpoint). Batch jobs on a large cluster want thousands of shuffle
    partitions; a stream's state usually wants about one per core. The
    stream copies the session's settings when it starts, so the value is
    set only around ``start()``.

    ``state_on_disk``: the state lies in RocksDB on the executors' disks, not in
    their heaps: for streams whose state grows with the rows. A checkpoint that
    was begun with the other kind keeps it.
    """
    conf = dict(_STATE_ON_DISK) if state_on_disk else {}
    if state_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    old = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        return writer.start()
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start_ranking(parsed: DataFrame, job: RankingJob, out_path: str, checkpoint: str,
                  mode: str = "batch", k: int = 10, window: str = "1 day",
                  watermark: str = "2 days", trigger: str | None = None,
                  query_name: str | None = None,
                  state_partitions: int | None = None, fold_every: int = 100) -> StreamingQuery:
    """Start one streaming ranking; results land under ``out_path``.

    ``parsed`` is a stream from ``source.parsed_stream`` (typed flights with
    ``reject_reason``). ``trigger``: a processing-time interval (default
    ``"10 seconds"``, the reference's batch interval), ``"available_now"``
    or ``"once"``. ``state_partitions``: see ``start_stream``. In mode
    "batch" and "changes" keyed tables are folded every ``fold_every`` batches.
    """
    keys = [*job.group, job.item]
    by_day = re.fullmatch(r"\s*\d+\s+(day|week)s?\s*", window) is not None
    timing = [] if mode != "window" else ["flight_date"] if by_day else ["flight_date", "dep_time"]
    flights = accepted(parsed, [*keys, DELAY, *timing])
    if mode == "batch":
        src = flights
        build = lambda df, _id: rank_flights(df, job, k)
        output_mode = "append"
    elif mode in ("running", "changes"):
        src = sum_by(flights.select(*keys, fill_zero(DELAY).alias(DELAY)), keys, DELAY, "total")
        build = lambda df, _id: rank_totals(df, job, k)
        output_mode = "complete" if mode == "running" else "update"
    elif mode == "window":
        timed = (flights.filter(F.col("flight_date").isNotNull())
                 .select(*keys, fill_zero(DELAY).alias(DELAY),
                         event_time("flight_date", None if by_day else "dep_time").alias("event_time"))
                 .withWatermark("event_time", watermark))
        src = (timed.groupBy(F.window("event_time", window).alias("w"), *keys)
               .agg(F.sum(DELAY).cast("long").alias("total"))
               .select(ntz_from_instant("w.start").alias("window_start"),
                       ntz_from_instant("w.end").alias("window_end"),
                       *keys, "total"))
        build = lambda df, _id: rank_totals(
            df, job, k, extra_group=("window_start", "window_end"))
        output_mode = "append"
    else:
        raise ValueError("mode must be 'batch', 'running', 'changes' or 'window'")
    each_batch = (_changes_writer(job, out_path, k, fold_every) if mode == "changes" else
                  batch_writer(out_path, build, complete=output_mode == "complete", fold_every=fold_every,
                               keys=job.group_out if mode == "batch" else None))
    writer = (src.writeStream.outputMode(output_mode)
              .foreachBatch(each_batch)
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    return start_stream(_trigger(writer, trigger), parsed.sparkSession, state_partitions)

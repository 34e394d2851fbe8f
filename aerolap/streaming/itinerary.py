"""Q10: itineraries over a flight stream.

The reference keys every flight by its middle airport only (no date check,
D6), pairs every first leg with every second leg of a batch, and prints each
(X, Y, Z, date) with its list of pairs sorted by total departure delay.

Two modes. ``start_itinerary`` (per batch, like the reference): each
micro-batch runs the batch itinerary code: legs split with the
streaming noon rule (1200 goes to the afternoon, D7), departure delay as the
measure (D8), joined on (Y, start date). Per trip the batch output holds the
exact number of pairs and all of them or the k best, sorted
(``itinerary_lists``); no step shuffles a pair. Output lands per ``batch_id`` like the
rankings. ``start_itinerary_running``: the best itinerary per trip over the
whole stream so far, from a stateful per-leg minimum.
``start_itinerary_windowed``: event time with a watermark; each start day's
best itineraries are emitted once, when final, and its state is evicted.
``start_itinerary_lists``: the same for the lists of k best pairs, so trips
whose legs come in different batches have theirs too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolap.functions.parse import day_of_instant, event_time, pack_min_key
from aerolap.operators.itinerary import (
    LEG_KEY, itinerary_lists, leg_candidates, leg_minima, lists_of_counted, pair_leg_minima)
from aerolap.sources.csv import accepted
from aerolap.streaming.rankings import _trigger, start_stream
from aerolap.streaming.upsert import batch_writer


# Columns the stream itineraries read.
_NEEDS = ["origin", "dest", "dep_time", "flight_date", "dep_delay_min"]


def itinerary_batch(flights: DataFrame, k: int | None) -> DataFrame:
    legs = leg_candidates(flights, delay_col="dep_delay_min", noon_inclusive=True)
    return itinerary_lists(legs, k)


def start_itinerary(parsed: DataFrame, out_path: str | None, checkpoint: str, k: int | None,
                    trigger: str | None = None, print_rows: int | None = None
                    ) -> StreamingQuery:
    """Start the itinerary stream: per trip the sorted list of a batch's pairs
    (the ``k`` best; all of them if ``k`` is None).

    ``out_path`` receives each batch's rows (``batch_id=N`` folders);
    ``print_rows`` also prints that many rows of each batch to the driver's
    console (SNK-4; the reference prints 40), from the same evaluation. With
    ``out_path=None`` the console is the only output.
    """
    flights = accepted(parsed, _NEEDS)
    build = lambda df, _id: itinerary_batch(df, k)

    def show(rows: DataFrame, batch_id: int) -> None:
        print(f"-------- batch {batch_id} --------")
        rows.show(print_rows, truncate=False)

    each_batch = batch_writer(out_path, build, reread=True, show=show if print_rows else None)
    writer = (flights.writeStream.outputMode("append")
              .foreachBatch(each_batch)
              .option("checkpointLocation", checkpoint))
    return _trigger(writer, trigger).start()


def start_itinerary_running(parsed: DataFrame, out_path: str, checkpoint: str,
                            trigger: str | None = None,
                            state_partitions: int | None = None) -> StreamingQuery:
    """Best itinerary per trip over everything seen so far (stream rules).

    The only state is one packed minimum per (leg, route, start day), kept by
    a streaming aggregate (partial aggregation before its shuffle). Each
    trigger receives the full table of minima (``complete`` output) and pairs
    the two legs with the batch code; no flight pair is ever formed. The
    answer of the latest batch is complete: read it with
    ``upsert.newest_batch(out_path)``; older batches are removed. State holds
    every start day for ever, so an unbounded stream wants the windowed form.
    """
    legs = leg_candidates(accepted(parsed, _NEEDS), delay_col="dep_delay_min", noon_inclusive=True)
    build = lambda df, _id: pair_leg_minima(df)
    writer = (leg_minima(legs).writeStream.outputMode("complete")
              .foreachBatch(batch_writer(out_path, build, complete=True, reread=True))
              .option("checkpointLocation", checkpoint))
    return start_stream(_trigger(writer, trigger), parsed.sparkSession, state_partitions)


def start_itinerary_windowed(parsed: DataFrame, out_path: str, checkpoint: str,
                             lateness: str = "1 day", gap_days: int = 2,
                             trigger: str | None = None,
                             state_partitions: int | None = None) -> StreamingQuery:
    """Best itinerary per trip, emitted once per start day when it is final.

    Each leg's best flight per (route, start day) is a windowed streaming
    minimum on the trip's start day. A second leg of start day d departs on
    d + ``gap_days``, so the watermark trails the newest start day by the gap
    plus ``lateness``: when day d's window closes, both legs of every trip
    starting on d are complete and leave the state in the same trigger, and
    ``foreachBatch`` pairs exactly those rows. State stays bounded (closed
    days are evicted); flights later than the watermark are dropped, as in
    any event-time aggregation.
    """
    minima = _closed_days(parsed, [], F.min(pack_min_key("delay", "dep")).alias("_b"), lateness, gap_days)
    build = lambda df, _id: pair_leg_minima(df)
    writer = (minima.writeStream.outputMode("append")
              .foreachBatch(batch_writer(out_path, build, reread=True))
              .option("checkpointLocation", checkpoint))
    return start_stream(_trigger(writer, trigger), parsed.sparkSession, state_partitions)


def start_itinerary_lists(parsed: DataFrame, out_path: str, checkpoint: str, k: int,
                          lateness: str = "1 day", gap_days: int = 2,
                          trigger: str | None = None,
                          state_partitions: int | None = None) -> StreamingQuery:
    """Per trip the ``k`` best pairs and the number of all pairs, emitted once
    per start day when it is final, whatever batches its legs came in.

    State holds one row per distinct flight (leg, route, start day, delay,
    departure) of the open days, with the number of equal ones; both legs of a
    trip carry the trip's start day, so they close and leave the state in the
    same trigger, and ``foreachBatch`` pairs the closed days with the batch
    code (no pair leaves its trip's row). A join of two streams would keep
    the same rows and form all pairs before any list is cut. The state grows
    with the flights of the open days, so it lies on disk (``start_stream``).
    """
    counted = _closed_days(parsed, ["delay", "dep"], F.count(F.lit(1)).alias("c"), lateness, gap_days)
    build = lambda df, _id: lists_of_counted(df, k)
    writer = (counted.writeStream.outputMode("append")
              .foreachBatch(batch_writer(out_path, build, reread=True))
              .option("checkpointLocation", checkpoint))
    return start_stream(_trigger(writer, trigger), parsed.sparkSession, state_partitions, state_on_disk=True)


def _closed_days(parsed: DataFrame, also: list[str], value, lateness: str, gap_days: int) -> DataFrame:
    """``value`` per leg key (and the columns ``also``), once the watermark has
    passed the start day."""
    legs = leg_candidates(accepted(parsed, _NEEDS), delay_col="dep_delay_min",
                          noon_inclusive=True, gap_days=gap_days)
    delay = f"{gap_days} days {lateness}" if lateness else f"{gap_days} days"
    key = [c for c in LEG_KEY if c != "start_date"]
    return (legs.withColumn("start_ts", event_time("start_date"))
            .withWatermark("start_ts", delay)
            .groupBy(F.window("start_ts", "1 day").alias("w"), *key, *also).agg(value)
            .withColumn("start_date", day_of_instant("w.start")).drop("w"))

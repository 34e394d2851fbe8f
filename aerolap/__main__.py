"""Command line: one subcommand per job, like the reference's job launchers.

    python -m aerolap top-airports   --input 'data/*/*.csv' --output out/q1 [--top 10]
    python -m aerolap carriers-per-route --input ingested/ --input-format parquet \\
        --output out/q5 --format text --ties distinct
    python -m aerolap itineraries --input ... --output out/q6 [--year 2008] [--pairs best|summary|k-best --k 10]
    python -m aerolap ingest --input raw/ --input-format zip --output ingested/
    python -m aerolap stream-carriers-per-airport --source kafka --bootstrap host:9092 \\
        --topics flights --output out/q7 --checkpoint ckpt/q7 [--mode batch|running|changes|window]

``--format text`` writes the reference's ``key<TAB>value`` lines (composite
parts joined by commas); the default is Parquet. Batch inputs: concise CSV
(default), raw headered CSV, zipped raw CSV, or ingested Parquet. A job drops
only rows whose needed columns could not be read; ``--strict`` fails on any
fault. ``--input-bytes`` sizes shuffles and scan splits for a cluster run.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolap.plans import jobs

RANKINGS = {
    # job: (function, text key columns, text value columns before the measure)
    "top-airports": (jobs.top_airports, ["airport"], ["flights"]),
    "top-airlines": (jobs.top_airlines, ["airline_id"], []),
    "carriers-per-airport": (jobs.top_carriers_per_airport, ["origin"], ["carrier"]),
    "dests-per-airport": (jobs.top_dests_per_airport, ["origin"], ["dest"]),
    "carriers-per-route": (jobs.top_carriers_per_route, ["origin", "dest"], ["carrier"]),
}
STREAMS = {
    "stream-carriers-per-airport": "CARRIERS_PER_AIRPORT",
    "stream-dests-per-airport": "DESTS_PER_AIRPORT",
    "stream-carriers-per-route": "CARRIERS_PER_ROUTE",
}


def load_flights(spark: SparkSession, path: str | list[str], fmt: str, needs: list[str],
                 strict: bool = False) -> DataFrame:
    from aerolap.sources.csv import accepted
    from aerolap.sources.ingest import parsed_input, read_ingested

    if fmt == "parquet":
        return read_ingested(spark, path, needs)
    return accepted(parsed_input(spark, path, fmt, strict), needs)


def write(df: DataFrame, out: str, fmt: str, keys: list[str], values: list[str],
          mode: str) -> None:
    if fmt == "text":
        from aerolap.sources.kv_text import write_kv_text

        write_kv_text(df, out, keys, values, mode=mode)
    else:
        df.write.mode(mode).parquet(out)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="aerolap", description=__doc__.split("\n")[0])
    sub = p.add_subparsers(dest="job", required=True)

    def batch(name: str, help_: str):
        s = sub.add_parser(name, help=help_)
        s.add_argument("--input", required=True, nargs="+")
        s.add_argument("--input-format", default="concise",
                       choices=["concise", "raw", "zip", "parquet"])
        s.add_argument("--output", required=True)
        s.add_argument("--format", default="parquet", choices=["parquet", "text"])
        s.add_argument("--mode", default="errorifexists")
        return common(s)

    def common(s):
        s.add_argument("--strict", action="store_true", help="fail on the first faulty row")
        s.add_argument("--input-bytes", type=int, default=None,
                       help="size of the input, to size shuffles and scan splits")
        return s

    for name in RANKINGS:
        s = batch(name, f"ranking job {name}")
        s.add_argument("--top", type=int, default=10)
        s.add_argument("--ties", default="rows", choices=["rows", "distinct"])
        s.add_argument("--metric", default="sum", choices=["sum", "mean"])
        s.add_argument("--delay", default=None, help="delay column to rank by")
    s = batch("itineraries", "two-leg itineraries with a two-day stop")
    s.add_argument("--pairs", default="best", choices=["best", "summary", "k-best"])
    s.add_argument("--k", type=int, default=None, help="pairs per trip (k-best: required)")
    s.add_argument("--year", type=int, default=None)
    s = sub.add_parser("ingest", help="parse once into Parquet by year/month")
    s.add_argument("--input", required=True)
    s.add_argument("--input-format", default="concise", choices=["concise", "raw", "zip"])
    s.add_argument("--output", required=True)
    common(s)
    for name in [*STREAMS, "stream-itineraries"]:
        s = sub.add_parser(name, help=f"streaming job {name}")
        s.add_argument("--source", default="files", choices=["files", "kafka"])
        s.add_argument("--path")
        s.add_argument("--bootstrap")
        s.add_argument("--topics")
        s.add_argument("--output", required=True)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--trigger", default="10 seconds")
        s.add_argument("--mode", default="batch", choices=["batch", "running", "changes", "window"])
        s.add_argument("--top", type=int, default=10)
        s.add_argument("--print-rows", type=int, default=None)
        s.add_argument("--window", default="1 day")
        s.add_argument("--watermark", default=None,
                       help="lateness allowed (rankings: 2 days; itineraries: 1 day past the gap)")
        s.add_argument("--state-partitions", type=int, default=None)
        s.add_argument("--max-files-per-trigger", type=int, default=None)
        s.add_argument("--starting-offsets", default="latest")
        s.add_argument("--max-offsets-per-trigger", type=int, default=None)
        s.add_argument("--tolerate-data-loss", action="store_true")
        s.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                       help="further option of the source")
        common(s)
        s.add_argument("--timeout", type=int, default=None,
                       help="stop after this many seconds (default: run until stopped)")
    return p


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.job == "itineraries" and args.pairs == "k-best" and not args.k:
        parser.error("--pairs k-best needs --k")
    from aerolap.session import build_session

    spark = build_session(app=f"aerolap-{args.job}", input_bytes=args.input_bytes)
    if args.job == "ingest":
        from aerolap.sources.ingest import ingest

        ingest(spark, args.input, args.output, args.input_format, strict=args.strict)
        return
    if args.job in RANKINGS or args.job == "itineraries":
        delay = getattr(args, "delay", None)
        flights = load_flights(spark, args.input, args.input_format,
                               jobs.needs(args.job, delay), args.strict)
        if args.job == "itineraries":
            _itineraries(flights, args)
            return
        fn, keys, values = RANKINGS[args.job]
        kw = {"ties": args.ties}
        if args.job != "top-airports":
            kw["metric"] = args.metric
            kw["delay_col"] = delay or jobs.needs(args.job)[-1]
            values = [*values, jobs.measure_name(kw["delay_col"], args.metric)]
        result = fn(flights, args.top, **kw)
        write(result.orderBy(*[k for k in keys if k in result.columns], "rank"),
              args.output, args.format, keys, values, args.mode)
        return
    _stream(spark, args)


def _itineraries(flights: DataFrame, args) -> None:
    from aerolap.operators.itinerary import itinerary_labels

    if args.pairs == "best":
        best = jobs.itinerary_best(flights, year=args.year)
        if args.format == "text":
            lab = itinerary_labels(best)
            write(lab, args.output, "text", ["day", "leg1", "leg2", "dst"], ["total_delay"], args.mode)
        else:
            best.write.mode(args.mode).parquet(args.output)
    elif args.pairs == "summary":
        facts = jobs.itinerary_summary(flights, year=args.year)
        write(facts, args.output, args.format, ["start_date", "src", "mid", "dst"],
              ["n_pairs", "min_total", "max_total", "sum_total"], args.mode)
    else:
        lists = jobs.itinerary_k_best(flights, k=args.k, year=args.year)
        if args.format == "text":
            lists = lists.withColumn("pairs", F.to_json("pairs"))
            write(lists, args.output, "text", ["start_date", "src", "mid", "dst"],
                  ["n_pairs", "pairs"], args.mode)
        else:
            lists.write.mode(args.mode).parquet(args.output)


def _stream(spark: SparkSession, args) -> None:
    from aerolap.streaming import rankings as R
    from aerolap.streaming.itinerary import (
        start_itinerary, start_itinerary_running, start_itinerary_windowed)
    from aerolap.streaming.source import message_stream, parsed_stream

    kafka = {} if args.source != "kafka" else {
        "starting_offsets": args.starting_offsets, "fail_on_data_loss": not args.tolerate_data_loss,
        "max_offsets_per_trigger": args.max_offsets_per_trigger}
    messages = message_stream(spark, args.source, path=args.path, topics=args.topics,
                              bootstrap=args.bootstrap, max_files_per_trigger=args.max_files_per_trigger,
                              options=dict(x.split("=", 1) for x in args.option), **kafka)
    parsed = parsed_stream(messages, strict=args.strict)
    wide = {"state_partitions": args.state_partitions}
    if args.job == "stream-itineraries":
        if args.mode == "running":
            q = start_itinerary_running(parsed, args.output, args.checkpoint, args.trigger, **wide)
        elif args.mode == "window":
            q = start_itinerary_windowed(parsed, args.output, args.checkpoint,
                                         lateness=args.watermark or "1 day",
                                         trigger=args.trigger, **wide)
        else:
            q = start_itinerary(parsed, args.output, args.checkpoint, k=args.top,
                                trigger=args.trigger, print_rows=args.print_rows)
    else:
        job = getattr(R, STREAMS[args.job])
        q = R.start_ranking(parsed, job, args.output, args.checkpoint, mode=args.mode,
                            k=args.top, window=args.window, watermark=args.watermark or "2 days",
                            trigger=args.trigger, **wide)
    q.awaitTermination(args.timeout)
    if args.timeout:
        q.stop()


if __name__ == "__main__":
    main()

"""Registered queries that go through files and streams.

Each writes its input from the test tables into a fresh folder under the
shared checkpoint folder (``session.scratch_path``), reads it back through
the source under test and returns the result as a DataFrame over files that
stay in place.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolap.plans import jobs
from aerolap.plans import oracle as O
from aerolap.plans.registry import register
from aerolap.schema import CONCISE_FIELDS, FLIGHT_COLUMNS, RAW_HEADER_NAMES
from aerolap.session import scratch_path
from aerolap.sources import csv as C
from aerolap.sources.tables import concise_fields, concise_lines, faulty_lines, flight_view
from aerolap.streaming import rankings as R
from aerolap.streaming.replay import replay, run_until_done, stage
from aerolap.streaming.source import message_stream, parsed_stream
from aerolap.streaming.upsert import _remove, latest_per_key, newest_batch, read_batches


#: Seconds that a registered replay of a recording takes by its clock.
PACED_SECONDS = 8.0


def _cores(spark) -> int:
    """State partitions for the registered streams: one per core."""
    return spark.sparkContext.defaultParallelism


@register("op_kv_roundtrip", O.KV_ROUNDTRIP)
def op_kv_roundtrip(spark, sf_dir):
    from aerolap.sources.kv_text import read_kv_text, write_kv_text
    path = scratch_path(spark, "kv")
    ranked = jobs.top_carriers_per_airport(flight_view(spark, sf_dir))
    write_kv_text(ranked, path, ["origin"], ["carrier", "total_dep_delay"])
    return read_kv_text(spark, path, ["origin"], ["carrier", "total_dep_delay"],
                        types={"total_dep_delay": "bigint"})


@register("op_csv_scan", O.PARSED_NO_BUCKET)
def op_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "concise")
    C.write_concise(concise_fields(spark, sf_dir), path)
    return C.read_concise(spark, path).select(*FLIGHT_COLUMNS, "reject_reason")


def _write_raw_two_layouts(spark, sf_dir, path):
    """Buckets 0-1 in the usual column order plus an extra column, 2-3 reversed."""
    fields = concise_fields(spark, sf_dir).withColumn("Extra", F.lit("x"))
    late = F.coalesce(F.col("bucket") >= 2, F.lit(False))
    C.write_raw(fields.filter(~late), f"{path}/layout_a", RAW_HEADER_NAMES + ["Extra"])
    C.write_raw(fields.filter(late), f"{path}/layout_b", list(reversed(RAW_HEADER_NAMES)))


def _zip_tree(spark, src, dst):
    """Compress every file under ``src`` into ``dst`` at the same place of the
    tree (``a/m.csv`` -> ``a/m.csv.zip``), one file per task row."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.csv").load(src)
             .select(F.col("_metadata.file_path").alias("path")))
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    root, base = (path(p).getFileSystem(conf).makeQualified(path(p)).toUri().getPath().rstrip("/")
                  for p in (src, dst))
    store = path(dst).getFileSystem(conf).getUri().toString().rstrip("/")

    def compress(batches):
        import zipfile

        import pandas as pd
        from pyspark import TaskContext

        from aerolap.sources.files import move, open_binary

        attempt = TaskContext.get().taskAttemptId()
        for pdf in batches:
            for p in pdf["path"]:
                below = p[p.index(root) + len(root) + 1:]
                target = f"{store}{base}/{below}.zip"
                # an attempt-private name first: a retried task never leaves a
                # torn archive
                tmp = f"{store}{base}/{below}._tmp-{attempt}"
                with open_binary(p) as fin, open_binary(tmp, "wb") as fout, \
                        zipfile.ZipFile(fout, "w", zipfile.ZIP_DEFLATED) as zf, \
                        zf.open(below.rsplit("/", 1)[-1], "w") as member:
                    while buf := fin.read(1 << 20):
                        member.write(buf)
                move(tmp, target)
            yield pd.DataFrame({"path": pdf["path"]})

    return files.mapInPandas(compress, "path STRING").count()


@register("op_csv_by_name", O.PARSED_NO_BUCKET)
def op_csv_by_name(spark, sf_dir):
    path = scratch_path(spark, "raw")
    _write_raw_two_layouts(spark, sf_dir, path)
    typed = C.typed_from_fields(C.read_raw(spark, path))
    return typed.select(*FLIGHT_COLUMNS, "reject_reason")


#: Flights whose raw text (some 220 bytes each, in two layouts) lies on disk at one time.
PIECE_ROWS = 16_000_000


def _in_pieces(spark, path, rows):
    """The rows stored under ``path`` in parts of whole files, about ``rows`` each."""
    stored, file = spark.read.parquet(path), F.col("_metadata.file_path")
    files = stored.groupBy(file.alias("file")).count().orderBy("file").collect()
    pieces, held = [[]], 0
    for f in files:
        if pieces[-1] and held + f["count"] > rows:
            pieces.append([])
            held = 0
        pieces[-1].append(f["file"])
        held += f["count"]
    return [stored] if len(pieces) == 1 else [stored.where(file.isin(p)) for p in pieces]


@register("op_csv_multiline", O.CSV_MULTILINE)
def op_csv_multiline(spark, sf_dir):
    """Raw files with a byte order mark, line breaks, commas and doubled quotes
    in a quoted column, and data rows equal to the header.

    Raw text is several times as large as the tables: it is written and read
    ``PIECE_ROWS`` flights at a time, both layouts in each read, and the text of a
    piece whose rows are stored is removed."""
    staged, done = scratch_path(spark, "fields"), scratch_path(spark, "typed")
    # joined once for all pieces and both layouts
    concise_fields(spark, sf_dir).write.option("maxRecordsPerFile", PIECE_ROWS // 16).parquet(staged)
    *stored, last = _in_pieces(spark, staged, PIECE_ROWS)
    like_header = spark.range(3).select(*(F.lit(h).alias(c) for h, c in zip(RAW_HEADER_NAMES, CONCISE_FIELDS)))
    for n, piece in enumerate(stored):
        path = scratch_path(spark, "raw")
        _raw_multiline(spark, piece.select(*CONCISE_FIELDS), path).write.parquet(f"{done}/{n}")
        _remove(spark, path)
    rest = _raw_multiline(spark, last.select(*CONCISE_FIELDS), scratch_path(spark, "raw"), like_header)
    _remove(spark, staged)                                   # all of it is raw text by now
    if not stored:
        return rest
    return rest.union(spark.read.schema(rest.schema).parquet(*(f"{done}/{n}" for n in range(len(stored)))))


def _raw_multiline(spark, fields, path, like_header=None):
    """Flights written as raw text in both layouts and read back."""
    note = F.concat(F.lit('said "'), F.col("origin"), F.lit('",\r\nthen\n\nleft ' ), F.col("carrier"), F.lit('\n"'))
    rows = fields.withColumn("Note", note)
    if like_header is not None:
        rows = rows.unionByName(like_header.withColumn("Note", F.lit("Note")))
    header = [*RAW_HEADER_NAMES, "Note"]
    mark = rows.withColumnRenamed("Note", "\ufeffNote").select("\ufeffNote", *CONCISE_FIELDS)
    C.write_raw(rows, f"{path}/plain", header)
    C.write_raw(mark, f"{path}/marked", ["\ufeffNote", *RAW_HEADER_NAMES])
    typed = C.typed_from_fields(C.read_raw(spark, path))
    return typed.select(*FLIGHT_COLUMNS, "reject_reason")


@register("op_zip_ingest", O.PARSED_NO_BUCKET)
def op_zip_ingest(spark, sf_dir):
    from aerolap.sources.files import read_zipped
    raw = scratch_path(spark, "raw")
    zips = scratch_path(spark, "zip")
    _write_raw_two_layouts(spark, sf_dir, raw)
    _zip_tree(spark, raw, zips)
    typed = C.typed_from_fields(read_zipped(spark, zips))
    return typed.select(*FLIGHT_COLUMNS, "reject_reason")


class _Sink:
    """A stream for zipfile that counts what is written and passes on the first
    ``upto`` bytes (all without it)."""

    def __init__(self, out=None, upto: int | None = None):
        self.out, self.upto, self.size = out, upto, 0

    def write(self, data) -> int:
        if self.out is not None:
            keep = data if self.upto is None else bytes(data)[:max(0, self.upto - self.size)]
            if keep:
                self.out.write(keep)
        self.size += len(data)
        return len(data)

    def flush(self) -> None:
        pass


def _zip_into(sink: _Sink, folder: str, paths) -> int:
    """An archive of files, a megabyte at a time; its size in bytes."""
    import zipfile

    from aerolap.sources.files import open_binary

    with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as zf:
        for p in paths:
            with open_binary(p) as fin, zf.open(f"{folder}/{p.rsplit('/', 1)[-1]}", "w", force_zip64=True) as member:
                while buf := fin.read(1 << 20):
                    member.write(buf)
    return sink.size


#: Bytes of files in one archive, beyond which a folder's files go on in another.
ARCHIVE_BYTES = 256 << 20


def _zip_folders(spark, src, dst, archive_bytes=ARCHIVE_BYTES):
    """Archives of the folders of CSV files below ``src``, a task an archive:
    one per folder, and another for each further ``archive_bytes`` of its files.
    The archive of ``cut`` loses its second half, that of ``none`` all its
    bytes; each is a single one, so that it is one fault."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.csv").load(src)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
             .withColumn("folder", F.regexp_extract("path", "([^/]+)/[^/]+$", 1)))
    before = F.sum("size").over(Window.partitionBy("folder").orderBy("path")) - F.col("size")
    part = F.when(F.col("folder").isin("cut", "none"), F.lit(0)).otherwise(F.floor(before / archive_bytes))
    archives = (files.withColumn("part", part).groupBy("folder", "part")
                .agg(F.sort_array(F.collect_list("path")).alias("paths"), F.sum("size").alias("size")))
    # few rows, each much work: one a task, whatever AQE would merge
    tasks = archives.count()
    order = Window.orderBy(F.desc("size"), "folder", "part")
    dealt = (archives.withColumn("task", F.row_number().over(order) - 1).repartitionById(max(1, tasks), "task")
             .select("folder", "part", "paths"))

    def compress(batches):
        import pandas as pd
        from pyspark import TaskContext

        from aerolap.sources.files import move, open_binary

        attempt = TaskContext.get().taskAttemptId()
        for pdf in batches:
            for folder, n, paths in zip(pdf["folder"], pdf["part"], pdf["paths"]):
                target = f"{dst}/{folder}{f'-{n}' if n else ''}.zip"
                tmp = f"{target}._tmp-{attempt}"
                upto = {"cut": lambda: _zip_into(_Sink(), folder, paths) // 2, "none": lambda: 0}.get(folder)
                with open_binary(tmp, "wb") as out:
                    if folder != "none":
                        _zip_into(_Sink(out, upto() if upto else None), folder, paths)
                move(tmp, target)
            yield pd.DataFrame({"folder": pdf["folder"]})

    return dealt.mapInPandas(compress, "folder STRING").count()


#: Rows of a large member and of a small one, beyond which there are more of them.
LARGE_ROWS, SMALL_ROWS = 2_000_000, 100_000


@register("op_zip_members", O.ZIP_MEMBERS)
def op_zip_members(spark, sf_dir):
    """A tree with large members, many small ones, an archive cut off in the
    middle and an empty one: all flights, and a rejected row for each fault.

    No member can be read by two tasks, so one that held a share of all flights
    would grow with the tables: there is one large member per ``LARGE_ROWS``."""
    from aerolap.sources.files import read_zipped
    raw, zips = scratch_path(spark, "raw"), scratch_path(spark, "zip")
    staged = scratch_path(spark, "fields")
    concise_fields(spark, sf_dir).write.parquet(staged)      # joined once for the four folders
    fields = spark.read.parquet(staged)
    few = F.coalesce(F.col("bucket") == 3, F.lit(False))
    n_few = fields.where(few).count()
    n_large = fields.count() - n_few
    large = fields.where(~few)
    pieces = max(1, -(-n_large // LARGE_ROWS))
    C.write_raw(large.coalesce(1) if pieces == 1 else large.repartition(pieces), f"{raw}/large", RAW_HEADER_NAMES)
    C.write_raw(fields.where(few).repartition(max(24, -(-n_few // SMALL_ROWS)), "origin", "dest", "carrier", "airline_id"),
                f"{raw}/small", list(reversed(RAW_HEADER_NAMES)))
    for name in ("cut", "none"):
        C.write_raw(fields.where(few), f"{raw}/{name}", RAW_HEADER_NAMES)
    _zip_folders(spark, raw, zips)
    typed = C.typed_from_fields(read_zipped(spark, zips))
    return typed.select(*FLIGHT_COLUMNS, "reject_reason")


@register("op_ingest_parquet", O.INGESTED)
def op_ingest_parquet(spark, sf_dir):
    from aerolap.sources.ingest import ingest, read_ingested
    base = scratch_path(spark, "ingest")
    C.write_concise(concise_fields(spark, sf_dir), f"{base}/csv")
    ingest(spark, f"{base}/csv", f"{base}/parquet")
    return read_ingested(spark, f"{base}/parquet")


@register("ext_itinerary_best_year_ingested", O.itinerary_best_sql(year=1998, parsed=True))
def ext_itinerary_best_year_ingested(spark, sf_dir):
    """EX-5 over ingested flights: the year prunes the folders that are read."""
    from aerolap.sources.ingest import ingest, read_ingested
    base = scratch_path(spark, "ingest")
    C.write_concise(concise_fields(spark, sf_dir), f"{base}/csv")
    ingest(spark, f"{base}/csv", f"{base}/parquet")
    flights = read_ingested(spark, f"{base}/parquet", jobs.needs("itineraries"))
    return jobs.itinerary_best(flights, year=1998)


@register("op_rejected_rows", O.REJECTED_ROWS)
def op_rejected_rows(spark, sf_dir):
    """Faulty lines through one ingest: reason, bad columns and raw line."""
    from aerolap.sources.ingest import ingest, read_rejected
    base = scratch_path(spark, "faults")
    faulty_lines(spark, sf_dir).write.text(f"{base}/csv")
    ingest(spark, f"{base}/csv", f"{base}/parquet")
    return (read_rejected(spark, f"{base}/parquet")
            .select("reject_reason", F.array_join("bad_fields", ",").alias("bad_fields"), "raw_line"))


@register("op_top_airports_from_csv", O.TOP_AIRPORTS_FAULTY)
def op_top_airports_from_csv(spark, sf_dir):
    """Q1 loses only lines without readable airports."""
    base = scratch_path(spark, "faults")
    faulty_lines(spark, sf_dir).write.text(f"{base}/csv")
    flights = C.accepted(C.read_concise(spark, f"{base}/csv"), jobs.needs("top-airports"))
    return jobs.top_airports(flights)


def _staged_lines(spark, sf_dir, base):
    return stage(concise_lines(spark, sf_dir), f"{base}/staged")


@register("op_stream_replay", O.PARSE_MESSAGE)
def op_stream_replay(spark, sf_dir):
    base = scratch_path(spark, "replay")
    staged = _staged_lines(spark, sf_dir, base)
    inp, out, ckpt = f"{base}/input", f"{base}/out", f"{base}/ckpt"

    def start():
        parsed = parsed_stream(message_stream(spark, "files", inp), keep=("bucket",))
        return (parsed.writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    replay(spark, staged, inp, start)
    return spark.read.parquet(out).select(*FLIGHT_COLUMNS, "bucket", "reject_reason")


def _stream_ranking(spark, sf_dir, job, mode, keys):
    base = scratch_path(spark, f"stream-{mode}")
    staged = _staged_lines(spark, sf_dir, base)
    inp, out, ckpt = f"{base}/input", f"{base}/out", f"{base}/ckpt"

    def start():
        parsed = parsed_stream(message_stream(spark, "files", inp))
        return R.start_ranking(parsed, job, out, ckpt, mode=mode, trigger="available_now",
                               state_partitions=_cores(spark))

    replay(spark, staged, inp, start)
    return newest_batch(spark, out) if mode == "running" else latest_per_key(spark, out, keys)


@register("stream_top_carriers_per_airport", O.STREAM_CARRIERS_PER_AIRPORT)
def stream_top_carriers_per_airport(spark, sf_dir):
    return _stream_ranking(spark, sf_dir, R.CARRIERS_PER_AIRPORT, "batch", ["airport"])


@register("stream_log_top_carriers", O.STREAM_RUNNING)
def stream_log_top_carriers(spark, sf_dir):
    """Running carriers per airport over a message log: the stream is started,
    the log grows, and the stream is started again from its checkpoint."""
    from aerolap.sources.log import append
    base = scratch_path(spark, "stream-log")
    log, out, ckpt = f"{base}/log", f"{base}/out", f"{base}/ckpt"
    lines = concise_lines(spark, sf_dir)
    for late in (False, True):
        append(lines.where((F.coalesce(F.col("bucket"), F.lit(0)) >= 2) == F.lit(late)), log, partitions=_cores(spark))
        parsed = parsed_stream(message_stream(spark, "log", log, starting_offsets="earliest"))
        run_until_done(R.start_ranking(parsed, R.CARRIERS_PER_AIRPORT, out, ckpt, mode="running",
                                       trigger="available_now", state_partitions=_cores(spark)))
    return newest_batch(spark, out)


@register("stream_paced_replay", O.STREAM_RUNNING)
def stream_paced_replay(spark, sf_dir):
    """Running carriers per airport over recorded flights in the order of their
    event times, all of them within some seconds: one query, many batches."""
    from aerolap.functions.parse import event_time
    from aerolap.sources.recording import record
    base = scratch_path(spark, "stream-paced")
    flights = C.parse_concise(concise_lines(spark, sf_dir), keep=("value",))
    whole = record(flights, event_time("flight_date", "dep_time"), f"{base}/recording")
    messages = message_stream(spark, "recording", f"{base}/recording", reader="carriers",
                              speed=max(1.0, (whole["last"] - whole["first"]) / 1e6 / PACED_SECONDS))
    q = R.start_ranking(parsed_stream(messages), R.CARRIERS_PER_AIRPORT, f"{base}/out", f"{base}/ckpt", mode="running",
                        trigger="0 seconds", state_partitions=_cores(spark))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return newest_batch(spark, f"{base}/out")


@register("stream_top_dests_per_airport", O.STREAM_DESTS_PER_AIRPORT)
def stream_top_dests_per_airport(spark, sf_dir):
    return _stream_ranking(spark, sf_dir, R.DESTS_PER_AIRPORT, "batch", ["source_airport"])


@register("stream_top_carriers_per_route", O.STREAM_CARRIERS_PER_ROUTE)
def stream_top_carriers_per_route(spark, sf_dir):
    return _stream_ranking(spark, sf_dir, R.CARRIERS_PER_ROUTE, "batch",
                           ["source", "destination"])


@register("stream_running_topk", O.STREAM_RUNNING)
def stream_running_topk(spark, sf_dir):
    """Running totals, ranked again where they changed."""
    return _stream_ranking(spark, sf_dir, R.CARRIERS_PER_AIRPORT, "changes", ["airport"])


# A control line far past any flight date: it moves the watermark so every
# real window closes and is emitted; its own window never closes.
_FLUSH_LINE = "FLUSH,,,,,,2999,1,1,,"


@register("stream_window_topk", O.STREAM_WINDOW)
def stream_window_topk(spark, sf_dir):
    return _stream_windows(spark, sf_dir, "1 day")


@register("stream_window_hour_topk", O.STREAM_WINDOW_HOUR)
def stream_window_hour_topk(spark, sf_dir):
    return _stream_windows(spark, sf_dir, "1 hour")


def _stream_windows(spark, sf_dir, window):
    base = scratch_path(spark, "stream-window")
    inp, out, ckpt = f"{base}/input", f"{base}/out", f"{base}/ckpt"
    concise_lines(spark, sf_dir).select("value").write.text(f"{inp}/data")
    spark.createDataFrame([(_FLUSH_LINE,)], "value string").write.text(f"{inp}/flush")

    parsed = parsed_stream(message_stream(spark, "files", inp,
                                          options={"recursiveFileLookup": "true"}))
    q = R.start_ranking(parsed, R.CARRIERS_PER_AIRPORT, out, ckpt, mode="window",
                        window=window, watermark="2 days", trigger="available_now",
                        state_partitions=_cores(spark))
    run_until_done(q)
    return read_batches(spark, out).drop("batch_id")


def _stream_ledger(spark, sf_dir):
    """Day windows with a ledger, a bucket of flights a batch; where the
    results lie."""
    from aerolap.streaming.ledger import start_ledger_ranking
    base = scratch_path(spark, "stream-ledger")
    staged = _staged_lines(spark, sf_dir, base)
    inp, out, ckpt = f"{base}/input", f"{base}/out", f"{base}/ckpt"

    def start():
        parsed = parsed_stream(message_stream(spark, "files", inp))
        return start_ledger_ranking(parsed, R.CARRIERS_PER_AIRPORT, out, ckpt, lateness=f"{O.LEDGER_DAYS} days",
                                    trigger="available_now")

    replay(spark, staged, inp, start)
    return out


@register("stream_late_ledger", O.STREAM_LATE)
def stream_late_ledger(spark, sf_dir):
    """Every row beyond the watermark, with its window and batch."""
    return read_batches(spark, _stream_ledger(spark, sf_dir) + "_late")


@register("stream_ledger_topk", O.STREAM_LEDGER)
def stream_ledger_topk(spark, sf_dir):
    """Carriers per airport and day over the on-time rows of closed days."""
    return read_batches(spark, _stream_ledger(spark, sf_dir)).drop("batch_id")


@register("stream_itinerary", O.stream_itinerary_sql(k=None))
def stream_itinerary(spark, sf_dir):
    """All pairs per trip and batch, sorted."""
    return _stream_itinerary(spark, sf_dir, None)


@register("stream_itinerary_k_best", O.stream_itinerary_sql(k=10))
def stream_itinerary_k_best(spark, sf_dir):
    """The ten best pairs per trip and batch."""
    return _stream_itinerary(spark, sf_dir, 10)


def _stream_itinerary(spark, sf_dir, k):
    from aerolap.streaming.itinerary import start_itinerary
    base = scratch_path(spark, "stream-itin")
    staged = _staged_lines(spark, sf_dir, base)
    inp, out, ckpt = f"{base}/input", f"{base}/out", f"{base}/ckpt"

    def start():
        parsed = parsed_stream(message_stream(spark, "files", inp))
        return start_itinerary(parsed, out, ckpt, k=k, trigger="available_now")

    replay(spark, staged, inp, start)
    return read_batches(spark, out)


@register("stream_itinerary_running",
          O.itinerary_best_sql(parsed=True, delay_col="dep_delay_min", noon_inclusive=True))
def stream_itinerary_running(spark, sf_dir):
    from aerolap.streaming.itinerary import start_itinerary_running
    base = scratch_path(spark, "stream-itin-run")
    staged = _staged_lines(spark, sf_dir, base)
    inp, out, ckpt = f"{base}/input", f"{base}/out", f"{base}/ckpt"

    def start():
        parsed = parsed_stream(message_stream(spark, "files", inp))
        return start_itinerary_running(parsed, out, ckpt, trigger="available_now",
                                       state_partitions=_cores(spark))

    replay(spark, staged, inp, start)
    return newest_batch(spark, out)



# A valid first leg far past any flight date: it moves the watermark so every
# real start day closes; its own day never closes and is never emitted.
_FLUSH_LEG = "FLUSH,FLUSH_X,FLUSH_Y,0,0,0900,2999,1,1,2,0"


@register("stream_itinerary_window",
          O.itinerary_best_sql(parsed=True, delay_col="dep_delay_min", noon_inclusive=True))
def stream_itinerary_window(spark, sf_dir):
    from aerolap.streaming.itinerary import start_itinerary_windowed
    base = scratch_path(spark, "stream-itin-win")
    inp, out, ckpt = f"{base}/input", f"{base}/out", f"{base}/ckpt"
    concise_lines(spark, sf_dir).select("value").write.text(f"{inp}/data")
    spark.createDataFrame([(_FLUSH_LEG,)], "value string").write.text(f"{inp}/flush")
    parsed = parsed_stream(message_stream(spark, "files", inp,
                                          options={"recursiveFileLookup": "true"}))
    run_until_done(start_itinerary_windowed(parsed, out, ckpt, trigger="available_now",
                                            state_partitions=_cores(spark)))
    return read_batches(spark, out).drop("batch_id")


@register("stream_itinerary_join", O.stream_itinerary_lists_sql(k=10))
def stream_itinerary_join(spark, sf_dir):
    """The ten best pairs per trip over legs from different batches: half of
    the flights, the stream again with the other half, and a line that closes
    all days. Flights come in no order of time, hence the lateness."""
    from aerolap.streaming.itinerary import start_itinerary_lists
    base = scratch_path(spark, "stream-itin-join")
    inp, out, ckpt = f"{base}/input", f"{base}/out", f"{base}/ckpt"
    lines = concise_lines(spark, sf_dir)
    late = F.coalesce(F.col("bucket"), F.lit(0)) >= 2
    for name, part in (("early", lines.where(~late)), ("late", lines.where(late)),
                       ("flush", spark.createDataFrame([(_FLUSH_LEG,)], "value string"))):
        part.select("value").write.text(f"{inp}/{name}")
        parsed = parsed_stream(message_stream(spark, "files", inp, options={"recursiveFileLookup": "true"}))
        run_until_done(start_itinerary_lists(parsed, out, ckpt, k=10, lateness="10000 days", trigger="available_now",
                                             state_partitions=_cores(spark)))
    return read_batches(spark, out).drop("batch_id")

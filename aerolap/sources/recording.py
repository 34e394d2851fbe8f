"""SRC-6: recorded messages as a stream that follows a clock.

The reference's producer sends recorded flights one after another. Here a
recording is written once, sorted by event time, and a running stream reads it
through Spark's Python data source interface at a chosen speed.

* ``record`` range-sorts the messages by event time into Parquet files and
  publishes an index with the first and last time of each file.
* ``RecordingSource`` turns a virtual clock into offsets: event time moves
  ``speed`` times as fast as the wall clock, from the first recorded time on.
  A micro-batch is the half-open range (last time given, virtual now], so event
  times never fall from one batch to the next. Only files whose times meet the
  range are opened, one task for each, and in them only such row groups.
* The clock stands still while the query does not run. The time given last is
  noted beside the recording, since Spark does not tell a Python source where
  its checkpoint stands; a restarted query goes on from there. (A new
  checkpoint under an old name begins with all that was noted, in one batch.)

Messages without an event time come first, with the earliest ones. Messages of
one time are never parted over batches, but over files.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from aerolap.sources import commits

NAME = "flight_recording"
SCHEMA = "value string, at bigint"


def record(messages: DataFrame, at: Column, path: str, rows_per_file: int = 1_000_000) -> dict:
    """Write the ``value`` column of ``messages`` to ``path`` in the order of
    the timestamp ``at``. Returns ``span(path)``.

    One range shuffle on (time, hash of the message): a time that holds many
    messages is spread over several files. Its bounds take a pass of their own,
    so the messages are stored before, and made once. A path takes one recording.
    """
    spark, path = messages.sparkSession, path.rstrip("/")
    if commits.numbers(f"{path}/_index"):
        raise ValueError(f"{path} holds a recording")
    data = f"{path}/data-{uuid.uuid4().hex[:12]}"
    made = f"{path}/made-{uuid.uuid4().hex[:12]}"
    messages.select("value", F.unix_micros(at).alias("at")).write.parquet(made)
    (spark.read.schema(SCHEMA).parquet(made)
     .repartitionByRange(F.col("at"), F.xxhash64("value")).sortWithinPartitions("at")
     .write.option("maxRecordsPerFile", rows_per_file).parquet(data))
    folder = spark._jvm.org.apache.hadoop.fs.Path(made)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    # one row per file of the recording
    files = [[r["file"], r["lo"], r["hi"], r["undated"] > 0, r["n"]] for r in
             spark.read.schema(SCHEMA).parquet(data).groupBy(F.col("_metadata.file_name").alias("file"))
             .agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.count_if(F.isnull("at")).alias("undated"),
                  F.count("*").alias("n")).collect()]
    times = [t for f in files for t in f[1:3] if t is not None]
    first, last = (min(times), max(times)) if times else (0, 0)
    # files of undated messages begin at the first time
    index = [[name, first if undated or lo is None else lo, first if hi is None else hi, n]
             for name, lo, hi, undated, n in files]
    doc = {"data": data, "first": first, "last": last, "files": sorted(index, key=lambda f: (f[1], f[0]))}
    if not commits.publish(spark, f"{path}/_index", 0, doc):
        raise ValueError(f"{path} holds a recording")
    return span(path)


def span(path: str) -> dict:
    """``messages`` of a recording, its ``first`` and ``last`` time in microseconds."""
    doc = commits.read(f"{path.rstrip('/')}/_index", 0)
    return {"messages": sum(f[3] for f in doc["files"]), "first": doc["first"], "last": doc["last"]}


class Piece(InputPartition):
    """Messages of one file with times in (after, upto]; undated ones count as ``first``."""

    def __init__(self, file: str, first: int, after: int, upto: int):
        self.file, self.first, self.after, self.upto = file, first, after, upto


class RecordingReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.speed = float(options.get("speed", "1"))
        if not options.get("reader"):
            raise ValueError("a recording needs the option reader, a name of its own for every query")
        if not self.speed > 0:
            raise ValueError("speed must be positive")
        self.note = f"{self.path}/_readers/{options['reader']}.json"
        self.index = commits.read(f"{self.path}/_index", 0)
        self.base: int | None = None            # the virtual time at which this process began
        self.given: int | None = None
        self.began = 0.0

    def initialOffset(self) -> dict:
        return {"at": self.index["first"] - 1}

    def _give(self, at: int) -> None:
        """Note a time before Spark knows of it; a note is whole or the old one."""
        from aerolap.sources.files import move, open_binary

        draft = f"{self.note}.{uuid.uuid4().hex}.tmp"
        with open_binary(draft, "wb") as f:
            f.write(json.dumps({"at": at}).encode())
        move(draft, self.note)
        self.given = at

    def latestOffset(self) -> dict:
        from aerolap.sources.files import open_binary

        if self.base is None:                   # Spark asks for this before initialOffset
            folder, name = self.note.rsplit("/", 1)
            self.base = self.index["first"]
            if name in commits.names(folder):
                with open_binary(self.note) as f:
                    self.base = json.loads(f.read())["at"]
            self.began = time.monotonic()
        gone = int((time.monotonic() - self.began) * self.speed * 1_000_000)
        at = min(self.base + gone, self.index["last"])
        if at != self.given:
            self._give(at)
        return {"at": at}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        after, upto = start["at"], end["at"]
        if upto < after:
            raise ValueError(f"{self.note} is behind the checkpoint of the query: {upto} < {after}")
        out = [Piece(f"{self.index['data']}/{name}", self.index["first"], after, upto)
               for name, lo, hi, _ in self.index["files"] if lo <= upto and hi > after]
        return out or [Piece("", 0, 0, 0)]

    def read(self, piece: Piece) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        from aerolap.sources.files import open_binary

        if not piece.file:
            return
        with open_binary(piece.file) as f:
            parquet = pq.ParquetFile(f)
            place = parquet.schema_arrow.get_field_index("at")
            for g in range(parquet.num_row_groups):
                stats = parquet.metadata.row_group(g).column(place).statistics
                if (stats is not None and stats.has_min_max and stats.null_count == 0
                        and (stats.min > piece.upto or stats.max <= piece.after)):
                    continue
                for batch in parquet.iter_batches(row_groups=[g], columns=["value", "at"]):
                    at = pc.fill_null(batch.column("at"), piece.first)
                    keep = pc.and_(pc.greater(at, piece.after), pc.less_equal(at, piece.upto))
                    rows = pa.record_batch([batch.column("value"), at], names=["value", "at"]).filter(keep)
                    if rows.num_rows:
                        yield rows

    def commit(self, end: dict) -> None:
        """Offsets are kept by the stream's checkpoint."""


class RecordingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> RecordingReader:
        return RecordingReader(self.options)


def paced_stream(spark: SparkSession, path: str, speed: float, reader: str) -> DataFrame:
    """Streaming (value, at) of a recording, ``speed`` seconds of event time a
    second; ``at`` is the event time in microseconds.

    ``reader``: a name of its own for the query. Use a time trigger;
    ``processAllAvailable`` of the query returns when the recording has ended.
    """
    spark.dataSource.register(RecordingSource)
    return (spark.readStream.format(NAME).option("speed", repr(float(speed))).option("reader", reader)
            .load(path))

"""SRC-5: an append-only, partitioned message log in the shared folder, read
with offsets.

The reference's streams subscribe to topics of a broker: each message has a
partition and an offset, a new reader starts at either end, and a restarted
one goes on where it stopped. Here a topic is a folder that Spark jobs append
to, and a stream reads it through Spark's Python data source interface; no
broker and no extra process.

* ``append`` deals messages to partitions by a key, numbers them inside each
  partition and writes one folder; a commit file then publishes its offset
  ranges (``commits``). A failed append leaves an unnamed folder, which no
  reader sees; of two appends at once the later one is numbered again.
* ``LogSource`` plans a micro-batch from offset ranges per partition: only the
  folders whose ranges meet it are opened, one task for each piece. Offsets
  live in the stream's checkpoint, so a restart neither loses nor repeats a
  message. ``startingOffsets`` (earliest, latest or JSON per partition) counts
  for new streams; ``maxOffsetsPerTrigger`` bounds a batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from aerolap.sources import commits

NAME = "flight_log"
SCHEMA = "value string, partition int, offset bigint"


def append(messages: DataFrame, log: str, partitions: int = 8, key: str | None = None,
           order: Sequence[str] = (), retries: int = 20) -> dict[str, int]:
    """Append the ``value`` column to ``log``; returns the new end offsets.

    Messages of equal ``key`` (default: of equal value) share a partition, and
    are numbered there in the order of ``order``. A topic keeps the number of
    partitions of its first append.
    """
    spark, log = messages.sparkSession, log.rstrip("/")
    done = commits.numbers(f"{log}/_commits")
    if done:
        partitions = len(commits.read(f"{log}/_commits", done[-1])["ends"])
    folder = f"append-{uuid.uuid4().hex[:12]}"
    dealt = messages.select(
        "value", *order, F.pmod(F.xxhash64(key or "value"), F.lit(partitions)).cast("int").alias("p"))
    number = F.row_number().over(Window.partitionBy("p").orderBy(*(order or ["value"]))) - 1
    (dealt.select("value", "p", number.cast("bigint").alias("place"))
     .write.partitionBy("p").parquet(f"{log}/{folder}"))
    # at most one row per partition of the topic
    counts = {str(r["p"]): r["count"] for r in spark.read.schema("place bigint, p int").parquet(f"{log}/{folder}")
              .groupBy("p").count().collect()}
    for _ in range(retries):
        done = commits.numbers(f"{log}/_commits")
        last = commits.read(f"{log}/_commits", done[-1])["ends"] if done else {str(p): 0 for p in range(partitions)}
        ends = {p: n + counts.get(p, 0) for p, n in last.items()}
        doc = {"folder": folder, "starts": last, "ends": ends}
        if commits.publish(spark, f"{log}/_commits", done[-1] + 1 if done else 0, doc):
            return ends
    raise RuntimeError(f"{log}: no commit after {retries} attempts")


class Piece(InputPartition):
    """Places [lo, hi) of one partition folder; ``first`` is place 0's offset."""

    def __init__(self, folder: str, partition: int, first: int, lo: int, hi: int):
        self.folder, self.partition, self.first, self.lo, self.hi = folder, partition, first, lo, hi


class LogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.log = options["path"].rstrip("/")
        self.starting = options.get("startingOffsets", "latest")
        limit = options.get("maxOffsetsPerTrigger")
        self.limit = int(limit) if limit else None
        self.notes = f"{self.log}/_readers/{options.get('reader', '')}.json"
        if self.limit and not options.get("reader"):
            raise ValueError("maxOffsetsPerTrigger needs the option reader, a name of its own for every query")
        self.planned: dict[str, int] | None = None
        self.docs: dict[int, dict] = {}

    def _doc(self, number: int) -> dict:
        if number not in self.docs:
            self.docs[number] = commits.read(f"{self.log}/_commits", number)
        return self.docs[number]

    def _ends(self) -> dict[str, int]:
        done = commits.numbers(f"{self.log}/_commits")
        return dict(self._doc(done[-1])["ends"]) if done else {}

    def initialOffset(self) -> dict:
        ends = self._ends()
        if self.starting == "latest":
            start = ends
        elif self.starting == "earliest":
            start = {p: 0 for p in ends}
        else:
            asked = json.loads(self.starting)
            start = {p: int(asked.get(p, 0)) for p in ends}
            beyond = [p for p in start if not 0 <= start[p] <= ends[p]]
            if beyond:
                raise ValueError(f"startingOffsets beyond the log in partitions {beyond}")
        return start

    def _position(self) -> dict[str, int] | None:
        """What was planned last: by this process, or as noted by one before
        it. Spark does not tell where the checkpoint stands, and a plan must
        never fall behind it: an unreadable note means no bound this time."""
        if self.planned is not None:
            return self.planned
        folder, name = self.notes.rsplit("/", 1)
        if name not in commits.names(folder):
            return self.initialOffset()
        from aerolap.sources.files import open_binary

        try:
            with open_binary(self.notes) as f:
                return json.loads(f.read())
        except ValueError:
            return None

    def latestOffset(self) -> dict:
        ends = self._ends()
        if self.limit is None:
            return ends
        before = self._position()
        if before is not None:
            room, taken = self.limit, {}
            # an equal share for every partition; what one leaves, others take
            behind = sorted(ends, key=lambda p: ends[p] - before.get(p, 0))
            for i, p in enumerate(behind):
                share = -(-room // (len(behind) - i))
                taken[p] = min(share, ends[p] - before.get(p, 0))
                room -= taken[p]
            ends = {p: before.get(p, 0) + taken[p] for p in ends}
        if ends != self.planned:
            from aerolap.sources.files import open_binary

            with open_binary(self.notes, "wb") as f:      # before Spark knows of the plan
                f.write(json.dumps(ends).encode())
        self.planned = ends
        return ends

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        out = []
        for number in reversed(commits.numbers(f"{self.log}/_commits")):
            doc = self._doc(number)
            for p in end:
                lo, hi = max(start.get(p, 0), doc["starts"].get(p, 0)), min(end[p], doc["ends"].get(p, 0))
                if lo < hi:
                    first = doc["starts"][p]
                    out.append(Piece(f"{self.log}/{doc['folder']}/p={p}", int(p), first, lo - first, hi - first))
            if all(doc["starts"].get(p, 0) <= start.get(p, 0) for p in end):
                break
        # commits that are wholly behind the stream are not needed again
        self.docs = {n: d for n, d in self.docs.items() if any(d["ends"][p] > start.get(p, 0) for p in d["ends"])}
        return out or [Piece("", 0, 0, 0, 0)]

    def read(self, piece: Piece) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        from aerolap.sources.files import open_binary

        if not piece.folder:
            return
        for name in sorted(commits.names(piece.folder)):
            if not name.endswith(".parquet") or name.startswith((".", "_")):
                continue
            with open_binary(f"{piece.folder}/{name}") as f:
                for batch in pq.ParquetFile(f).iter_batches(columns=["value", "place"]):
                    place = batch.column("place")
                    keep = pc.and_(pc.greater_equal(place, piece.lo), pc.less(place, piece.hi))
                    rows = batch.filter(keep)
                    if rows.num_rows:
                        offset = pc.add(rows.column("place"), piece.first).cast(pa.int64())
                        yield pa.record_batch(
                            [rows.column("value"), pa.array([piece.partition] * rows.num_rows, pa.int32()), offset],
                            names=["value", "partition", "offset"])

    def commit(self, end: dict) -> None:
        """Offsets are kept by the stream's checkpoint."""


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options)


def log_stream(spark: SparkSession, log: str, starting_offsets: str = "latest",
               max_offsets_per_trigger: int | None = None, reader: str | None = None) -> DataFrame:
    """Streaming (value, partition, offset) from ``log``.

    A bound on the offsets of a batch needs ``reader``, a name of its own for
    the query: what was planned last is noted beside the log, since Spark does
    not tell a Python source where its checkpoint stands. The first batch after
    a crash, or with a new checkpoint under an old name, may be larger. With
    the ``available_now`` trigger a query ends after one batch (the one that a
    stopped run left unfinished, if any): start it again, or use a time trigger
    and ``processAllAvailable``.
    """
    spark.dataSource.register(LogSource)
    source = spark.readStream.format(NAME).option("startingOffsets", starting_offsets)
    if max_offsets_per_trigger:
        source = source.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger)).option("reader", reader or "")
    return source.load(log)

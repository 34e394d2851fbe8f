"""Shards of near equal bytes that keep equal texts together.

The ordered atomic groups are the distinct texts, in the order of their
smallest doc_id; a group's size is the bytes of all its copies. The shards are
a contiguous partition of that order whose largest shard is as small as it can
be: the smallest feasible capacity is binary-searched, each capacity checked
greedily (fill a shard while the next group fits), and the groups are cut
where the greedy walk cuts.

A greedy step asks for the largest prefix sum of group sizes up to a bound.
Prefix sums come from a range partitioning with one running sum per partition.
The search holds an index of at most ``bins`` prefix sums per range and not
the groups: each capacity is judged with lower and upper bounds of the
prefix sums, and only the byte ranges that leave the answer open are indexed
again, ``bins`` times finer, until the capacity is exact.

DataFrame functions only.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolap.llm.common import spool


def _width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(groups: DataFrame, order: list[str], size: str) -> DataFrame:
    """Add ``end``: the sum of ``size`` up to and with this row in ``order``."""
    placed = spool(groups.repartitionByRange(_width(groups), *order)
                   .withColumn("part", F.spark_partition_id()), "ordered")
    before = (placed.groupBy("part").agg(F.sum(size).alias("s"))
              .select("part", (F.sum("s").over(Window.orderBy("part")) - F.col("s")).alias("before")))
    within = F.sum(size).over(Window.partitionBy("part").orderBy(*order)
                              .rowsBetween(Window.unboundedPreceding, 0))
    return (placed.withColumn("end", within).join(before, "part")
            .withColumn("end", F.col("end") + F.col("before")).drop("part", "before"))


class _Index:
    """Known prefix sums, and the open ranges between them."""

    def __init__(self):
        self.ends: list[int] = [0]
        self.open: list[tuple[int, int]] = []   # (least, largest) prefix sum of a bin

    def add(self, bins: list[tuple[int, int, int]], replaced: list[tuple[int, int]]) -> None:
        gone = set(replaced)
        self.open = sorted([r for r in self.open if r not in gone]
                           + [(a, b) for a, b, n in bins if n > 2])
        self.ends = sorted({*self.ends, *(x for a, b, _ in bins for x in (a, b))})
        self._starts = [a for a, _ in self.open]

    def at_most(self, x: int) -> tuple[int, int]:
        """Bounds of the largest prefix sum <= x."""
        low = self.ends[bisect_right(self.ends, x) - 1]
        i = bisect_right(self._starts, x) - 1
        inside = i >= 0 and self.open[i][0] <= x < self.open[i][1]
        return low, (x if inside else low)

    def cuts(self, capacity: int, shards: int, upper: bool) -> list[int]:
        at, out = 0, []
        for _ in range(shards):
            at = self.at_most(at + capacity)[upper]
            out.append(at)
        return out


def smallest_capacity(prefix: DataFrame, size: str, shards: int, bins: int = 4096) -> tuple[int, list[int]]:
    """(the least capacity that ``shards`` contiguous shards need, the prefix
    sums at which its greedy walk ends each shard)."""
    row = prefix.agg(F.max("end"), F.max(size)).first()
    if not row[0]:
        return 0, [0] * shards
    total, biggest = int(row[0]), int(row[1])
    index = _Index()
    ranges = [(0, total)]
    # infeasible and feasible capacities: a shard filled up to T/shards +
    # biggest leaves less than one group's room
    bad, good = max(-(-total // shards), biggest) - 1, -(-total // shards) + biggest
    while True:
        index.add(_bins(prefix, ranges, bins), ranges)
        lo, hi = bad, good
        while hi - lo > 1:                    # surely feasible
            c = (lo + hi) // 2
            lo, hi = (lo, c) if index.cuts(c, shards, False)[-1] >= total else (c, hi)
        good = hi
        lo, hi = bad, good
        while hi - lo > 1:                    # surely infeasible
            c = (lo + hi) // 2
            lo, hi = (c, hi) if index.cuts(c, shards, True)[-1] < total else (lo, c)
        bad = lo
        cuts = index.cuts(good, shards, False)
        if good - bad <= 1 and cuts == index.cuts(good, shards, True):
            return good, cuts                 # and each cut is the greedy walk's own
        spans = zip(index.cuts(bad + 1, shards, False), index.cuts(good, shards, True))
        ranges = sorted({r for a, b in spans for r in index.open if r[0] <= b and r[1] >= a})


def _bins(prefix: DataFrame, ranges: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int]]:
    """(least, largest, count) of the prefix sums in equal bins of each range;
    neighbouring ranges are binned together."""
    joined: list[list[int]] = []
    for a, b in ranges:
        if joined and a <= joined[-1][1] + 1:
            joined[-1][1] = b
        else:
            joined.append([a, b])
    out = []
    while joined:                             # at most 64 stretches a job
        some, joined = joined[:64], joined[64:]
        slot: Column = F.lit(None).cast("bigint")
        for i, (a, b) in enumerate(some):
            step = (b - a) // bins + 1
            slot = F.when(F.col("end").between(a, b),
                          F.lit(i * (bins + 1)) + F.floor((F.col("end") - a) / step)).otherwise(slot)
        out += [(int(r[0]), int(r[1]), int(r[2])) for r in
                prefix.select("end", slot.alias("slot")).where("slot IS NOT NULL")
                .groupBy("slot").agg(F.min("end"), F.max("end"), F.count("*")).drop("slot").collect()]
    return out


def shard(docs: DataFrame, *, shards: int = 8) -> DataFrame:
    """Put every document into one of ``shards`` shards of near equal bytes.

    Returns ``doc_id``, ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32``,
    ``shard`` and ``slot`` (place in the shard, gapless from 0, by doc_id).
    All rows of equal text share a shard; null text counts as empty text.
    Rows without doc_id come first; rows that share a doc_id each get a slot.
    With fewer distinct texts than shards, some shards stay empty. An empty
    table gives an empty table. Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = spool(docs.select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key")), "sized")
    groups = sized.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes"))
    prefix = spool(prefix_sums(groups, ["first_id", "key"], "bytes"), "prefix")
    _, cuts = smallest_capacity(prefix, "bytes", shards)
    number = sum(((F.col("end") > F.lit(c)).cast("int") for c in cuts[:-1]), F.lit(0))
    placed = sized.join(prefix.select("key", number.alias("shard")), "key")

    order = ["doc_id", "text_crc32", "size"]
    ranged = spool(placed.select("doc_id", "size", "text_crc32", "shard")
                   .repartitionByRange(_width(docs), *order)
                   .withColumn("part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.select("shard", "part", (
        F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy(*order)) - 1
    return (ranged.withColumn("slot", within).join(before, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("slot") + F.col("before")).cast("bigint").alias("slot")))

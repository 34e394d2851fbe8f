"""Best-fit packing of token sequences after a dominance reduction.

Documents become pieces of at most ``capacity`` tokens in one Arrow pass. What
the packing needs of them is their histogram: at most ``capacity`` lengths
with counts, however many documents there are. On it

* the reduction fixes small sets that provably dominate every other way to
  fill a sequence holding their largest piece: a piece that nothing fits
  beside, a pair that fills a sequence, the largest partner when only one can
  fit, or when it is as long as any two that could, and a triple that
  dominates all others; each fix is applied to as many copies as there are;
* the remainder is packed best-fit, largest piece first: the longest piece
  that fits the space left, again for as many copies as there are.

Both give patterns (lengths and copies) with multiplicities, at most a few per
length. Pieces of one length are numbered by buckets (a count per length and
bucket, then a row number inside it), so a length that a third of all pieces
share is no single group, and number and length name the place in a pattern.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.llm.bpe import PATTERN, Vocabulary, load, text_slices
from aerolap.llm.common import spool

Pattern = tuple[int, list[tuple[int, int]]]      # times, [(length, copies)]

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# --- patterns over the histogram ---------------------------------------------

class _Lengths:
    """Counts by length, with the sorted lengths that are left."""

    def __init__(self, counts: dict[int, int]):
        self.count = {k: v for k, v in counts.items() if v > 0}
        self.left = sorted(self.count)

    def take(self, parts: list[tuple[int, int]], times: int) -> None:
        for length, copies in parts:
            self.count[length] -= times * copies
            if not self.count[length]:
                del self.count[length]
                del self.left[bisect_right(self.left, length) - 1]

    def times(self, parts: list[tuple[int, int]]) -> int:
        return min(self.count[length] // copies for length, copies in parts)

    def largest(self, room: int, used: dict[int, int]) -> int:
        """Longest length <= room with a copy beyond ``used`` (0: none)."""
        i = bisect_right(self.left, room) - 1
        while i >= 0:
            length = self.left[i]
            if self.count[length] > used.get(length, 0):
                return length
            i -= 1
        return 0

    def smallest(self, n: int, used: dict[int, int]) -> list[int]:
        """The n shortest copies beyond ``used``."""
        out: list[int] = []
        for length in self.left:
            out += [length] * min(n - len(out), self.count[length] - used.get(length, 0))
            if len(out) == n:
                break
        return out


def _parts(lengths: list[int]) -> list[tuple[int, int]]:
    return [(x, lengths.count(x)) for x in dict.fromkeys(lengths)]


def _dominating(have: _Lengths, j: int, capacity: int) -> list[int] | None:
    """A set holding length ``j`` that dominates all others, if one of the
    criteria proves it."""
    room, used = capacity - j, {j: 1}
    partner = have.largest(room, used)
    if not partner:
        return [j]                                   # nothing fits beside it
    if partner == room:
        return [j, partner]                          # a full pair
    few = have.smallest(3, used)
    if len(few) < 2 or few[0] + few[1] > room:
        return [j, partner]                          # one partner at most
    if len(few) == 3 and sum(few) <= room:
        return None
    # two partners at most: the best sum of two, by the longer one
    best = 0
    for x in have.left[: bisect_right(have.left, partner)]:
        if have.count[x] <= used.get(x, 0):
            continue
        y = have.largest(min(x, room - x), {j: 1, x: used.get(x, 0) + 1})
        if y:
            best = max(best, x + y)
    if best <= partner:
        return [j, partner]
    third = have.largest(room - partner, {j: 1, partner: used.get(partner, 0) + 1})
    if third and have.largest(room // 2, used) <= third:
        return [j, partner, third]                   # no pair has a longer second
    return None


def patterns(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], int]:
    """(patterns that use up ``counts``, how many the reduction fixed)."""
    have, out = _Lengths(counts), []
    changed = True
    while changed:
        changed = False
        for j in sorted(have.left, reverse=True):
            while have.count.get(j, 0) and (found := _dominating(have, j, capacity)):
                parts = _parts(found)
                # only a full pair or a lone piece stays dominating while its
                # lengths last; other criteria hold as well since removing
                # pieces only removes alternatives
                times = have.times(parts)
                out.append((times, parts))
                have.take(parts, times)
                changed = True
    fixed = len(out)
    while have.left:
        filled, used, room = [], {}, capacity
        while length := have.largest(room, used):
            copies = min(room // length, have.count[length] - used.get(length, 0))
            if not filled:
                copies = 1                           # the rest is best-fit
            used[length] = used.get(length, 0) + copies
            filled += [length] * copies
            room -= copies * length
        parts = _parts(filled)
        times = have.times(parts)
        out.append((times, parts))
        have.take(parts, times)
    return out, fixed


def places(found: list[Pattern]) -> dict[str, np.ndarray]:
    """Where the r-th piece of a length goes: rows sorted by (length, first
    r), each with copies per sequence, first sequence and first offset."""
    given: dict[int, int] = {}
    rows, sequence = [], 0
    for times, parts in found:
        offset = 0
        for length, copies in parts:
            rows.append((length, given.get(length, 0), copies, sequence, offset))
            given[length] = given.get(length, 0) + times * copies
            offset += length * copies
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "copies", "sequence", "offset"), table.T))


# --- pieces ---------------------------------------------------------------------

_encodings: dict[str, tiktoken.Encoding] = {}


def _encoding(key: str, shared) -> tiktoken.Encoding:
    if key not in _encodings:
        v: Vocabulary = shared.value
        special = set(v.added.values())
        _encodings[key] = tiktoken.Encoding(
            key, pat_str=PATTERN, special_tokens=v.added,
            mergeable_ranks={b: i for i, b in enumerate(v.bytes_of) if b and i not in special})
    return _encodings[key]


def _pieces(batches: Iterator[pa.RecordBatch], shared, key: str, capacity: int, end: int,
            keep_ids: bool) -> Iterator[pa.RecordBatch]:
    encoding = _encoding(key, shared)
    for batch in batches:
        done = 0
        for texts in text_slices(batch.column(1)):
            rows, ids = [], []
            for r, text in enumerate(texts):
                tokens = np.append(encoding.encode_to_numpy(text, allowed_special="all"), end).astype("<u4")
                cuts = [0, *range(len(tokens) % capacity or capacity, len(tokens), capacity), len(tokens)]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = tokens[a:b].tobytes()
                    rows.append((done + r, p, a, b - a, zlib.crc32(part)))
                    if keep_ids:
                        ids.append(part)
            done += len(texts)
            row, piece, start, length, crc = map(np.array, zip(*rows))
            columns = [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                       pa.array(length), pa.array(crc)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.record_batch(columns, names=names)


def pieces(docs: DataFrame, tokenizer_path: str, *, capacity: int = 1024, end: int = 2,
           keep_ids: bool = False) -> DataFrame:
    """Each document's ids, then ``end``; longer ones cut into pieces of
    ``capacity`` tokens, the first taking what is left over."""
    vocabulary, key = load(tokenizer_path)
    if np.any(np.diff(vocabulary.made) <= 0):
        raise ValueError("the tokenizer's ids do not follow its merge order")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: _pieces(it, shared, key, capacity, end, keep_ids),
        _PIECES + (", ids binary" if keep_ids else ""))


def _place(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    table = shared.value
    for batch in batches:
        length = batch.column("length").to_numpy()
        number = batch.column("number").to_numpy()
        # the last row at or before (length, number)
        lo = np.searchsorted(table["length"], length)
        key = table["length"] << 44 | table["first"]
        at = np.maximum(np.searchsorted(key, length << 44 | number, side="right") - 1, lo)
        i = number - table["first"][at]
        copies = table["copies"][at]
        keep = batch.drop_columns(["number"])
        yield pa.record_batch(
            [*keep.columns, pa.array(table["sequence"][at] + i // copies),
             pa.array(table["offset"][at] + i % copies * length)],
            names=[*keep.schema.names, "sequence_id", "offset"])


def pack_pieces(cut: DataFrame, *, capacity: int = 1024) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a (stored) table of pieces."""
    spark = cut.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    sizes = spool(dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")), "lengths")
    # at most `capacity` rows
    counts = {int(r[0]): int(r[1]) for r in sizes.groupBy("length").agg(F.sum("n")).collect()}
    found, _ = patterns(counts, capacity)
    shared = spark.sparkContext.broadcast(places(found))
    before = sizes.select("length", "bucket", (
        F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    order = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in cut.columns]
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    numbered = (dealt.withColumn("number", within.cast("bigint")).join(before, ["length", "bucket"])
                .select(*cut.columns, (F.col("number") + F.col("before")).alias("number")))
    schema = T.StructType([*cut.schema.fields, *(T.StructField(n, T.LongType()) for n in ("sequence_id", "offset"))])
    return numbered.mapInArrow(lambda it: _place(it, shared), schema)


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = 1024, end: int = 2,
         keep_ids: bool = False) -> DataFrame:
    """Pack all documents into as few sequences as it can of ``capacity`` tokens.

    Returns one row per piece: doc_id, piece (from 0), start (ids of its
    document before it), length, ids_crc32, optional ids, sequence_id (from 0)
    and offset (place in the sequence, gapless from 0). Null text counts as
    empty (the end id alone). Every row is packed, repeated and null doc_ids
    too; columns other than doc_id and text are not read. An empty table gives
    an empty table.
    """
    cut = spool(pieces(docs, tokenizer_path, capacity=capacity, end=end, keep_ids=keep_ids), "pieces")
    return pack_pieces(cut, capacity=capacity)

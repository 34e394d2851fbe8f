"""Lines repeated across documents, found with two Bloom filters.

* Scan. Each map task hashes the keys of its long lines (128 bits) and folds a
  batch first: a key that several documents of the batch hold is already a
  repeat, its rows go on as suspects with one marker for the filters; every
  other key is one (key, document) entry.
* Filters. The hash space is cut into segments, one shuffle partition each.
  A segment's task keeps a pair of Bloom filters, sized from its own entries:
  *once* takes every key, *twice* every key that *once* already held. Entries
  outside *twice* are proven to occur once and end there. So neither filter
  grows past one partition's share and none is broadcast; a key in a third of
  all documents reaches its segment once per batch.
* Confirmation. Only suspects shuffle by key: exact counts and the document
  that keeps the line, then a join back that leaves (document, key) drops.

The documents join their drops by id, and the lines are cut there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolap.llm.common import (
    LOWER, U64, Block, blocks, digests, mapped, marked_texts, replaced, signed, spool)

_ENTRY = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8")])
_SUSPECTS = "h1 bigint, h2 bigint, doc_id bigint"


def line_keys(block: Block, min_points: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per line of the block: row, whether its key is long enough, and the two
    halves of the key's digest (0 for short ones).

    The key is the line without white space at its ends, A-Z lower-cased.
    """
    row, _, _, a, b = block.lines()
    points = np.zeros(len(block.data) + 1, dtype=np.int64)
    np.cumsum((block.data & 0xC0) != 0x80, out=points[1:])
    long = points[b] - points[a] >= min_points
    halves = np.zeros((len(row), 2), dtype=np.uint64)
    halves[long] = digests(LOWER[block.data], a[long], b[long])
    return row, long, halves[:, 0], halves[:, 1]


def _fold(batches: Iterator[pa.RecordBatch], min_points: int, segments: int) -> Iterator[pa.RecordBatch]:
    """One row per segment and batch: its entries, markers and known repeats."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        found = []
        for block in blocks(batch.column(1)):
            row, is_long, h1, h2 = line_keys(block, min_points)
            long = np.flatnonzero(is_long)
            e = np.empty(len(long), dtype=_ENTRY)
            e["h1"], e["h2"], e["doc"] = h1[long], h2[long], block.lo + row[long]
            found.append(e)
        e = np.concatenate(found) if found else np.empty(0, _ENTRY)
        if not len(e):
            continue
        e = e[np.lexsort((e["doc"], e["h2"], e["h1"]))]
        same_key = (e["h1"][1:] == e["h1"][:-1]) & (e["h2"][1:] == e["h2"][:-1])
        new = np.append(True, ~(same_key & (e["doc"][1:] == e["doc"][:-1])))
        e = e[new]                        # a document's own repeats count once
        head = np.flatnonzero(np.append(True, (e["h1"][1:] != e["h1"][:-1])
                                        | (e["h2"][1:] != e["h2"][:-1])))
        n = np.diff(np.append(head, len(e)))
        single = np.repeat(n == 1, n)
        spread = e["doc"] % segments      # known repeats need no filter: any segment will do
        e["doc"] = ids[e["doc"]]
        marks = e["h1"][head[n > 1]]
        of = (e["h1"] % U64(segments)).astype(np.int64)
        of_mark = (marks % U64(segments)).astype(np.int64)
        parts = [_by(of[single], e[single], segments), _by(of_mark, marks, segments),
                 _by(spread[~single], e[~single], segments)]
        some = [s for s in range(segments) if any(len(p[s]) for p in parts)]
        yield pa.record_batch(
            [pa.array(some, pa.int32()), *(pa.array([p[s].tobytes() for s in some], pa.binary()) for p in parts)],
            names=["segment", "entries", "marks", "known"])


def _by(segment: np.ndarray, values: np.ndarray, segments: int) -> list[np.ndarray]:
    order = np.argsort(segment, kind="stable")
    return np.split(values[order], np.searchsorted(segment[order], np.arange(1, segments)))


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    entries, marks = [], []
    for batch in batches:
        for i in range(batch.num_rows):
            entries.append(np.frombuffer(batch.column(1)[i].as_buffer(), _ENTRY))
            marks.append(np.frombuffer(batch.column(2)[i].as_buffer(), "<u8"))
            known = np.frombuffer(batch.column(3)[i].as_buffer(), _ENTRY)
            if len(known):
                yield _rows(known)
    n = sum(map(len, entries)) + sum(map(len, marks))
    if not n:
        return
    size = 1 << max(10, (8 * n - 1).bit_length())
    once, twice = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)

    def bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # the low part of a hash is shared within a segment: use higher bits
        return ((h >> U64(20)) & U64(size - 1)).astype(np.int64), \
            ((h * U64(0x9E3779B97F4A7C15) >> U64(17)) & U64(size - 1)).astype(np.int64)

    for m in marks:
        for b in bits(m):
            once[b] = twice[b] = True
    for e in entries:                     # the keys of one batch are distinct
        a, b = bits(e["h1"])
        again = once[a] & once[b]
        twice[a[again]] = twice[b[again]] = True
        once[a] = once[b] = True
    for e in entries:
        a, b = bits(e["h1"])
        hit = e[twice[a] & twice[b]]
        if len(hit):
            yield _rows(hit)


def _rows(e: np.ndarray) -> pa.RecordBatch:
    col = lambda name: np.ascontiguousarray(e[name])
    return pa.record_batch([signed(col("h1")), signed(col("h2")), pa.array(col("doc"))],
                           names=["h1", "h2", "doc_id"])


def _cut(batches: Iterator[pa.RecordBatch], text_at: int, min_points: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, dropped, texts = [], [], []
        drops = batch.column(batch.num_columns - 1)
        for block in blocks(batch.column(text_at)):
            listed = [r for r in range(block.rows) if drops[block.lo + r].is_valid]
            n = 1 + np.bincount(np.searchsorted(block.offsets, np.flatnonzero(block.data == 0x0A), side="right") - 1,
                                minlength=block.rows)[: block.rows]
            raw = [block.bytes_of(r) for r in range(block.rows)]
            gone = np.zeros(block.rows, dtype=np.int64)
            if listed:
                _, long, h1, h2 = line_keys(block, min_points)
                first = np.cumsum(n) - n
                for r in listed:
                    d = drops[block.lo + r].values
                    d1, d2 = (d.field(c).to_numpy() for c in ("h1", "h2"))
                    at = slice(first[r], first[r] + n[r])
                    pairs = set(zip(d1.tolist(), d2.tolist()))
                    maybe = np.flatnonzero(np.isin(h1[at].view(np.int64), d1) & long[at])
                    out = {i for i in maybe.tolist()
                           if (int(h1[at][i].view(np.int64)), int(h2[at][i].view(np.int64))) in pairs}
                    gone[r] = len(out)
                    raw[r] = b"\n".join(x for i, x in enumerate(raw[r].split(b"\n")) if i not in out)
            total += n.tolist()
            dropped += gone.tolist()
            texts += raw
        yield replaced(batch, text_at, texts, n_lines=total, n_dropped=dropped)


def remove_lines(docs: DataFrame, *, min_points: int = 20, min_docs: int = 3) -> DataFrame:
    """Drop lines whose key occurs in at least ``min_docs`` documents, except
    in the largest ``doc_id`` that holds it.

    A line's key is the line without white space (space, \\x09-\\x0D) at its
    ends and with A-Z lower-cased; keys under ``min_points`` code points stay.
    Returns the columns of ``docs`` with ``text`` cut (kept lines unchanged,
    joined by a line feed), plus ``n_lines`` (before) and ``n_dropped``
    (columns of those names in ``docs`` are replaced).

    Null or empty text is one empty line and comes back empty. A key repeated
    within one document counts once there, and all its lines go together. Each
    row counts as a document; rows that share the largest doc_id all keep the
    line. A row without doc_id is neither counted nor cut. An empty table
    gives an empty table.
    """
    spark = docs.sparkSession
    segments = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = docs.select("doc_id", "text")
    # stored: counted and joined below, and the texts are not folded again
    suspects = spool(text.where("doc_id IS NOT NULL")
                     .mapInArrow(lambda it: _fold(it, min_points, segments),
                                 "segment int, entries binary, marks binary, known binary")
                     .repartition(segments, "segment")
                     .mapInArrow(_suspects, _SUSPECTS), "suspects")
    # stored, so that both sides of the join below are plain shuffles and AQE
    # can split a line that very many documents hold
    repeated = spool(suspects.groupBy("h1", "h2")
                     .agg(F.count("*").alias("c"), F.max("doc_id").alias("keeper"))
                     .where(F.col("c") >= min_docs).select("h1", "h2", "keeper"), "lines")
    drops = (suspects.join(repeated, ["h1", "h2"]).where("doc_id < keeper")
             .groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("drops")))
    marked, schema, at = marked_texts(docs, drops, "drops", ["n_lines", "n_dropped"])
    return mapped(marked, lambda it: _cut(it, at, min_points), schema)

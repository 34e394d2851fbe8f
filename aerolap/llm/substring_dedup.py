"""Repeated long passages: a sampled de Bruijn graph of the corpus.

* Edges. A token k-mer (``k`` words) is an edge of the graph. Of the edges in
  every window of ``window`` words only the one with the smallest hash is kept
  (leftmost on ties), so equal windows always keep the same edge and about one
  edge in ``(window - k) / 2`` words leaves the scan.
* Paths. Consecutive windows of a document that keep the same edge are
  compacted to one path: a document, a start, a count of windows and a 128-bit
  hash of the words from the first window's start to the last one's end. Paths
  of equal words merge in one grouped minimum, so all copies of a passage meet
  as a few rows, not as one row per window.
* Branching. If all paths through an edge have equal words, the edge does not
  branch and the whole path is decided by its smallest document. An edge with
  several paths branches: each *distinct* path is fetched once from its source
  coordinates and split into its windows, whose words (128-bit hash) decide
  each window's smallest document.
* Cut. Every occurrence of a path turns into spans of word positions, which
  join the documents by id and are removed there.

Joins and grouped minima only; a passage in a third of all documents is one
row per map task after the partial aggregates, and the joins that meet its
occurrences again are plain sort-merge joins that AQE splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolap.llm.common import (
    Block, blocks, mapped, marked_texts, replaced, signed, span_hash, spool, text_hash)

_PATHS = "doc_id bigint, row bigint, start int, n int, edge bigint, h1 bigint, h2 bigint"


def word_hashes(block: Block, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes per word."""
    return text_hash(block.data, starts, ends, 0), text_hash(block.data, starts, ends, 1)


def smallest_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in ``values[i : i + width]``."""
    at = np.arange(len(values))
    span = 1
    while 2 * span <= width:
        left, right = at[: len(at) - span], at[span:]
        at = np.where(values[right] < values[left], right, left)
        span *= 2
    if span < width:
        step = width - span
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
    return at


def _paths(batches: Iterator[pa.RecordBatch], window: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
        for block in blocks(batch.column(1)):
            starts, ends, first = block.words()
            if len(starts) < window:
                continue
            w1, w2 = word_hashes(block, starts, ends)
            n_words = np.diff(first)
            n_windows = np.maximum(n_words - window + 1, 0)
            row = np.repeat(np.arange(block.rows), n_windows)
            if not len(row):
                continue
            skip = np.cumsum(n_windows) - n_windows
            at = np.arange(len(row)) - skip[row] + first[row]     # window start words
            pos = np.arange(len(w1) - k + 1)
            edges = span_hash(w1, pos, pos + k, 2)
            chosen = smallest_in_window(edges, window - k + 1)[at]
            new = np.ones(len(row), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (chosen[1:] != chosen[:-1])
            head = np.flatnonzero(new)
            n = np.diff(np.append(head, len(row)))
            begin = at[head]
            end = begin + n + window - 1
            rows = row[head]
            yield pa.record_batch([
                pa.array(ids[block.lo + rows]), pa.array(keys[block.lo + rows]),
                pa.array((begin - first[rows]).astype(np.int32)),
                pa.array(n.astype(np.int32)),
                signed(edges[chosen[head]]),
                signed(span_hash(w1, begin, end, 2)),
                signed(span_hash(w2, begin, end, 3)),
            ], names=["doc_id", "row", "start", "n", "edge", "h1", "h2"])


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Split the paths listed with each document into their windows."""
    for batch in batches:
        listed = batch.column(1)
        for block in blocks(batch.column(0)):
            starts, ends, first = block.words()
            w1, w2 = word_hashes(block, starts, ends)
            at, off, rows = [], [], []
            for r in range(block.rows):
                for p in listed[block.lo + r].as_py():
                    begin = first[r] + p["start"]
                    if begin + p["n"] + window - 1 <= first[r + 1]:
                        at.append(np.arange(begin, begin + p["n"]))
                        off.append(np.arange(p["n"], dtype=np.int32))
                        rows.append((p["h1"], p["h2"], p["lo"], p["n"]))
            if not rows:
                continue
            h1, h2, lo, n = (np.array(c, dtype=np.int64) for c in zip(*rows))
            at = np.concatenate(at)
            yield pa.record_batch([
                signed(span_hash(w1, at, at + window, 2)),
                signed(span_hash(w2, at, at + window, 3)),
                pa.array(np.repeat(h1, n)), pa.array(np.repeat(h2, n)),
                pa.array(np.repeat(lo, n)), pa.array(np.concatenate(off)),
            ], names=["w1", "w2", "h1", "h2", "lo", "off"])


def _cut(batches: Iterator[pa.RecordBatch], text_at: int, window: int, one_space: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column(batch.num_columns - 1)
        total, removed, texts = [], [], []
        for block in blocks(batch.column(text_at)):
            starts, ends, first = block.words()
            for r in range(block.rows):
                lo, hi = first[r], first[r + 1]
                n = int(hi - lo)
                marks = spans[block.lo + r].values
                raw = block.bytes_of(r)
                gone = np.zeros(n + 1, dtype=np.int64)
                if marks is not None and len(marks):
                    s = marks.field("start").to_numpy(zero_copy_only=False)
                    e = np.minimum(s + marks.field("n").to_numpy(zero_copy_only=False) + window - 1, n)
                    np.add.at(gone, np.minimum(s, n), 1)
                    np.add.at(gone, e, -1)
                keep = np.cumsum(gone[:-1]) == 0
                total.append(n)
                removed.append(n - int(keep.sum()))
                if one_space:
                    words = raw.split()
                    texts.append(b" ".join(words if removed[-1] == 0 else
                                           [words[i] for i in np.flatnonzero(keep)]))
                elif removed[-1] == 0:
                    texts.append(raw)
                else:
                    # kept runs keep their own white space and line breaks
                    edge = np.diff(np.concatenate([[0], keep.astype(np.int8), [0]]))
                    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                    base = block.offsets[r]
                    texts.append(b"\n".join(raw[starts[lo + i] - base: ends[lo + j - 1] - base]
                                            for i, j in zip(a, b)))
        yield replaced(batch, text_at, texts, n_words=total, n_removed=removed)


def remove_repeats(docs: DataFrame, *, window: int = 50, k: int = 12,
                   one_space: bool = False) -> DataFrame:
    """Cut every word that a repeated window of ``window`` words covers.

    A window goes if its words also start in a document with a smaller
    ``doc_id``; windows are judged on the input, not on what is left. Returns
    the columns of ``docs`` with ``text`` cut, plus ``n_words`` and
    ``n_removed`` (columns of those names in ``docs`` are replaced). Kept
    words keep the white space between them (a cut leaves one line break), or
    are joined by one space if ``one_space``.

    Null text counts as no words and comes back empty; texts shorter than a
    window stay. Repeats inside one document stay. Rows that share a doc_id
    count as one document: they are no source for each other; each is cut by
    its own windows. A row without doc_id is neither a source nor cut. An empty table gives an empty table.
    """
    # rows that share a doc_id are told apart by their text
    text = docs.select("doc_id", "text", F.xxhash64("text").alias("row"))
    found = text.where("doc_id IS NOT NULL").mapInArrow(
        lambda it: _paths(it, window, k), _PATHS)

    # one row per distinct path: its smallest and largest document, and source
    # coordinates in the smallest
    paths = spool(found.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
        F.min_by("start", "doc_id").alias("start"), F.min_by("row", "doc_id").alias("row"), F.max("n").alias("n"),
        F.min("edge").alias("edge")), "paths")
    # stored, like the other small sides below: with plain shuffles on both
    # sides of a join AQE can split what very many documents hold
    branching = spool(paths.groupBy("edge")
                      .agg(F.count("*").alias("c"), F.min("lo").alias("l"), F.max("hi").alias("h"))
                      .where("c > 1 AND l < h").select("edge"), "branching")
    listed = (paths.select("edge", "h1", "h2", "lo", "row", "start", "n")
              .join(branching, "edge", "left_semi")
              .groupBy(F.col("lo").alias("doc_id"), "row")
              .agg(F.collect_list(F.struct("start", "n", "h1", "h2", "lo")).alias("paths")))
    windows = spool(text.join(listed, ["doc_id", "row"]).select("text", "paths")
                    .mapInArrow(lambda it: _windows(it, window),
                                "w1 bigint, w2 bigint, h1 bigint, h2 bigint, lo bigint, off int"),
                    "windows")
    least = spool(windows.groupBy("w1", "w2")
                  .agg(F.min("lo").alias("least"), F.max("lo").alias("most"))
                  .where("least < most").select("w1", "w2", "least"), "least")
    # windows of a path that an even smaller document holds in other company
    extra = (windows.join(least, ["w1", "w2"]).where("least < lo")
             .groupBy("h1", "h2").agg(F.min("lo").alias("lo_"),
                                      F.collect_set(F.struct("off", "least")).alias("extra")))

    judged = spool(paths.where("lo < hi").select("h1", "h2", "lo")
                   .join(extra, ["h1", "h2"], "full")
                   .select("h1", "h2", F.coalesce("lo", "lo_").alias("lo"), "extra"), "judged")
    whole = F.array(F.struct(F.col("start"), F.col("n")))
    parts = F.transform(
        F.filter("extra", lambda x: x["least"] < F.col("doc_id")),
        lambda x: F.struct((F.col("start") + x["off"]).alias("start"), F.lit(1).alias("n")))
    spans = (found.select("doc_id", "row", "start", "n", "h1", "h2").join(judged, ["h1", "h2"])
             .select("doc_id", "row", F.when(F.col("doc_id") > F.col("lo"), whole)
                     .otherwise(F.coalesce(parts, F.array().cast("array<struct<start:int,n:int>>")))
                     .alias("s"))
             .where("size(s) > 0")
             .groupBy("doc_id", "row").agg(F.flatten(F.collect_list("s")).alias("spans")))
    marked, schema, at = marked_texts(docs, spans, "spans", ["n_words", "n_removed"], row="row")
    return mapped(marked, lambda it: _cut(it, at, window, one_space), schema)
